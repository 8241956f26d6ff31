"""DataFrame operators: dedup, top-k and modal value, joins, upsert, history, checks."""
