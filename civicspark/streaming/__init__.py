"""The incremental loads as Structured Streaming queries."""
