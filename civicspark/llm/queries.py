"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm import (
    chat_tree,
    decontaminate,
    exact_topk,
    filter_audit,
    html_extraction,
    jaccard_join,
    language_id,
    lm_score,
    mixing,
    substring_dedup,
    surrogates,
    tokenizer_alignment,
    toxicity,
)
from civicspark.llm.frames import read

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_texts(read(spark, sf_dir, "pages"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.scores(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.round("log_score", 3).alias("log_score"),
        F.round("word_score", 5).alias("word_score"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(read(spark, sf_dir, "documents"), texts=False)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_join.similar_groups(read(spark, sf_dir, "documents"), shingle=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read(spark, sf_dir, "documents"))


#: A production run takes its key from a secret store.
SURROGATE_KEY = "test tables"


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymised(read(spark, sf_dir, "documents"), SURROGATE_KEY)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_alignment.alignments(read(spark, sf_dir, "documents"))


#: A conversation whose texts hold the template's own marks, formatted along with the table.
_MARKED = "<|im_end|><|im_start|>assistant ok"


def op13_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(
        [(-1, 0, "user", _MARKED), (-1, 1, "assistant", _MARKED)],
        "conv_id long, turn long, role string, text string",
    )
    return chat_tree.formatted(rows.unionByName(marked))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_html_extraction,
        op2_lm_score,
        op3_decontamination,
        op4_substring_dedup,
        op5_jaccard_join,
        op6_language_id,
        op7_toxicity,
        op8_exact_topk,
        op9_mixing,
        op10_surrogates,
        op11_filter_audit,
        op12_tokenizer_alignment,
        op13_chat_tree,
    )
    return {f.__name__: f for f in found}


def _words(text: str, pattern: str, lower: bool) -> str:
    text = _LOWER.format(text) if lower else text
    return f"coalesce(regexp_extract_all({text}, '{pattern}'), [])"


_OP2 = f"""
WITH texts AS (SELECT doc_id, {_words("text", _ALNUM, True)} AS w FROM documents),
sizes AS (SELECT sum(len(w)) AS n FROM texts),
places AS (
    SELECT doc_id, len(w) AS own, i, w[i] AS g1, w[i - 1] AS h1,
        CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS g2,
        CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] END AS h2,
        CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS g3
    FROM texts, unnest(range(1, len(w) + 1)) AS t(i)
),
c1 AS (SELECT g1 AS g, count(*) AS c FROM places GROUP BY g1),
c2 AS (SELECT g2 AS g, count(*) AS c FROM places WHERE i > 1 GROUP BY g2),
c3 AS (SELECT g3 AS g, count(*) AS c FROM places WHERE i > 2 GROUP BY g3),
d1 AS (SELECT doc_id, g1 AS g, count(*) AS c FROM places GROUP BY ALL),
d2 AS (SELECT doc_id, g2 AS g, count(*) AS c FROM places WHERE i > 1 GROUP BY ALL),
d3 AS (SELECT doc_id, g3 AS g, count(*) AS c FROM places WHERE i > 2 GROUP BY ALL),
counted AS (
    SELECT p.doc_id, n - own AS others, c1.c - d1.c AS k1, c2.c - d2.c AS k2, c3.c - d3.c AS k3,
        x1.c - y1.c AS m1, x2.c - y2.c AS m2
    FROM places AS p CROSS JOIN sizes
    JOIN c1 ON c1.g = g1 JOIN d1 ON d1.doc_id = p.doc_id AND d1.g = g1
    LEFT JOIN c2 ON c2.g = g2 LEFT JOIN d2 ON d2.doc_id = p.doc_id AND d2.g = g2
    LEFT JOIN c3 ON c3.g = g3 LEFT JOIN d3 ON d3.doc_id = p.doc_id AND d3.g = g3
    LEFT JOIN c1 AS x1 ON x1.g = h1 LEFT JOIN d1 AS y1 ON y1.doc_id = p.doc_id AND y1.g = h1
    LEFT JOIN c2 AS x2 ON x2.g = h2 LEFT JOIN d2 AS y2 ON y2.doc_id = p.doc_id AND y2.g = h2
),
scored AS (
    SELECT doc_id, CASE
        WHEN k3 > 0 THEN ln(k3) - ln(m2)
        WHEN k2 > 0 THEN ln(k2) - ln(m1) + CASE WHEN k3 IS NULL THEN 0 ELSE ln(0.4) END
        ELSE CASE WHEN k1 > 0 THEN ln(k1) - ln(others) ELSE -ln(others + 1) END
            + CASE WHEN k2 IS NULL THEN 0 WHEN k3 IS NULL THEN ln(0.4) ELSE 2 * ln(0.4) END
        END AS s
    FROM counted
),
summed AS (SELECT doc_id, sum(s) AS s FROM scored GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(s, 0), 3) AS log_score,
    round(s / len(w), 5) AS word_score
FROM texts LEFT JOIN summed USING (doc_id)
"""

_OP3 = f"""
WITH texts AS (SELECT doc_id, {_words("text", _ALNUM, True)} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_words("text", _ALNUM, True)} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + 12], ' ') AS gram
    FROM items, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i) WHERE len(w) > 0
),
runs AS (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM texts, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS t(i)
),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM runs JOIN windows USING (n, gram)),
words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM hits, unnest(range(i, i + n)) AS t(place) GROUP BY doc_id
),
lists AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM texts LEFT JOIN words USING (doc_id) LEFT JOIN lists USING (doc_id)
"""


_OP4 = f"""
WITH texts AS (SELECT doc_id, {_words("text", _SPACED, False)} AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS gram
    FROM texts, unnest(range(1, len(w) - 11)) AS t(i)
),
firsts AS (SELECT gram, min(doc_id) AS first_doc FROM windows GROUP BY gram),
gone AS (
    SELECT DISTINCT doc_id, place
    FROM windows JOIN firsts USING (gram), unnest(range(i, i + 13)) AS t(place)
    WHERE first_doc < doc_id
),
lists AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
kept AS (
    SELECT doc_id, len(w) AS n, coalesce(len(places), 0) AS n_gone,
        CASE WHEN places IS NULL THEN w ELSE list_transform(
            list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(places, k)), lambda k: w[k]
        ) END AS stay
    FROM texts LEFT JOIN lists USING (doc_id)
)
SELECT doc_id, n::BIGINT AS n_words, n_gone::BIGINT AS n_removed,
    sha256(array_to_string(stay, ' ')) AS kept_sha256
FROM kept
"""

_OP5 = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_words("text", _SPACED, True)} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS gram
    FROM texts, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
    FROM shingles AS a JOIN shingles AS b ON a.gram = b.gram AND a.doc_id != b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT x, y FROM shared JOIN sizes AS a ON a.doc_id = x JOIN sizes AS b ON b.doc_id = y
    WHERE 100 * n_both >= 85 * (a.n + b.n - n_both)
),
reach AS (
    SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
),
lowest AS (SELECT x AS doc_id, min(y) AS other FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
    least(doc_id, coalesce(other, doc_id)) AS component_id
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""


_OP8 = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable AS q JOIN usable AS c ON q.vec_id != c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


_OP11 = f"""
WITH texts AS (
    SELECT row_number() OVER () AS doc, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        {_words("coalesce(text, '')", _SPACED, False)} AS w
    FROM documents
),
judged AS (
    SELECT doc, part, list_filter([
        CASE WHEN len(w) < 200 THEN 'A' END,
        CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
        CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END,
        CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
        CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' END
    ], lambda f: f IS NOT NULL) AS fails,
        doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
        doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
    FROM texts
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
gone AS (
    SELECT part, filter_order, doc, good, toxic, min(instr(filter_order, f)) AS step
    FROM judged, orders, unnest(fails) AS x(f) GROUP BY ALL
),
at_step AS (
    SELECT part, filter_order, step, count(*) AS removed, count_if(good) AS good_lost,
        count_if(toxic) AS toxic_lost
    FROM gone GROUP BY ALL
),
failing AS (
    SELECT part, f, count(*) AS n, count_if(len(fails) = 1) AS alone
    FROM judged, unnest(fails) AS x(f) GROUP BY ALL
),
every AS (
    SELECT part, total, filter_order, step, substr(filter_order, step, 1) AS f
    FROM (SELECT part, count(*) AS total FROM judged GROUP BY part), orders,
        unnest([1, 2, 3, 4, 5]) AS s(step)
),
listed AS (
    SELECT part, filter_order, step, f, total, coalesce(removed, 0) AS removed,
        coalesce(n, 0) AS n, coalesce(alone, 0) AS alone, coalesce(good_lost, 0) AS good_lost,
        coalesce(toxic_lost, 0) AS toxic_lost
    FROM every LEFT JOIN at_step USING (part, filter_order, step) LEFT JOIN failing USING (part, f)
)
SELECT part, filter_order, step::INTEGER AS step,
    (total - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step))::BIGINT AS kept,
    removed::BIGINT AS removed, (n - removed)::BIGINT AS redundant, alone::BIGINT AS unique_fails,
    good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM listed
"""

_OP13 = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    SELECT -1, turn, role, '{_MARKED}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(length('{chat_tree.START}{chat_tree.END}') + 2 + length(role)
        + length(regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_lm_score": _OP2,
        "op3_decontamination": _OP3,
        "op4_substring_dedup": _OP4,
        "op5_jaccard_join": _OP5,
        "op8_exact_topk": _OP8,
        "op11_filter_audit": _OP11,
        "op13_chat_tree": _OP13,
    }
