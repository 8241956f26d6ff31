"""Exact top-k by inner product: norm-sorted vectors, rotated partial sums, residual bounds.

Vectors are turned into integers, so scores and ties are exact.  The second-moment matrix of all
vectors, summed over the cluster, gives the rotation (its singular vectors) that gathers most of
the length in the first coordinates.

Queries come in blocks of bounded size, which are sent to all tasks.  For each block:

1. the ``HEAD`` longest vectors of the table are scored in full; the k-th best of them is a lower
   bound for each query's k-th best score;
2. every task walks its vectors, batch by batch, by descending length.  A vector is left out as soon as
   |q| |v| < bound; else the partial sum over the first ``LEAD`` rotated coordinates plus the
   product of the two remaining lengths (Cauchy-Schwarz) must reach the bound.  Bounds are kept
   with a margin above the rounding error.  What is left is scored in full, in integers, and
   raises the bound for the rest of the batch;
3. the batches' best are ranked together.

The result does not depend on the pruning.  Defined results: vectors that are null, empty, or hold
null or non-finite components take no part.  Scores are exact however large the components; scaled
components and scores that 64 bits cannot hold count as the nearest number that they can.  Vectors of different length are not compared.
A row whose id is null is a candidate only and ranks last among ties.  Every row is a candidate of
its own, also if it repeats another.  Rows with the id of a query are the query's own and not its
candidates; if they differ, their best together are that query's."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.llm.frames import cut

#: Queries in a block, at most.
QUERIES = 4096
#: Longest vectors that give the first bounds.
HEAD = 2048
#: Rotated coordinates of the partial sums.
LEAD = 16
#: Vectors scored at a time.
STEP = 512
#: The largest score; no score is smaller than its negative.
MOST = 2**63 - 1

_VECTORS = "id long, own boolean, ints array<long>"
_SCORES = "query_id long, vec_id long, score long"


def integers(vectors: DataFrame, id_: str, vector: str, scale: int, query: Column) -> DataFrame:
    """``id, own, ints``: the vectors that take part; ``own`` marks the queries."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall(
        F.col(vector),
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) != math.inf),
    )
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & finite
    return vectors.filter(F.coalesce(usable, F.lit(False))).select(
        F.col(id_).cast("long").alias("id"),
        F.coalesce(query, F.lit(False)).alias("own"),
        scaled.cast("array<long>").alias("ints"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, width)


def _moments(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of outer products of all vectors: one small matrix per task, added up."""

    def outer(batches):
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch.column("ints"), width).astype(float)
            total += rows.T @ rows
        cells = total.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], ["cell", "value"]
        )

    parts = vectors.mapInArrow(outer, "cell int, value double")
    rows = parts.groupBy("cell").agg(F.sum("value")).collect()
    out = np.zeros(width * width)
    for cell, value in rows:
        out[cell] = value
    return out.reshape(width, width)


class Queries:
    """A block of queries with what the bounds need."""

    def __init__(self, ids: list[int], rows: np.ndarray, rotation: np.ndarray, k: int) -> None:
        self.ids, self.rows, self.rotation, self.k = np.array(ids, np.int64), rows, rotation, k
        self.lead = rows @ rotation[:, :LEAD]
        self.length = np.linalg.norm(rows.astype(float), axis=1)
        self.rest = _rest(self.length, self.lead)
        self.bound = np.full(len(ids), -np.inf)

    def raise_bounds(self, scores: np.ndarray) -> None:
        if scores.shape[1] >= self.k:
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            self.bound = np.maximum(self.bound, kth)


def _rest(length: np.ndarray, lead: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, length**2 - (lead**2).sum(axis=1)))


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products without rounding: by floats while all sums are whole in 53 bits, by 64-bit
    numbers while they fit, and one by one where components are so large that they may not."""
    most_q = np.abs(queries.astype(float)).max(axis=1, initial=0)
    most_r = np.abs(rows.astype(float)).max(axis=1, initial=0)
    width = queries.shape[1]
    if most_q.max(initial=0) * most_r.max(initial=0) * width < 2**53:
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    out = queries @ rows.T
    for q, r in np.argwhere(np.outer(most_q, most_r) * width >= 2**62):
        total = sum(a * b for a, b in zip(queries[q].tolist(), rows[r].tolist(), strict=True))
        out[q, r] = max(-MOST, min(MOST, total))
    return out


def _best(q: np.ndarray, v: np.ndarray, s: np.ndarray, none: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best: by score, then known ids ascending."""
    order = np.lexsort((v, none, -s, q))
    sorted_q = q[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_q[1:] != sorted_q[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


def _task_best(batch: pa.RecordBatch, block: Queries, width: int) -> pa.RecordBatch:
    rows = _matrix(batch.column("ints"), width)
    none = np.asarray(batch.column("id").is_null())
    ids = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False)
    length = np.linalg.norm(rows.astype(float), axis=1)
    order = np.argsort(-length, kind="stable")
    bound = block.bound.copy()
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(order), STEP):
        part = order[at : at + STEP]
        # rounding of the rotated sums is far below this share of |q||v|
        slack = 1 + 1e-9 * block.length * length[part[0]]
        alive = np.flatnonzero(block.length * length[part[0]] + slack >= bound)
        if not len(alive):
            break
        lead = rows[part] @ block.rotation[:, :LEAD]
        most = block.lead[alive] @ lead.T + np.outer(block.rest[alive], _rest(length[part], lead))
        near = most + slack[alive][:, None] >= bound[alive][:, None]
        seen = near.any(axis=0)
        if not seen.any():
            continue
        part, near = part[seen], near[:, seen]
        scores = _exact(block.rows[alive], rows[part])
        other = (block.ids[alive][:, None] != ids[part][None, :]) | none[part][None, :]
        q, v = np.nonzero(near & other & (scores >= bound[alive][:, None]))
        keep = _best(q, ids[part][v], scores[q, v], none[part][v], block.k)
        q, v = q[keep], v[keep]
        found.append((alive[q], ids[part][v], scores[q, v], none[part][v]))
        if len(q):
            counts = np.bincount(q, minlength=len(alive))
            least = np.full(len(alive), np.iinfo(np.int64).max)
            np.minimum.at(least, q, scores[q, v])
            full = counts >= block.k
            bound[alive[full]] = np.maximum(bound[alive[full]], least[full])
    if found:
        q, v, s, n = (np.concatenate(c) for c in zip(*found, strict=True))
        keep = _best(q, v, s, n, block.k)
        q, v, s, n = q[keep], v[keep], s[keep], n[keep]
    else:
        q = v = s = np.zeros(0, np.int64)
        n = np.zeros(0, bool)
    return pa.RecordBatch.from_arrays(
        [pa.array(block.ids[q]), pa.array(v, pa.int64(), mask=n), pa.array(s)],
        ["query_id", "vec_id", "score"],
    )


def _of_width(vectors: DataFrame, width: int, k: int, n_queries: int) -> DataFrame:
    spark = vectors.sparkSession
    vectors = vectors.filter(F.size("ints") == width)
    _, _, rotation = np.linalg.svd(_moments(vectors, width))
    length = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    # the lengths alone first, so that each task then hands on few vectors
    lengths = vectors.select(length.alias("length")).orderBy(F.desc("length")).limit(HEAD)
    least = lengths.agg(F.min("length")).first()[0]
    longest = vectors.filter(length >= least).orderBy(length.desc(), "id").limit(HEAD).collect()
    head = np.array([r["ints"] for r in longest], np.int64).reshape(-1, width)
    head_ids = np.array([-1 if r["id"] is None else r["id"] for r in longest])
    unknown = np.array([r["id"] is None for r in longest])
    out = None
    parts = math.ceil(n_queries / QUERIES)
    own = vectors.filter("own").select("id", "ints").distinct()
    for part in range(parts):
        chosen = own.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).collect()
        if not chosen:
            continue
        block = Queries(
            [r["id"] for r in chosen],
            np.array([r["ints"] for r in chosen], np.int64),
            rotation.T,
            k,
        )
        scores = _exact(block.rows, head).astype(float)
        scores[(block.ids[:, None] == head_ids[None, :]) & ~unknown[None, :]] = -np.inf
        block.raise_bounds(scores)
        sent = spark.sparkContext.broadcast(block)

        def best(batches, sent=sent):
            for batch in batches:
                yield _task_best(batch, sent.value, width)

        found = vectors.select("id", "ints").mapInArrow(best, _SCORES)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], _SCORES)


def top_k(
    vectors: DataFrame, query: Column, k: int = 5, scale: int = 256, id_: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of every row that ``query`` marks."""
    spark = vectors.sparkSession
    usable = cut(integers(vectors, id_, vector, scale, query & F.col(id_).isNotNull()))
    widths = (
        usable.groupBy(F.size("ints").alias("width"))
        .agg(F.count_if("own").alias("queries"))
        .filter("queries > 0")
        .collect()
    )
    found = spark.createDataFrame([], _SCORES)
    for row in widths:
        found = found.unionByName(_of_width(usable, row["width"], k, row["queries"]))
    ranked = Window.partitionBy("query_id").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    )
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
