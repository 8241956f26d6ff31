"""Stupid-backoff scores of documents under an n-gram model of the corpus, computed relationally.

1. Documents are dealt to blocks by id.  Every block counts its n-grams of all orders and deals them
   to buckets by ranges of their hashes; a bucket is one part of the count tables.
2. A bucket adds up its blocks' counts and sends each block the totals of the n-grams it asked for:
   the join of the count tables with the exploded n-grams.
3. Every block sums the scores of its documents.

A word's score is c(context + word) / c(context) for the longest context with which it occurs in
another document, times ``BACKOFF`` for every word of context given up; without context it is
c(word) / N, and 1 / (N + 1) for a word that no other document has.  All counts are those of the other
documents of the corpus: a document's own n-grams are taken off, or every n-gram would be known.
Counts cover all documents; nothing is pruned.

N-grams are identified by a 56-bit hash.  They travel packed (``packed``), each once per block and
bucket, so frequent n-grams cost no more than rare ones.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  Defined results: texts that are null
or without words have no words and score 0 in total, null per word; rows with one doc_id count as
documents of their own; an empty table gives no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.packed import bucket_count, pack, prime, text_size, unpack
from civicspark.llm.tokens import ALNUM, gram_hashes, words

ORDER = 3
BACKOFF = 0.4
#: Bytes of text in a block, about.
BLOCK_BYTES = 6 << 20

_ROWS = "bucket int, block int, payload binary"
#: The bucket that adds up the number of words.
_WORDS = -1


class Block:
    """Documents of a block and the hashes of their words."""

    def __init__(self, texts: pa.ChunkedArray) -> None:
        found = words(texts, ALNUM, True)
        self.words, self.counts = found.hashes, found.counts
        self.doc = found.text

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Last word and hash of every n-gram within a document."""
        hashes = gram_hashes(self.words, n)
        same = self.doc[: len(hashes)] == self.doc[n - 1 :] if len(hashes) else np.zeros(0, bool)
        return np.flatnonzero(same) + n - 1, hashes[same] >> np.uint64(8)

    def distinct(self, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Distinct n-grams and their counts, by order."""
        return [np.unique(self.grams(n)[1], return_counts=True) for n in range(1, order + 1)]


def _gaps(sorted_keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences; ``np.cumsum`` gives the keys back."""
    return np.diff(sorted_keys, prepend=np.uint64(0))


def _by_range(keys: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Bucket number and the positions of its keys, in order of the keys; equal ranges of 56 bits."""
    order = np.argsort(keys, kind="stable")
    bucket = ((keys[order] >> np.uint64(24)) * np.uint64(buckets)) >> np.uint64(32)
    numbers, first = np.unique(bucket, return_index=True)
    parts = np.split(order, first[1:]) if len(order) else []
    return [(int(n), at) for n, at in zip(numbers, parts, strict=True)]


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "block": pa.array([r[1] for r in rows], pa.int32()),
            "payload": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


def _own_counts(doc: np.ndarray, gram: np.ndarray, kinds: int) -> np.ndarray:
    """How often its document has each n-gram."""
    _, group, counts = np.unique(
        doc.astype(np.int64) * max(kinds, 1) + gram, return_inverse=True, return_counts=True
    )
    return counts[group.ravel()]


def _word_scores(block: Block, totals: list[np.ndarray], keys: list[np.ndarray], n_all: int):
    """Natural log of every word's score."""
    size = len(block.words)
    others = n_all - block.counts[block.doc]
    score = np.full(size, np.nan)
    before = np.zeros(0)
    for n, (total, key) in enumerate(zip(totals, keys, strict=True), 1):
        last, hashes = block.grams(n)
        gram = np.searchsorted(key, hashes)
        count = np.zeros(size)
        count[last] = total[gram].astype(np.int64) - _own_counts(block.doc[last], gram, len(key))
        if n == 1:
            score = np.where(
                count > 0, np.log(np.maximum(count, 1)) - np.log(np.maximum(others, 1)),
                -np.log(others + 1.0),
            )
        else:
            known = count[last] > 0
            backed = score[last] + np.log(BACKOFF)
            # the context is the (n - 1)-gram that ends at the word before
            context = np.maximum(before[last - 1], 1)
            score[last] = np.where(
                known, np.log(np.maximum(count[last], 1)) - np.log(context), backed
            )
        before = count
    return score


def scores(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, log_score (natural logarithms, summed) and
    word_score, the mean per word."""
    size = text_size(documents)
    blocks = prime(size / BLOCK_BYTES)
    buckets = bucket_count(size / 6 * order * 0.6)
    dealt = (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
        )
        .withColumn(
            "block",
            F.pmod(F.coalesce("doc_id", F.xxhash64("text")), F.lit(blocks).cast("long")).cast("int"),
        )
        .groupBy("block")
    )

    def explode(table: pa.Table) -> pa.Table:
        own = Block(table.column("text"))
        found = own.distinct(order)
        keys = np.concatenate([k for k, _ in found])
        counts = np.concatenate([c for _, c in found]).astype(np.uint32)
        name = table.column("block")[0].as_py()
        rows = [(_WORDS, name, pack(np.zeros(0, np.uint64), np.array([len(own.words)])))]
        rows += [
            (b, name, pack(_gaps(keys[at]), counts[at])) for b, at in _by_range(keys, buckets)
        ]
        return _table(rows)

    def add_up(table: pa.Table) -> pa.Table:
        bucket, names = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
        payloads = [unpack(p) for p in table.column("payload").to_pylist()]
        counts = np.concatenate([c for _, c in payloads])
        if bucket == _WORDS:
            total = pack(np.array([counts.sum()]))
            return _table([(bucket, name, total) for name in names])
        keys = np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _ in payloads])
        _, group = np.unique(keys, return_inverse=True)
        totals = np.bincount(group.ravel(), weights=counts).astype(np.uint64)[group.ravel()]
        parts = np.split(totals, np.cumsum([len(k) for k, _ in payloads])[:-1])
        return _table([(bucket, name, pack(p)) for name, p in zip(names, parts, strict=True)])

    def score(_, table: pa.Table, answers: pa.Table) -> pa.Table:
        own = Block(table.column("text"))
        keys = [k for k, _ in own.distinct(order)]
        joined = np.concatenate(keys)
        got = dict(
            zip(answers.column("bucket").to_pylist(), answers.column("payload"), strict=True)
        )
        total = np.zeros(len(joined), np.uint32)
        for bucket, at in _by_range(joined, buckets):
            total[at] = unpack(got[bucket].as_py())[0]
        totals = np.split(total, np.cumsum([len(k) for k in keys])[:-1])
        n_all = int(unpack(got[_WORDS].as_py())[0][0])
        each = _word_scores(own, totals, keys, n_all)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(own.counts, pa.int64()),
                "log_score": pa.array(np.bincount(own.doc, each, len(own.counts)), pa.float64()),
            }
        )

    totals = dealt.applyInArrow(explode, _ROWS).groupBy("bucket").applyInArrow(add_up, _ROWS)
    scored = dealt.cogroup(totals.groupBy("block")).applyInArrow(
        score, "doc_id long, n_words long, log_score double"
    )
    return scored.withColumn("word_score", F.try_divide("log_score", "n_words"))
