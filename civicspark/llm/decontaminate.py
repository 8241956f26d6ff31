"""Benchmark decontamination by suffix arrays of the training text.

Every task sorts the suffixes of its documents (a shard of some megabytes) into a suffix array
and binary-searches all benchmark suffixes in it; equal ranges give the verbatim matches and
their places.  Documents are read once and never shuffled.  Suffixes that do not begin with as
many benchmark words as the shortest window are left out of the arrays: no match can start there.

The benchmark is sent to the tasks in blocks of at most ``BENCHMARK_BYTES`` of text, so that what
is broadcast has a fixed bound; each further block is one more pass over the documents.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is ``window``
consecutive words of an item, or the whole item if it has fewer.  Words are compared by a 64-bit
hash and their length.

Defined results: null or word-less documents have no words, no hits and are clean; null, empty or
word-less items have no windows; items with a null id count as hits but are not listed; repeated
items are one item; an empty benchmark hits nothing.  One row comes out per row of ``documents``."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.frames import cut, fresh, named
from civicspark.llm.packed import BLOCK_BYTES, text_size
from civicspark.llm.tokens import ALNUM, Words, covered, slices, words

WINDOW = 13
BENCHMARK_BYTES = 16 << 20
#: A document is contaminated when hits * this reach its words.
SHARE = 20


class Suffixes:
    """The benchmark's windows as rows of word ids, sorted; every row is the start of a suffix."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW) -> None:
        self.window = window
        found = words(pa.array([text for _, text in items], pa.string()), ALNUM, True)
        lengths = found.ends - found.starts
        self.vocabulary, at = np.unique(found.hashes, return_index=True)
        self.lengths = lengths[at]
        ids = np.searchsorted(self.vocabulary, found.hashes) + 1
        rows, owners = [], []
        for i, (item, _) in enumerate(items):
            own = ids[found.first[i] : found.first[i + 1]]
            for s in range(max(1, len(own) - window + 1) if len(own) else 0):
                rows.append(np.pad(own[s : s + window], (0, max(0, window - len(own) + s))))
                owners.append(item)
        self.ids = max(1, len(self.vocabulary))
        table = np.array(rows, np.int64).reshape(-1, window)
        unique, group = np.unique(table, axis=0, return_inverse=True)
        self.size = (unique > 0).sum(axis=1)
        self.least = int(self.size.min()) if len(unique) else 0
        self.keys = self.columns(unique)
        # of an item shorter than the window, the last key is that of the largest suffix with it
        self.last = self.columns(np.where(unique > 0, unique, self.ids))
        self.owners: list[set[str]] = [set() for _ in unique]
        for g, item in zip(group.ravel(), owners, strict=True):
            if item is not None:
                self.owners[g].add(item)

    def columns(self, rows: np.ndarray) -> list[np.ndarray]:
        """Word ids, several to a 64-bit number, so that comparing them compares the words."""
        bits = self.ids.bit_length()
        each = max(1, 63 // bits)
        out = []
        for at in range(0, self.window, each):
            key = np.zeros(len(rows), np.int64)
            for k in range(at, min(at + each, self.window)):
                key = (key << bits) | rows[:, k]
            out.append(key)
        return out

    def array_of(self, shard: Words) -> tuple[np.ndarray, list[np.ndarray]]:
        """The shard's suffix array: start words in the order of their suffixes, and the keys."""
        at = np.searchsorted(self.vocabulary, shard.hashes)
        at[at == len(self.vocabulary)] = 0
        known = (self.vocabulary[at] == shard.hashes) & (
            self.lengths[at] == shard.ends - shard.starts
        )
        ids = np.where(known, at + 1, 0)
        # known words in a row from each word on, within its text
        n = len(ids)
        stops = np.flatnonzero(~known)
        after = np.searchsorted(stops, np.arange(n))
        to = np.where(after < len(stops), np.append(stops, n)[after], n)
        to = np.minimum(to, np.repeat(shard.first[1:], shard.counts))
        run = to - np.arange(n)
        starts = np.flatnonzero(run >= max(1, self.least))
        ahead = starts[:, None] + np.arange(self.window)
        rows = np.where(np.arange(self.window) < run[starts, None], np.append(ids, 0)[
            np.minimum(ahead, n)], 0)
        keys = self.columns(rows)
        order = np.lexsort(keys[::-1])
        return starts[order], [key[order] for key in keys]

    def bounds(self, keys: list[np.ndarray], sought: list[np.ndarray], after: bool) -> np.ndarray:
        """Binary search of all sought suffixes at once."""
        low = np.zeros(len(sought[0]), np.int64)
        high = np.full(len(sought[0]), len(keys[0]), np.int64)
        while (low < high).any():
            middle = np.minimum((low + high) // 2, len(keys[0]) - 1)
            less = np.zeros(len(low), bool)
            same = np.ones(len(low), bool)
            for key, goal in zip(keys, sought, strict=True):
                less |= same & (key[middle] < goal)
                same &= key[middle] == goal
            right = (less | same if after else less) & (low < high)
            low, high = np.where(right, middle + 1, low), np.where(right, high, middle)
        return low

    def matches(self, shard: Words) -> tuple[np.ndarray, np.ndarray]:
        """Start word in the shard and number of the window of every occurrence."""
        none = np.zeros(0, np.int64)
        if not len(self.owners) or not len(shard.hashes):
            return none, none
        array, keys = self.array_of(shard)
        if not len(array):
            return none, none
        low = self.bounds(keys, self.keys, after=False)
        high = self.bounds(keys, self.last, after=True)
        found = np.flatnonzero(high > low)
        if not len(found):
            return none, none
        places = [array[low[w] : high[w]] for w in found]
        return np.concatenate(places), np.repeat(found, high[found] - low[found])


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    return edges[::2], edges[1::2]


def _search(shard: Words, index: Suffixes) -> list[tuple[int, list[dict], list[str]]]:
    """Per text: its words, the runs that are hit, the items that hit it."""
    at, window = index.matches(shard)
    hit = covered(len(shard.hashes), at, index.size[window])
    text = shard.text[at] if len(at) else at
    order = np.argsort(text, kind="stable")
    firsts = np.searchsorted(text[order], np.arange(len(shard.counts) + 1))
    out = []
    for i, n in enumerate(shard.counts):
        own = order[firsts[i] : firsts[i + 1]]
        if not len(own):
            out.append((int(n), [], []))
            continue
        begin, end = _runs(hit[shard.first[i] : shard.first[i + 1]])
        items = set().union(*(index.owners[w] for w in np.unique(window[own])))
        spans = [{"from": int(b), "to": int(e)} for b, e in zip(begin, end, strict=True)]
        out.append((int(n), spans, sorted(items)))
    return out


def _merge(one: list[dict], two: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted(one + two, key=lambda s: s["from"]):
        if out and span["from"] <= out[-1]["to"]:
            out[-1] = {"from": out[-1]["from"], "to": max(out[-1]["to"], span["to"])}
        else:
            out.append(span)
    return out


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    chosen = benchmark.select(
        named(item).cast("string").alias("item"), named(text).cast("string").alias("text")
    ).distinct()
    blocks = max(1, math.ceil(text_size(chosen) / BENCHMARK_BYTES))
    for k in range(blocks):
        part = chosen.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(r["item"], r["text"]) for r in part.collect()]


def find_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> tuple[DataFrame, tuple[str, str, str]]:
    """``documents`` with three more columns, whose names are returned too: number of words, the
    word runs ``[from, to)`` that lie in occurrences of benchmark windows, and the item ids."""
    n_words, hits, items = fresh(documents, "n_words", "hits", "items")
    found = documents.select(
        *[named(c) for c in documents.columns],
        F.lit(0).cast("long").alias(n_words),
        F.array().cast("array<struct<from:long,to:long>>").alias(hits),
        F.array().cast("array<string>").alias(items),
    )
    schema = found.schema
    blocks = list(_blocks(benchmark, item, item_text))
    for k, block in enumerate(blocks):
        sent = documents.sparkSession.sparkContext.broadcast(Suffixes(block, window))

        def search(batches, sent=sent):
            index = sent.value
            for batch in batches:
                texts = batch.column(text).cast(pa.string())
                for part in slices(texts, BLOCK_BYTES):
                    rows = batch.slice(part.start, part.stop - part.start)
                    shard = words(texts[part], ALNUM, True)
                    got = _search(shard, index)
                    before = [rows.column(c).to_pylist() for c in (hits, items)]
                    new = {
                        n_words: [n for n, _, _ in got],
                        hits: [_merge(a, s) for a, (_, s, _) in zip(before[0], got, strict=True)],
                        items: [
                            sorted({*a, *i}) for a, (_, _, i) in zip(before[1], got, strict=True)
                        ],
                    }
                    for name, values in new.items():
                        place = rows.schema.get_field_index(name)
                        field = rows.schema.field(place)
                        rows = rows.set_column(place, field, pa.array(values, field.type))
                    yield rows

        found = found.mapInArrow(search, schema)
        if k + 1 < len(blocks):
            found = cut(found)
    return found, (n_words, hits, items)


def _n_hit(hits: str):
    return F.aggregate(named(hits), F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    found, (n_words, hits, items) = find_matches(
        documents.select("doc_id", "text"), benchmark, window
    )
    return found.select(
        "doc_id",
        named(n_words).alias("n_words"),
        _n_hit(hits).alias("n_hit"),
        F.size(named(items)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(named(items))), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text"
) -> DataFrame:
    """The documents, all columns, that are not contaminated."""
    found, (n_words, hits, _) = find_matches(documents, benchmark, window, text)
    n_hit = _n_hit(hits)
    return found.filter((n_hit == 0) | (SHARE * n_hit < named(n_words))).select(
        *[named(c) for c in documents.columns]
    )
