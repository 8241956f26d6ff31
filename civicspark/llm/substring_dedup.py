"""Substring dedup: documents are streamed through suffix automata of reference passages.

A word is removed when it lies in a window of ``window`` words that also starts in a document with a
smaller doc_id.  The reference of a window is the document with the smallest id that holds it.

1. Seeds: every window elects its smallest run of ``SEED`` words by hash, so that equal windows
   elect the same run.  Seeds that only one document has are dropped; most text ends here.
2. Windows around the other seeds meet by hash, which gives each its reference document.
3. Reference passages, runs of words that other documents repeat, are dealt to shards of bounded
   size; passages that very many documents repeat are sent to several shards, as many as keep
   the documents per copy below ``PER_COPY``.  Each shard builds the suffix automaton of its
   passages, in order of doc_id, so that a state's first passage is its smallest document.
4. The documents' passages stream through the automaton of their shard.  Where the match is
   ``window`` words or longer, and its state was first seen in a smaller document, the words go;
   overlapping matches join to maximal spans.

Hashes only choose what is compared; the automata compare words themselves.  Documents are dealt to
blocks once, by id; keys travel packed (``packed``).

Words: ``[^\\x20\\x09-\\x0D]+``, unchanged.  doc_id must be an integer.  Defined results: null or
word-less texts have no words; a document with null doc_id is neither smaller nor larger than any,
so it keeps all its words and is no reference; rows with one doc_id are one document for the
comparison, but each comes out as a row of its own."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.packed import (
    BLOCK_BYTES,
    bucket_count,
    by_bucket,
    merged,
    pack,
    prime,
    run_starts,
    text_size,
)
from civicspark.llm.tokens import SPACED, Words, covered, gram_hashes, mix, slices, whole_grams, words

WINDOW = 13
#: Words of a seed.
SEED = 6
#: Corpus words per shard of reference passages; what is repeated of them is built and streamed.
SHARD_WORDS = 500_000
#: Documents whose passages one copy of a reference passage serves.
PER_COPY = 256

_ROW = "bucket int, payload binary"


def _packed_rows(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([b for b, _ in rows], pa.int32()),
            "payload": pa.array([p for _, p in rows], pa.binary()),
        }
    )


def _to_buckets(keys: np.ndarray, buckets: int, *values: np.ndarray) -> pa.Table:
    return _packed_rows(
        [(b, pack(keys[at], *(v[at] for v in values))) for b, at in by_bucket(keys, buckets)]
    )


def _to_blocks(docs: np.ndarray, blocks: int, *values: np.ndarray) -> list[tuple[int, bytes]]:
    block = np.mod(docs, blocks)
    order = np.lexsort((docs, block))
    starts = run_starts(block[order])
    parts = np.split(order, starts[1:]) if len(starts) else []
    return [(int(block[at[0]]), pack(docs[at], *(v[at] for v in values))) for at in parts]


def _seeds(found: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows' start words, their seeds' start words, and the hash of the seed at every word."""
    starts, _ = whole_grams(found, window) if len(found.hashes) >= window else ([], [])
    starts = np.asarray(starts, np.int64)
    size = min(SEED, window)
    hashes = gram_hashes(found.hashes, size)
    at = starts.copy()
    least = hashes[starts] if len(starts) else np.zeros(0, np.uint64)
    for k in range(1, window - size + 1):
        here = hashes[starts + k]
        less = here < least
        least = np.where(less, here, least)
        at = np.where(less, starts + k, at)
    return starts, at, hashes


class Automaton:
    """Suffix automaton of passages, given in ascending order of their documents."""

    def __init__(self) -> None:
        self.after: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.doc = [-1]

    def _state(self, after: dict, link: int, size: int, doc: int) -> int:
        self.after.append(after)
        self.link.append(link)
        self.size.append(size)
        self.doc.append(doc)
        return len(self.size) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state of the shorter strings of ``q`` that end with ``word`` after ``p``."""
        twin = self._state(dict(self.after[q]), self.link[q], self.size[p] + 1, self.doc[q])
        self.link[q] = twin
        while p >= 0 and self.after[p].get(word) == q:
            self.after[p][word] = twin
            p = self.link[p]
        return twin

    def add(self, passage: list[bytes], doc: int) -> None:
        last = 0
        for word in passage:
            known = self.after[last].get(word)
            if known is not None:
                whole = self.size[known] == self.size[last] + 1
                last = known if whole else self._split(last, word, known)
                continue
            new = self._state({}, 0, self.size[last] + 1, doc)
            p = last
            while p >= 0 and word not in self.after[p]:
                self.after[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.after[p][word]
                whole = self.size[q] == self.size[p] + 1
                self.link[new] = q if whole else self._split(p, word, q)
            last = new

    def first_docs(self, passage: list[bytes], window: int) -> np.ndarray:
        """For each word, the smallest document that holds the window ending there, or -1."""
        after, link, size, doc = self.after, self.link, self.size, self.doc
        out = np.full(len(passage), -1, np.int64)
        state = length = 0
        for i, word in enumerate(passage):
            while state and word not in after[state]:
                state = link[state]
                length = size[state]
            if word in after[state]:
                state = after[state][word]
                length += 1
                if length >= window:
                    # only the last ``window`` words matter from here on
                    length = window
                    while size[link[state]] >= window:
                        state = link[state]
                    out[i] = doc[state]
        return out


def _doc_rows(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Rows that have a doc_id, and the ids."""
    rows = table.filter(table.column("doc_id").is_valid())
    return rows, rows.column("doc_id").to_numpy()


def _answers(table: pa.Table) -> list[np.ndarray] | None:
    payloads = table.column("payload").to_pylist()
    return merged(payloads) if payloads else None


def _flagged_rows(docs: pa.Table, marked: np.ndarray) -> list[tuple[pa.Table, np.ndarray]]:
    """Blocks of the rows whose documents are marked, with their ids."""
    rows, ids = _doc_rows(docs)
    keep = np.isin(ids, marked)
    rows, ids = rows.filter(pa.array(keep)), ids[keep]
    column = rows.column("text")
    return [
        (rows.slice(s.start, s.stop - s.start), ids[s]) for s in slices(column, BLOCK_BYTES)
    ]


def _row_key(text: str | None) -> int:
    digest = hashlib.blake2b((text or "").encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _places(found: Words, ids: np.ndarray, doc: np.ndarray, pos: np.ndarray):
    """Word numbers in the block of the given words of documents, for every row of the document,
    and which entry each is."""
    order = np.argsort(doc, kind="stable")
    low = np.searchsorted(doc[order], ids, "left")
    high = np.searchsorted(doc[order], ids, "right")
    sizes = high - low
    entry = np.repeat(low - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    entry = order[entry.astype(np.int64)]
    row = np.repeat(np.arange(len(ids)), sizes)
    inside = pos[entry] < found.counts[row]
    return (found.first[row] + pos[entry])[inside], entry[inside], row[inside]


def repeats(documents: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, n_removed, kept_sha256 and, if ``texts``, kept:
    the words that stay, joined by one space."""
    size = text_size(documents)
    corpus_words = size / 6
    blocks = prime(size / BLOCK_BYTES)
    seed_buckets = bucket_count(corpus_words / 4)
    window_buckets = bucket_count(corpus_words / 2)
    shards = max(64, math.ceil(corpus_words / SHARD_WORDS))
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    dealt = docs.withColumn(
        "block",
        F.pmod(F.coalesce("doc_id", F.xxhash64("text")), F.lit(blocks).cast("long")).cast("int"),
    ).groupBy("block")

    def seeds(batches):
        for batch in batches:
            rows, ids = _doc_rows(pa.Table.from_batches([batch]))
            column = rows.column("text")
            for part in slices(column, BLOCK_BYTES):
                found = words(column[part], SPACED, False)
                _, at, hashes = _seeds(found, window)
                at = np.unique(at)
                text = found.text[at]
                pos = (at - found.first[text]).astype(np.int32)
                sent = _to_buckets(hashes[at], seed_buckets, ids[part][text], pos)
                yield from sent.to_batches()

    def repeated_seeds(table: pa.Table) -> pa.Table:
        seed, doc, pos = merged(table.column("payload").to_pylist())
        order = np.lexsort((doc, seed))
        seed, doc, pos = seed[order], doc[order], pos[order]
        starts = run_starts(seed)
        ends = np.r_[starts[1:], len(seed)]
        more = np.repeat(doc[starts] != doc[ends - 1], ends - starts)
        return _packed_rows(_to_blocks(doc[more], blocks, pos[more]))

    def windows(_, docs: pa.Table, answers: pa.Table) -> pa.Table:
        got = _answers(answers)
        out = []
        for rows, ids in _flagged_rows(docs, got[0]) if got else ():
            found = words(rows.column("text"), SPACED, False)
            starts, at, _ = _seeds(found, window)
            marked = np.zeros(len(found.hashes), bool)
            marked[_places(found, ids, *got)[0]] = True
            starts = starts[marked[at]]
            hashes = gram_hashes(found.hashes, window)[starts]
            text = found.text[starts]
            pos = (starts - found.first[text]).astype(np.int32)
            out.append(_to_buckets(hashes, window_buckets, ids[text], pos))
        return pa.concat_tables(out) if out else _packed_rows([])

    def owned(table: pa.Table) -> pa.Table:
        """For repeated windows: where they are, whose they are, and at which copy of the owner."""
        key, doc, pos = merged(table.column("payload").to_pylist())
        order = np.lexsort((pos, doc, key))
        key, doc, pos = key[order], doc[order], pos[order]
        starts = run_starts(key)
        sizes = np.diff(np.r_[starts, len(key)])
        owner = np.repeat(doc[starts], sizes)
        asks = doc != owner
        asking = np.add.reduceat(asks, starts) if len(starts) else starts
        copies = 1 << np.ceil(np.log2(np.maximum(1, asking / PER_COPY))).astype(np.int64)
        each = np.repeat(copies, sizes)
        copy = (mix(doc.view(np.uint64)) % each.astype(np.uint64)).astype(np.int32)
        # the owner's first place of the window, once for every copy
        first = starts[asking > 0]
        many = copies[asking > 0]
        serial = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        doc = np.r_[doc[asks], np.repeat(doc[first], many)]
        pos = np.r_[pos[asks], np.repeat(pos[first], many)]
        owner = np.r_[owner[asks], np.repeat(owner[first], many)]
        copy = np.r_[copy[asks], serial.astype(np.int32)]
        return _packed_rows(_to_blocks(doc, blocks, pos, owner, copy))

    def passages(_, docs: pa.Table, answers: pa.Table) -> pa.Table:
        columns = ("shard", "doc", "row", "start", "owner", "passage")
        out: dict[str, list] = {c: [] for c in columns}
        got = _answers(answers)
        for rows, ids in _flagged_rows(docs, got[0]) if got else ():
            column = rows.column("text")
            found = words(column, SPACED, False)
            at, entry, row = _places(found, ids, got[0], got[1])
            owner, copy = got[2][entry], got[3][entry]
            order = np.lexsort((at, copy, owner, row))
            at, row, owner, copy = at[order], row[order], owner[order], copy[order]
            new = np.ones(len(at), bool)
            new[1:] = (
                (row[1:] != row[:-1]) | (owner[1:] != owner[:-1]) | (copy[1:] != copy[:-1])
                | (at[1:] > at[:-1] + window)
            )
            firsts = np.flatnonzero(new)
            lasts = np.r_[firsts[1:], len(at)] - 1
            keys: dict[int, int] = {}
            shard = mix(owner.view(np.uint64) * np.uint64(64) + copy.astype(np.uint64))
            for a, b in zip(firsts, lasts, strict=True):
                r, begin = int(row[a]), int(at[a])
                # another row of the document may be longer than this one
                end = min(int(at[b]) + window, int(found.first[r + 1]))
                if r not in keys:
                    keys[r] = _row_key(column[r].as_py())
                out["shard"].append(int(shard[a] % np.uint64(shards)))
                out["doc"].append(int(ids[r]))
                out["row"].append(keys[r])
                out["start"].append(begin - int(found.first[r]))
                out["owner"].append(int(owner[a]))
                out["passage"].append(
                    found.data[found.starts[begin] : found.ends[end - 1]].tobytes()
                )
        return pa.table(
            {
                "shard": pa.array(out["shard"], pa.int32()),
                "doc": pa.array(out["doc"], pa.int64()),
                "row": pa.array(out["row"], pa.int64()),
                "start": pa.array(out["start"], pa.int32()),
                "owner": pa.array(out["owner"], pa.int64()),
                "passage": pa.array(out["passage"], pa.binary()),
            }
        )

    def stream(table: pa.Table) -> pa.Table:
        """Spans of the documents' passages that the shard's reference passages hold."""
        doc, row, start, owner = (
            table.column(c).to_numpy() for c in ("doc", "row", "start", "owner")
        )
        passage = table.column("passage")
        automaton = Automaton()
        mine = np.flatnonzero(doc == owner)
        for i in mine[np.argsort(doc[mine], kind="stable")]:
            automaton.add(passage[int(i)].as_py().split(), int(doc[i]))
        known: dict[bytes, np.ndarray] = {}
        spans: list[tuple[int, int, int, int]] = []
        for i in np.flatnonzero(doc != owner):
            text = passage[int(i)].as_py()
            first = known.get(text)
            if first is None:
                first = known[text] = automaton.first_docs(text.split(), window)
            ends = np.flatnonzero((first >= 0) & (first < doc[i]))
            hit = covered(len(first), ends - window + 1, window)
            edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8))) + start[i]
            spans += [
                (doc[i], row[i], a, b) for a, b in zip(edges[::2], edges[1::2], strict=True)
            ]
        columns = np.array(spans, np.int64).reshape(-1, 4).T
        return _packed_rows(
            _to_blocks(
                columns[0], blocks, columns[1], columns[2].astype(np.int32),
                columns[3].astype(np.int32),
            )
        )

    def cut_out(_, docs: pa.Table, answers: pa.Table) -> pa.Table:
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        got = _answers(answers)
        for d, r, a, b in zip(*got, strict=True) if got else ():
            spans.setdefault((int(d), int(r)), []).append((int(a), int(b)))
        marked = {d for d, _ in spans}
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": []}
        out |= {"kept": []} if texts else {}
        for doc, text in zip(docs.column("doc_id"), docs.column("text"), strict=True):
            value = text.as_py()
            own = (value or "").encode().split()
            key = (doc.as_py(), _row_key(value)) if doc.as_py() in marked else None
            kept = own
            if key in spans:
                gone = np.zeros(len(own), bool)
                for a, b in spans[key]:
                    gone[a:b] = True
                kept = [own[i] for i in np.flatnonzero(~gone)]
            joined = b" ".join(kept)
            out["n_words"].append(len(own))
            out["n_removed"].append(len(own) - len(kept))
            out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
            if texts:
                out["kept"].append(joined.decode())
        counts, strings = pa.int64(), pa.string()
        kinds = {"n_words": counts, "n_removed": counts, "kept_sha256": strings, "kept": strings}
        return pa.table(
            {"doc_id": docs.column("doc_id")} | {c: pa.array(v, kinds[c]) for c, v in out.items()}
        )

    flagged = (
        docs.mapInArrow(seeds, _ROW).groupBy("bucket").applyInArrow(repeated_seeds, _ROW)
    )
    meetings = dealt.cogroup(flagged.groupBy("bucket")).applyInArrow(windows, _ROW)
    owners = meetings.groupBy("bucket").applyInArrow(owned, _ROW)
    pieces = dealt.cogroup(owners.groupBy("bucket")).applyInArrow(
        passages, "shard int, doc long, row long, start int, owner long, passage binary"
    )
    spans = pieces.groupBy("shard").applyInArrow(stream, _ROW)
    return dealt.cogroup(spans.groupBy("bucket")).applyInArrow(
        cut_out,
        "doc_id long, n_words long, n_removed long, kept_sha256 string"
        + ", kept string" * texts,
    )
