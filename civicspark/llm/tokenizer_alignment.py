"""Alignment of two tokenizers over the same texts, and counts of the pairs they link.

Both tokenizers cut the same bytes.  All tokens are sorted by where they start, the running maximum
of their ends says how far the tokens so far reach, and a group ends where the next token starts
there: both tokenizers have a boundary at that byte.  Tokens of a group that overlap are linked.

Pairs of ids are counted over the whole corpus.  Texts are handled in blocks: a block sends each
of its different pairs once, gets their counts back by a join, and adds them up per document."""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.frames import importable, named
from civicspark.llm.packed import pack, unpack
from civicspark.llm.tokens import slices
from civicspark.session import materialize

#: Where the public tokenizers lie; a parameter of everything here.
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"

#: How a byte-level vocabulary of this kind cuts a text into words.
BYTE_LEVEL_CUT = {
    "type": "ByteLevel",
    "add_prefix_space": False,
    "trim_offsets": True,
    "use_regex": True,
}
BYTE_LEVEL_WORD = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: Bytes of text tokenized at a time, and gathered into one block of pairs.
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
#: Ids of the second tokenizer take the low bits of a pair.
_LOW = 20


def _unmapped() -> dict[str, int]:
    """The byte of every character that a byte-level vocabulary writes it as: printable Latin-1
    signs stand for themselves, the other bytes follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """The first tokenizer: byte-level BPE, special tokens' strings being plain text.

    Two engines give the same ids from the same file.  The faster one merges neighbours whenever
    they make a token, the other one only by the listed merges; where ids follow the order of the
    merges and every token is made by merging its own bytes, that is the same.  It also has Unicode
    tables of its own, so it only takes texts of characters below U+0280, whose classes have long
    been settled, and its search for words fails on very long white space, which it does not get."""

    def __init__(self, path: str):
        # Spark runs one task per core, so a task takes one thread.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        of_char = _unmapped()
        size = self._tokenizer.get_vocab_size()
        self.table = [
            bytes(of_char[c] for c in token)
            if all(c in of_char for c in token)
            else token.encode()
            for token in map(self._tokenizer.id_to_token, range(size))
        ]
        self._fast = self._fast_engine(path)

    def _fast_engine(self, path: str):
        with open(path) as file:
            stored = json.load(file)
        model, cut = stored["model"], stored["pre_tokenizer"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
        ids = [model["vocab"].get("".join(pair)) for pair in pairs]
        added = {token["id"] for token in stored["added_tokens"]}
        plain = cut == BYTE_LEVEL_CUT and stored["normalizer"] is None
        if not plain or None in ids or ids != sorted(ids):
            return None
        from tiktoken import Encoding

        ranks = {token: k for k, token in enumerate(self.table) if k not in added}
        return Encoding(
            "byte level", pat_str=BYTE_LEVEL_WORD, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._fast is None:
            return self.encode_by_merges(texts)
        out = [
            self._fast.encode_ordinary(text) if _settled(text) else None for text in texts
        ]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, self.encode_by_merges([texts[k] for k in rest]), strict=True):
            out[k] = ids
        return out

    def encode_by_merges(self, texts: list[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [encoding.ids for encoding in found]


_LONG_SPACE = re.compile(r"\s{10000}")


def _settled(text: str) -> bool:
    """Whether the faster engine takes ``text``."""
    if not text.isascii() and max(text) >= "\u0280":
        return False
    return len(text) < 10_000 or _LONG_SPACE.search(text) is None


class Pieces:
    """The second tokenizer: BPE pieces with byte fallback, which adds a space in front."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._tokenizer = SentencePieceProcessor(model_file=path)
        self.table = []
        for k in range(self._tokenizer.get_piece_size()):
            piece = self._tokenizer.id_to_piece(k)
            if self._tokenizer.is_byte(k):
                self.table.append(bytes([int(piece[3:5], 16)]))
            else:
                self.table.append(piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._tokenizer.encode(texts, num_threads=1)


@dataclass
class Alignment:
    """Links of a run of texts.  ``a`` and ``b`` are token numbers, ``text`` the text of a link."""

    n_a: np.ndarray  # per text
    n_b: np.ndarray
    n_groups: np.ndarray
    text: np.ndarray  # per link
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray  # the group of every token
    group_b: np.ndarray


def align(
    length_a: np.ndarray, text_a: np.ndarray, length_b: np.ndarray, text_b: np.ndarray, texts: int
) -> Alignment:
    """Align the tokens of ``texts`` texts, laid end to end; the tokens of both sides, given by
    their byte lengths and texts, cover the same bytes of every text."""
    end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
    start_a, start_b = end_a - length_a, end_b - length_b
    start = np.concatenate([start_a, start_b])
    end = np.concatenate([end_a, end_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(end_a), len(end_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), bool)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    group_a, group_b = group[: len(end_a)], group[len(end_a) :]
    # Within its group a token overlaps a run of the other side's tokens.
    low = np.searchsorted(end_b, start_a, "right")
    high = np.searchsorted(start_b, end_a, "left")
    n = high - low
    a = np.repeat(np.arange(len(end_a)), n)
    b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    # Every group begins with a token of either side, so those of one side count them.
    firsts = np.flatnonzero(np.diff(group_a, prepend=-1))
    return Alignment(
        np.bincount(text_a, minlength=texts),
        np.bincount(text_b, minlength=texts),
        np.bincount(text_a[firsts], minlength=texts),
        text_a[a],
        a,
        b,
        group_a,
        group_b,
    )


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all ids, left-aligned, and how many there are."""
    written = [str(k).encode() for k in range(size)]
    width = max(map(len, written))
    table = np.frombuffer(b"".join(w.ljust(width) for w in written), np.uint8)
    return table.reshape(size, width), np.array([len(w) for w in written])


class GroupNames:
    """Groups written as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, ids: int):
        self._digits, self._lengths = _digits(ids)

    def digests(self, ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment) -> list[str]:
        """SHA-256 of every text's groups; '' for texts without tokens."""
        side = np.repeat(np.array([0, 1]), [len(ids_a), len(ids_b)])
        group = np.concatenate([found.group_a, found.group_b])
        # Groups follow the texts, so this also puts the texts in order.
        order = np.argsort(2 * group + side, kind="stable")
        ids = np.concatenate([ids_a, ids_b])[order]
        side, group = side[order], group[order]
        width = self._digits.shape[1]
        cells = np.empty((len(ids), width + 1), np.uint8)
        cells[:, :width] = self._digits[ids]
        lengths = self._lengths[ids]
        after = np.full(len(ids), ord(","), np.uint8)
        after[:-1][(side[1:] != side[:-1])] = ord("|")
        after[:-1][group[1:] != group[:-1]] = ord(";")
        cells[np.arange(len(ids)), lengths] = after
        text = cells[np.arange(width + 1) <= lengths[:, None]].tobytes()
        stops = np.concatenate([[0], np.cumsum(lengths + 1)])
        ends = np.cumsum(found.n_a + found.n_b)
        out = []
        for low, high in zip(ends - found.n_a - found.n_b, ends, strict=True):
            written = text[stops[low] : stops[high] - 1] if high > low else b""
            out.append(hashlib.sha256(written).hexdigest() if high > low else "")
        return out


class Aligner:
    """Both tokenizers, and what they make of a list of texts."""

    def __init__(self, first: ByteLevel, second: Pieces):
        self.first, self.second = first, second
        self._size_a = np.array([len(t) for t in first.table])
        self._size_b = np.array([len(t) for t in second.table])
        self._names = GroupNames(max(len(first.table), len(second.table)))
        if len(second.table) > 1 << _LOW:
            raise ValueError("vocabulary too large")

    def _whole(self, ids: list[int], table: list[bytes], wanted: bytes) -> bool:
        return b"".join([table[k] for k in ids]) == wanted

    def __call__(self, texts: list[str | None]) -> tuple[Alignment, list[str], np.ndarray]:
        """The alignment, the digests of the groups, and the id pair of every link."""
        spaced = [" " + text if text else "" for text in texts]
        lists_a = self.first.encode(spaced)
        lists_b = self.second.encode([text or "" for text in texts])
        for k, text in enumerate(spaced):
            wanted = text.encode()
            if not (
                text
                and self._whole(lists_a[k], self.first.table, wanted)
                and self._whole(lists_b[k], self.second.table, wanted)
            ):
                lists_a[k], lists_b[k] = [], []
        ids_a, text_a = _joined(lists_a)
        ids_b, text_b = _joined(lists_b)
        found = align(self._size_a[ids_a], text_a, self._size_b[ids_b], text_b, len(texts))
        pairs = (ids_a[found.a] << _LOW) | ids_b[found.b]
        return found, self._names.digests(ids_a, ids_b, found), pairs


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(ids) for ids in lists]
    ids = np.fromiter(itertools.chain.from_iterable(lists), np.int64, sum(sizes))
    return ids, np.repeat(np.arange(len(lists)), sizes)


def aligner(folder: str, first: str, second: str) -> Callable[[], Aligner]:
    """Load the tokenizers where it is called, so that no task is sent a vocabulary."""
    return lambda: Aligner(
        ByteLevel(os.path.join(folder, first)), Pieces(os.path.join(folder, second))
    )


_DOCUMENT = "struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string>"
_BLOCK = f"block long, documents array<{_DOCUMENT}>, pairs array<long>, times array<long>, uses binary"


def _blocks(load: Callable[[], Aligner], block_bytes: int):
    """Documents to rows of one block each: what is known per document, the block's different
    pairs with their numbers of links, and who uses which of them how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, block, done, size = load(), 0, _Block(), 0
        partition = TaskContext.get().partitionId()
        for batch in batches:
            column = batch.column(1)
            for part in slices(column, SLICE_BYTES):
                run_of = column.slice(part.start, part.stop - part.start)
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                done.add(ids.to_pylist(), *work(run_of.to_pylist()))
                size += run_of.nbytes
                if size >= block_bytes:
                    yield done.row((partition << 32) | block)
                    block, done, size = block + 1, _Block(), 0
        if done.documents:
            yield done.row((partition << 32) | block)

    return run


class _Block:
    def __init__(self):
        self.documents: list[tuple] = []
        self._texts: list[np.ndarray] = []
        self._pairs: list[np.ndarray] = []
        self._times: list[np.ndarray] = []

    def add(self, ids: list, found: Alignment, digests: list[str], pairs: np.ndarray) -> None:
        links = np.bincount(found.text, minlength=len(ids))
        # A text's links by pair: sorted within the text by one sort of both.
        order = np.lexsort((pairs, found.text))
        text, pair = found.text[order], pairs[order]
        new = np.ones(len(order), bool)
        new[1:] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
        starts = np.flatnonzero(new)
        self._texts.append(text[starts] + len(self.documents))
        self._pairs.append(pair[starts])
        self._times.append(np.diff(np.append(starts, len(order))))
        numbers = (found.n_a, found.n_b, found.n_groups, links)
        self.documents += zip(ids, *[n.tolist() for n in numbers], digests, strict=True)

    def row(self, block: int) -> pa.RecordBatch:
        texts, pairs, times = (
            np.concatenate(x) for x in (self._texts, self._pairs, self._times)
        )
        different, place = np.unique(pairs, return_inverse=True)
        uses = pack(texts.astype(np.uint32), place.astype(np.uint32), times.astype(np.uint32))
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        documents = [dict(zip(names, row, strict=True)) for row in self.documents]
        kinds = [pa.int64()] * 5 + [pa.string()]
        document = pa.struct([pa.field(n, k) for n, k in zip(names, kinds, strict=True)])
        totals = np.bincount(place, times, minlength=len(different)).astype(np.int64)
        return pa.record_batch(
            [
                pa.array([block], pa.int64()),
                pa.array([documents], pa.list_(document)),
                pa.array([different], pa.list_(pa.int64())),
                pa.array([totals], pa.list_(pa.int64())),
                pa.array([uses], pa.binary()),
            ],
            names=["block", "documents", "pairs", "times", "uses"],
        )


def encoded(
    documents: DataFrame, load: Callable[[], Aligner], block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``documents`` as blocks, stored: the tokenizers run once, and block numbers stay."""
    importable(documents.sparkSession)
    rows = documents.select(
        named("doc_id").cast("long").alias("doc_id"), named("text").cast("string").alias("text")
    )
    return materialize(rows.mapInArrow(_blocks(load, block_bytes), _BLOCK), "alignment")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Corpus-wide links of every id pair: ``pair, a_id, b_id, links``, and ``best``, whether no
    other pair of its B id has more.  A vocabulary bounds the pairs of a B id."""
    each = blocks.select(F.inline(F.arrays_zip("pairs", "times")))
    summed = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("links"))
    low = F.lit((1 << _LOW) - 1).cast("long")
    ids = summed.select(
        "pair",
        F.shiftright("pair", _LOW).alias("a_id"),
        F.col("pair").bitwiseAND(low).alias("b_id"),
        "links",
    )
    most = F.max("links").over(Window.partitionBy("b_id"))
    return ids.withColumn("best", F.col("links") == most)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            documents = batch.column("documents")[row].values
            texts, place, times = unpack(batch.column("uses")[row].as_py())
            counts = batch.column("counts")[row].values
            order = np.argsort(counts.field("place").to_numpy())
            links = counts.field("links").to_numpy()[order][place]
            best = counts.field("best").to_numpy(zero_copy_only=False)[order][place]
            n_best = np.zeros(len(documents), np.int64)
            total = np.zeros(len(documents), np.int64)
            np.add.at(n_best, texts, np.where(best, times, 0).astype(np.int64))
            np.add.at(total, texts, links * times.astype(np.int64))
            columns = [documents.field(k) for k in range(5)]
            yield pa.record_batch(
                [*columns, pa.array(n_best), pa.array(total), documents.field(5)],
                names=[
                    "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                    "groups_sha256",
                ],
            )


def document_sums(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document: tokens, groups and links, how many links are of the commonest pair of
    their B id, and the sum of the links' counts."""
    each = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    found = (
        each.join(counts.select("pair", "links", "best"), "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("place", "links", "best")).alias("counts"))
    )
    # A block without a link, that is without a token, finds nothing and keeps its documents.
    none = F.array().cast("array<struct<place: int, links: long, best: boolean>>")
    both = blocks.select("block", "documents", "uses").join(found, "block", "left")
    return both.withColumn("counts", F.coalesce("counts", none)).mapInArrow(
        _summed,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string",
    )


def alignments(
    documents: DataFrame, folder: str = TOKENIZERS, first: str = BYTE_BPE, second: str = PIECE_BPE
) -> DataFrame:
    """``document_sums`` of all whole texts of ``documents`` (``doc_id``, ``text``; other columns
    are left alone).

    Null and empty texts, and texts that either tokenizer does not give back byte for byte, have
    no tokens: zeros and ''.  Repeated rows count each, an empty table has no rows, null ids stay.
    A text is tokenized whole; memory is that of the longest text or of one block."""
    blocks = encoded(documents, aligner(folder, first, second))
    return document_sums(blocks, pair_counts(blocks))
