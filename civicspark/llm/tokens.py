"""Words of whole Arrow batches as NumPy arrays of positions and 64-bit hashes.

Works on the UTF-8 bytes of a text column, so no Python string is made per word.  Both word
patterns used here class every byte above 0x7F the same way, which makes byte-wise splitting
equal to splitting by code points."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _table(separator_ranges: list[tuple[int, int]]) -> np.ndarray:
    is_word = np.ones(256, bool)
    for low, high in separator_ranges:
        is_word[low : high + 1] = False
    return is_word


#: ``[^\x20\x09-\x0D]+``
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, for text whose A-Z are lower-cased
ALNUM = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

#: Bytes hashed at a time; bounds the memory that a long text needs.
CHUNK = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int, name: str) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        steps = np.full(max(n, 1), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps)
    return _powers[name][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, n, "up"), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(inverse, n + 1, "down")[starts])


@dataclass
class Words:
    """The words of a run of texts.  ``first[i]:first[i + 1]`` are the words of text ``i``."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # of the texts in data
    starts: np.ndarray  # of the words in data
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool) -> Words:
    """Words of the texts that ``offsets`` cut out of ``data``."""
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = is_word[data]
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside[:n]
    edges = offsets[(offsets < n)]
    opens = inside & ~before
    opens[edges] = inside[edges]
    closes = before & ~inside
    closes[edges] = before[edges]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        # whole words up to CHUNK bytes, and always at least one
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
        part = data[base : ends[to - 1]]
        hashes[at:to] = _span_hashes(part, starts[at:to] - base, ends[at:to] - base)
        at = to
    return Words(data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))


def words(column: pa.Array, is_word: np.ndarray, lower: bool) -> Words:
    return split(*text_bytes(column), is_word, lower)


def slices(column: pa.Array | pa.ChunkedArray, most: int) -> list[slice]:
    """Runs of rows of at most ``most`` bytes, one row at least."""
    _, offsets = text_bytes(column)
    cuts, at = [], 0
    while at < len(offsets) - 1:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), len(offsets) - 1)
        cuts.append(slice(at, to))
        at = to
    return cuts


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on; ``len - n + 1`` of them, across texts."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * _GRAM + hashes[k : k + size]
    return mix(out + np.uint64(n))


def whole_grams(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of every ``n``-word run that lies within one text."""
    hashes = gram_hashes(found.hashes, n)
    starts = np.arange(len(hashes))
    text = found.text
    keep = text[: len(hashes)] == text[n - 1 :] if len(hashes) else np.zeros(0, bool)
    return starts[keep], hashes[keep]


def covered(n_words: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which words lie in one of the runs."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:n_words]) > 0
