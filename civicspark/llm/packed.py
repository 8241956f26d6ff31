"""Columns of numbers as one compressed binary value, and hash-partitioned exchange of them.

One row carries all keys that a block of documents sends to one bucket, instead of a row per
key: the same shuffle with far fewer bytes and rows.  Rows never outnumber the keys."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that one bucket should get; a bucket is handled by one task at a time.
KEYS_PER_BUCKET = 2_000_000
#: Fewest buckets, so that small inputs spread too.
LEAST_BUCKETS = 64
#: Bytes of text that are worked on at a time in a task.
BLOCK_BYTES = 4 << 20


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays, each with the bytes of equal rank side by side, compressed."""
    parts = [len(arrays).to_bytes(2, "little")]
    for array in arrays:
        array = np.ascontiguousarray(array)
        parts.append(array.dtype.str.encode().ljust(4) + len(array).to_bytes(8, "little"))
        parts.append(array.view(np.uint8).reshape(-1, array.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(value: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    out, at = [], 2
    for _ in range(int.from_bytes(raw[:2], "little")):
        kind = np.dtype(raw[at : at + 4].decode().strip())
        n = int.from_bytes(raw[at + 4 : at + 12], "little")
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at)
        at += n * kind.itemsize
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).ravel())
    return out


def bucket_count(keys: float) -> int:
    return max(LEAST_BUCKETS, math.ceil(keys / KEYS_PER_BUCKET))


def prime(least: float) -> int:
    """A prime, so that regular ids spread over so many blocks."""
    n = max(61, math.ceil(least))
    while any(n % k == 0 for k in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def text_size(documents: DataFrame, column: str = "text") -> int:
    """Bytes of text in all rows."""
    return documents.agg(F.sum(F.octet_length(column))).first()[0] or 0


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket number and the positions of its keys, for buckets that get any."""
    if not len(keys):
        return
    bucket = (keys >> np.uint64(20)) % np.uint64(buckets)
    order = np.lexsort((keys, bucket))
    numbers, first = np.unique(bucket[order], return_index=True)
    for number, part in zip(numbers, np.split(order, first[1:]), strict=True):
        yield int(number), part


def merged(payloads: Iterable[bytes]) -> list[np.ndarray]:
    """The payloads' arrays, each joined over all payloads."""
    columns = [unpack(bytes(p)) for p in payloads]
    return [np.concatenate(c) for c in zip(*columns, strict=True)]


def run_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
