"""Counting hashed keys: sorted runs, dealt by key, merged to sorted arrays.

Each task counts the keys of its texts in memory-bounded portions and emits
every portion as one sorted run per shard. Runs of a shard meet in one task
and are merged there. Every portion holds a key at most once, so a key that
makes up a third of all tokens is one entry per portion, and ``shards`` grows
with the input, so a shard keeps its size. Keys of a shard are stored as
differences in byte planes, whose leading planes are mostly zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

from .bytewords import U64, release

RUN_SCHEMA = "shard int, n long, keys binary, counts binary"
RUN_ARROW = pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard by key range: shard order is key order."""
    return (((keys >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    width = values.dtype.itemsize
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes()


def unpack(data, n: int, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_sorted(data, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, U64), dtype=U64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts added up."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts, at)


class Portion:
    """Collects ``(keys, counts)`` until about ``limit`` entries, then gives
    the run of every shard."""

    def __init__(self, shards: int, limit: int, shard: Callable[[np.ndarray, int], np.ndarray] = shard_of):
        self.shards, self.limit, self.shard = shards, limit, shard
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts.astype(np.uint32)))
        self.size += len(keys)
        if self.size >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        keys, counts = summed(keys, counts)
        yield from runs_of(keys, counts, self.shard(keys, self.shards))
        release()


def runs_of(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per shard of sorted distinct ``keys``."""
    if (shard[1:] < shard[:-1]).any():
        order = np.argsort(shard, kind="stable")
        keys, counts, shard = keys[order], counts[order], shard[order]
    ids, at = np.unique(shard, return_index=True)
    for lo in range(0, len(ids), 64):
        rows = [(int(ids[k]), keys[at[k]:(at[k + 1] if k + 1 < len(at) else len(keys))],
                 counts[at[k]:(at[k + 1] if k + 1 < len(at) else len(keys))]) for k in range(lo, min(lo + 64, len(ids)))]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([pack_sorted(r[1]) for r in rows], pa.binary()), pa.array([pack(r[2].astype(np.uint32)) for r in rows], pa.binary())], schema=RUN_ARROW)


def merged(table: pa.Table, dtype=np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts (int64) of all runs of one shard."""
    keys, counts = [], []
    for n, k, c in zip(*(table[x] for x in ("n", "keys", "counts")), strict=True):
        keys.append(unpack_sorted(k.as_buffer(), n.as_py()))
        counts.append(unpack(c.as_buffer(), n.as_py(), dtype).astype(np.int64))
    return summed(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, U64), np.zeros(0, np.int64))


def shards_for(partitions: int, floor: int = 16) -> int:
    """Shards for an input that Spark reads in ``partitions`` tasks."""
    return max(floor, 2 * partitions)


def find(array: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of sorted ``keys`` in the sorted ``array``, and which are there."""
    if not len(array):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(array, keys)
    at[at == len(array)] = 0
    return at, array[at] == keys


def by_shard(shard: np.ndarray) -> Iterable[tuple[int, int, int]]:
    """``(shard, from, to)`` of runs of equal values in sorted ``shard``."""
    if not len(shard):
        return
    at = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
    for a, b in zip(at, [*at[1:], len(shard)], strict=True):
        yield int(shard[a]), int(a), int(b)
