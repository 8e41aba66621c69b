"""Totals per 64-bit key, merged in rounds.

Tasks give out sorted runs ``(keys, totals)`` per shard. A shard's runs are
merged in two rounds, some tasks' runs each and then what is left, so that a
shard that every task has runs of does not bring them all into one task at
once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runs

SCHEMA = "shard int, part long, n long, keys binary, totals binary"
#: Entries that a task holds before it gives out runs.
HELD = 3_000_000


class Totals:
    """Totals per key and shard of one task."""

    def __init__(self):
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, shard: int, keys: np.ndarray, totals: np.ndarray) -> None:
        self.parts.setdefault(shard, []).append((keys, totals))
        self.size += len(keys)

    def flush(self, part: int) -> Iterator[pa.RecordBatch]:
        for shard, parts in self.parts.items():
            keys, totals = runs.summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            yield run_batch(shard, part, keys, totals)
        self.parts, self.size = {}, 0


def run_batch(shard: int, part: int, keys: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "shard": pa.array([shard], pa.int32()), "part": pa.array([part], pa.int64()), "n": pa.array([len(keys)], pa.int64()),
        "keys": pa.array([runs.pack_sorted(keys)], pa.binary()), "totals": pa.array([runs.pack(totals.astype(np.int64))], pa.binary())})


def unpacked(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for s, n, k, t in zip(*(batch[c] for c in ("shard", "n", "keys", "totals")), strict=True):
        yield s.as_py(), runs.unpack_sorted(k.as_buffer(), n.as_py()), runs.unpack(t.as_buffer(), n.as_py(), np.int64)


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fewer, larger runs of the rows of one task."""
    held, part = Totals(), TaskContext.get().partitionId()
    for batch in batches:
        for shard, keys, totals in unpacked(batch):
            held.add(shard, keys, totals)
            if held.size >= HELD:
                yield from held.flush(part)
    yield from held.flush(part)


def _merge(group: pa.Table) -> pa.Table:
    held = Totals()
    for shard, keys, totals in unpacked(group):
        held.add(shard, keys, totals)
    return pa.Table.from_batches(list(held.flush(group["part"][0].as_py())))


def shard_totals(given: DataFrame, last: Callable[[int, np.ndarray, np.ndarray], pa.Table], schema: str, tasks: int) -> DataFrame:
    """``last(shard, keys, totals)`` of every shard of the runs ``given`` by
    about so many tasks."""
    ways = max(1, int(tasks ** 0.5))

    def end(group: pa.Table) -> pa.Table:
        runs_ = list(unpacked(group))
        return last(runs_[0][0], *runs.summed(np.concatenate([r[1] for r in runs_]), np.concatenate([r[2] for r in runs_])))

    once = given.withColumn("part", F.pmod("part", F.lit(ways))).groupBy("shard", "part").applyInArrow(_merge, SCHEMA)
    return once.groupBy("shard").applyInArrow(end, schema)
