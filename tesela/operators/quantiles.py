"""Exact interpolated percentiles (``PERCENTILE_CONT``) in two scans.

Spark's exact ``percentile`` keeps a value -> count map per group and merges
the maps of a global percentile in one task. Here every task is bounded:

1. one scan counts rows and takes a rank-bounded sketch per group
   (``percentile_approx``, a mergeable summary whose ranks are off by at most
   ``rows / ACCURACY``). Values some error bounds below and above a target
   enclose the target's exact value;
2. one scan counts rows per distinct value inside those intervals; rows
   outside collapse to one counter per gap, on the map side. Without groups
   the bounds are literals on the raw column, so the upper one reaches the
   Parquet scan;
3. the counters, sorted over all tasks, get running counts (a sum per
   partition and the partitions' offsets), and the ranks ``floor(h)`` and
   ``ceil(h)`` of ``h = p (n - 1)`` are read off.

The sketch only decides which values are counted one by one. A target that
falls in a gap after all is noticed, and counted again without intervals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .aggregates import settled

ACCURACY = 10_000
#: Rows up to which a group's values are all counted.
SMALL = 4 * ACCURACY
#: Groups whose bounds are broadcast to the second scan.
BROADCAST_GROUPS = 100_000


def _intervals(probs: dict[str, float], accuracy: int) -> list[tuple[float, float]]:
    """Disjoint ranges of ranks, as shares, that hold the targets."""
    out: list[tuple[float, float]] = []
    for p in sorted(set(probs.values())):
        lo, hi = max(p - 3 / accuracy, 0.0), min(p + 3 / accuracy, 1.0)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _same(a: str, b: str, keys: list[str]) -> Column:
    """Groups are equal, nulls too."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys], F.lit(True))


def _counters(rows: DataFrame, keys: list[str], v: Column, bounds: list[tuple[Column | None, Column | None]]) -> DataFrame:
    """Rows per value inside the bounds and per gap outside them. A gap
    stands right behind the bound below it (``_k``, then ``_gap``)."""
    inside, below = F.lit(False) if bounds else F.lit(True), F.lit(None)
    for lo, hi in bounds:
        low = F.lit(True) if lo is None else v >= lo
        inside = inside | (low if hi is None else low & (v <= hi))
        if hi is not None:
            below = F.when(v > hi, hi).otherwise(below)
    inside = F.coalesce(inside, F.lit(True))  # a group without bounds
    return rows.select(*keys, F.when(inside, v).otherwise(below).alias("_k"), (~inside).alias("_gap")).groupBy(*keys, "_k", "_gap").agg(F.count(F.lit(1)).alias("_c"))


def _running(counters: DataFrame, keys: list[str]) -> DataFrame:
    """``_from`` and ``_upto``: rows before a counter and up to it, over all
    groups in order. A window runs inside one partition of the sort."""
    ensure_checkpoint_dir(counters.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in [*keys, "_k", "_gap"]]
    part = counters.orderBy(*order).withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)
    at, offsets = 0, []
    for r in part.groupBy("_part").agg(F.sum("_c").alias("n")).orderBy("_part").collect():  # one row per partition
        offsets.append((r["_part"], at))
        at += r["n"]
    offsets = counters.sparkSession.createDataFrame(offsets, "_part int, _off long")
    upto = F.col("_off") + F.sum("_c").over(Window.partitionBy("_part").orderBy(*order))
    return part.join(F.broadcast(offsets), "_part").withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_c"))


def _picked(running: DataFrame, sizes: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """The counters that hold the ranks of each target."""
    targets = []
    for name, p in probs.items():
        h = F.lit(float(p)) * (F.col("_n") - 1)
        for side, r in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            targets.append(F.struct(F.lit(name).alias("q"), F.lit(side).alias("side"), r.cast("long").alias("r"), (h - F.floor(h)).alias("frac")))
    first = running.groupBy(*keys).agg(F.min("_from").alias("_first"))
    wanted = sizes.alias("s").join(first.alias("f"), _same("s", "f", keys)).select(*[f"s.{k}" for k in keys], "_first", F.explode(F.array(*targets)).alias("t"))
    rank = F.col("_first") + F.col("t.r")
    return (running.alias("c").join(wanted.alias("w"), _same("c", "w", keys) & (F.col("_from") <= rank) & (rank < F.col("_upto")))
            .select(*[f"c.{k}" for k in keys], "t.q", "t.side", "t.frac", "_gap", F.col("_k").cast("double").alias("_v")))


def percentiles(df: DataFrame, value: str, probs: dict[str, float], group: list[str] | None = None, accuracy: int = ACCURACY, small: int = SMALL) -> DataFrame:
    """``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value)`` for each named
    ``p``, per ``group`` (or over all rows), as DOUBLE columns.

    Nulls are ignored; a group with no values gives nulls.
    """
    keys, v = list(group or []), F.col(value)
    base = df.select(*keys, value).where(v.isNotNull())
    spans = _intervals(probs, accuracy)
    marks = [x for span in spans for x in span]
    sketch = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(value, marks, accuracy).alias("_cuts"))
    sizes = settled(sketch.withColumn("_cuts", F.when(F.col("_n") > small, F.col("_cuts"))))
    ends = [(None if a <= 0 else 2 * i, None if b >= 1 else 2 * i + 1) for i, (a, b) in enumerate(spans)]
    if not keys:
        cuts = sizes.first()["_cuts"] or []
        kind = df.schema[value].dataType
        lit = [F.lit(c).cast(kind) for c in cuts]
        bounds = [tuple(None if e is None else lit[e] for e in pair) for pair in ends] if cuts else []
        last = bounds[-1][1] if bounds else None
        counters = _counters(base if last is None else base.where(v <= last), keys, v, bounds)
    else:
        few = sizes.count() <= BROADCAST_GROUPS
        rows = base.alias("b").join((F.broadcast(sizes) if few else sizes).alias("s"), _same("b", "s", keys)).select("b.*", "s._cuts")
        counters = _counters(rows, keys, v, [tuple(None if e is None else F.col("_cuts")[e] for e in pair) for pair in ends])
    picked = settled(_picked(_running(counters, keys), sizes, keys, probs))
    if picked.where("_gap").limit(1).count():
        # ranks further off than the sketch's bound: count every value
        picked = settled(_picked(_running(_counters(base, keys, v, []), keys), sizes, keys, probs))
    lo, hi = (picked.where(F.col("side") == s).select(*keys, "q", "frac", F.col("_v").alias(f"_{s}")) for s in ("lo", "hi"))
    both = lo.alias("l").join(hi.alias("h"), _same("l", "h", [*keys, "q"])).select(*[f"l.{k}" for k in keys], "l.q", (F.col("_lo") + F.col("l.frac") * (F.col("_hi") - F.col("_lo"))).alias("_x"))
    wide = both.groupBy(*keys).agg(*[F.max(F.when(F.col("q") == name, F.col("_x"))).alias(name) for name in probs])
    if not keys:
        return wide
    return df.select(*keys).distinct().alias("g").join(wide.alias("w"), _same("g", "w", keys), "left").select(*[f"g.{k}" for k in keys], *[f"w.{name}" for name in probs])
