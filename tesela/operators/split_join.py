"""Joining a fact to a dimension on keys that may be hot (QRY-19, QRY-46).

A dimension whose rows were counted and are few is broadcast. Beyond that
bound the join is split by key:

- heavy hitters of the fact's key come from a mergeable frequency sketch
  (``approx_top_k``, map-side partial sketches of bounded size). Their
  dimension rows, few by construction and counted, are broadcast;
- the other keys are shuffled. Each holds at most about one in
  ``HOT_SHARE`` of the rows, so none is a hot spot;
- fact rows with a null key, or with a heavy one, need no match there. They
  are dealt by a hash of the whole row, so they do not meet in one task.

The sketch only steers the split: a key it misses is joined by the shuffle,
and every row goes exactly one way, decided by the hash of its key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import settled

#: Rows of a dimension that is broadcast whole (some tens of MB).
BROADCAST_ROWS = 100_000
#: A key is heavy with more than one in so many of the fact's rows, so there
#: are fewer heavy keys than this; entries that a sketch tracks.
HOT_SHARE, SKETCH_ITEMS = 512, 8192
#: Rows of a fact per shuffle partition, so a sort of one stays in memory.
PARTITION_ROWS = 500_000


def _hash(columns: list[str]) -> Column:
    """Hash of a key, null if any part is."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(whole, F.xxhash64(*columns))


def heavy_keys(fact: DataFrame, columns: list[str], share: int = HOT_SHARE, items: int = SKETCH_ITEMS) -> list[int]:
    """Hashes of the keys with more than one in ``share`` of the rows: at most
    ``share`` of them reach the driver, from one pass over the key columns."""
    hashed = fact.select(_hash(columns).alias("h"))
    row = hashed.agg(F.expr(f"approx_top_k(h, {share + 1}, {items})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in row["top"] if r["item"] is not None and r["count"] * share > row["n"]]


def _equal(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(x) == F.col(y) for x, y in zip(a, b, strict=True)])


def split_join(fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]], how: str = "left",
               broadcast_rows: int = BROADCAST_ROWS, share: int = HOT_SHARE) -> DataFrame:
    """Rows of ``fact`` with the columns of ``dim`` other than its keys.

    ``on`` pairs columns of the fact with columns of the dimension; ``how``
    is ``left`` or ``inner``. Null keys match nothing. A key that the
    dimension holds several times multiplies rows, as in any join. Columns
    of the two must have different names.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how}")
    left, right = [a for a, _ in on], [b for _, b in on]
    added = [c for c in dim.columns if c not in right]
    dim = settled(dim)
    if dim.count() <= broadcast_rows:
        return fact.join(F.broadcast(dim), _equal(left, right), how).select(*fact.columns, *added)

    hot, rows = heavy_keys(fact, left, share), fact.count()
    keyed = dim.select(_hash(right).alias("_dim_hash"), *[F.col(c).alias(f"_dim_{k}") for k, c in enumerate(right)], F.struct(F.lit(True), *added).alias("_dim_row"))
    keys = [f"_dim_{k}" for k in range(len(right))]
    heavy = keyed.where(F.col("_dim_hash").isin(hot)) if hot else None
    if heavy is not None and heavy.limit(broadcast_rows + 1).count() > broadcast_rows:
        hot, heavy, rows = [], None, 0  # a dimension with very many rows per key: the planner's skew handling is left
    rest = keyed.where(~F.col("_dim_hash").isin(hot)) if hot else keyed.where(F.col("_dim_hash").isNotNull())

    out = fact.withColumn("_key_hash", _hash(left))
    is_settled = F.col("_key_hash").isNull()
    if heavy is not None:
        is_settled = is_settled | F.col("_key_hash").isin(hot)
        h = heavy.select(*[F.col(k).alias(f"{k}_hot") for k in keys], F.col("_dim_row").alias("_hot_row"))
        out = out.join(F.broadcast(h), _equal(left, [f"{k}_hot" for k in keys]), "left").drop(*[f"{k}_hot" for k in keys])
    out = out.withColumn("_dealt", F.when(is_settled, F.xxhash64(*fact.columns)).otherwise(F.col("_key_hash"))).drop("_key_hash")
    parts = -(-rows // PARTITION_ROWS)
    if parts > int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        # no key left is a hot spot, so the partitions only need to be many enough
        out, rest = out.repartition(parts, "_dealt", *left), rest.repartition(parts, "_dim_hash", *keys)
    out = out.join(rest, (F.col("_dealt") == F.col("_dim_hash")) & _equal(left, keys), "left")
    found = F.coalesce("_hot_row", "_dim_row") if heavy is not None else F.col("_dim_row")
    out = out.withColumn("_found", found)
    if how == "inner":
        out = out.where(F.col("_found").isNotNull())
    return out.select(*fact.columns, *[F.col("_found")[c].alias(c) for c in added])
