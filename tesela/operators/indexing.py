"""Dense row numbers in a total order, without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no partition moves every row into
one task. Here the rows are range-partitioned by ``k`` (a distributed
sort), written once to the checkpoint folder so the partitioning is fixed,
and numbered as ``offset(partition) + position in partition``. The offsets
are a running sum over one row per partition (a bounded, tiny window),
joined back by broadcast.

``monotonically_increasing_id`` is documented to hold the partition id in
its upper 31 bits and the position inside the partition in its lower 33.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1
#: Task and file number in the name of a written part.
_PART = re.compile(r"part-(\d+)(?:.*-c(\d+)\.)?")


def dense_index(df: DataFrame, order: list[Column], name: str = "_idx", start: int = 0) -> DataFrame:
    """Add ``name`` = 0-based (or ``start``-based) position in ``order``.

    ``order`` must be a total order over the rows for the numbering to be
    reproducible (rows equal on every order key may swap places).
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order).checkpoint(eager=True)
    tagged = ordered.withColumn("_mid", F.monotonically_increasing_id()).withColumn(
        "_pid", F.shiftright(F.col("_mid"), 33))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_off", F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).select("_pid", "_off")
    out = tagged.join(F.broadcast(offsets), "_pid")
    pos = F.col("_mid").bitwiseAND(F.lit(_LOW33))
    return out.withColumn(name, (F.col("_off") + pos + F.lit(start)).cast("bigint")).drop("_mid", "_pid", "_off")


def stored_index(df: DataFrame, name: str = "_idx", start: int = 0) -> DataFrame:
    """Add ``name`` = position of each row in a table stored in order.

    ``df`` reads files that a sorted write made: ``part-<task>`` files in
    order, each ordered inside. A row's position is the number of rows in the
    files before it and its ``_metadata.row_index``: no sort, no shuffle and
    no copy. Counting the files' rows reads no column; the driver gets one
    row per file, as it does for any listing.
    """
    file = F.col("_metadata.file_name")
    sizes = df.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n")).collect()
    at, offsets = start, []
    for r in sorted(sizes, key=lambda r: [int(x) for x in _PART.search(r["file"]).groups(default="0")]):
        offsets.append((r["file"], at))
        at += r["n"]
    offsets = df.sparkSession.createDataFrame(offsets, "_file string, _off long")
    tagged = df.withColumn("_file", file).withColumn("_row", F.col("_metadata.row_index"))
    out = tagged.join(F.broadcast(offsets), "_file")
    return out.withColumn(name, F.col("_off") + F.col("_row")).drop("_file", "_row", "_off")
