"""Small DataFrame helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id is in fold 0)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_text(docs: DataFrame, kept: list[str], text: str) -> tuple[DataFrame, int]:
    """Columns ``kept`` of ``docs`` and the place of its texts among them. A
    copy as string comes last only where ``text`` is not a kept string, so
    texts go to the workers once."""
    if text in kept and isinstance(docs.schema[text].dataType, T.StringType):
        return docs.select(*kept), kept.index(text)
    return docs.select(*kept, F.col(text).cast("string").alias(fresh(docs, "text_as_string"))), len(kept)


#: Rows of a small table that may be broadcast (some tens of MB).
BROADCAST_ROWS = 100_000


def join_counted(left: DataFrame, right: DataFrame, on, how: str = "left", rows: int | None = None) -> DataFrame:
    """Join ``right``, broadcast only after its rows were counted and are few.

    ``right`` must be a written table (it is counted first). Beyond the bound
    the join shuffles both sides, where adaptive execution splits hot keys.
    """
    n = right.count() if rows is None else rows
    return left.join(F.broadcast(right) if n <= BROADCAST_ROWS else right, on, how)


#: Rows of a batch that a Python worker gets: whole texts, so the default of
#: 10,000 is some 100 MB on both sides.
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application, once, and
    bound the rows of a batch for them where the session does not."""
    import io
    import os
    import pathlib
    import tempfile
    import zipfile

    if spark.conf.get(BATCH_CONF) == "10000":  # Spark's own default
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_tesela_shipped", False):
        return
    top = pathlib.Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent).as_posix())
    path = os.path.join(tempfile.mkdtemp(prefix="tesela-ship-"), "tesela_package.zip")
    with open(path, "wb") as out:
        out.write(data.getvalue())
    sc.addPyFile(path)
    sc._tesela_shipped = True
