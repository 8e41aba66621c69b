"""Published tables and phase markers (SNK-04, JOB-05).

A published table is written once, to a folder of its own version. Small
pointer files say which version a date, and ``latest``, stand for; a pointer
is written beside its place and renamed over it in one step, so a reader
finds the old version or the new one, whole, and never a half-written one.
Row counts come from ``DataFrame.observe`` on the write itself.

A marker says that one item of a phase ended, with its row counts and the
markers it was made from. A run that is taken up again skips an item whose
marker still stands on the same inputs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# ------------------------------------------------------------------ small files
def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(uri)


def _fs(spark: SparkSession, uri: str):
    return _path(spark, uri).getFileSystem(spark._jsc.hadoopConfiguration())


def put_small(spark: SparkSession, uri: str, value: Mapping) -> None:
    """Write a small JSON file; it appears, or replaces the one there, at once."""
    part = f"{uri}.{uuid.uuid4().hex}"
    out = _fs(spark, uri).create(_path(spark, part), True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    full = _fs(spark, uri).makeQualified(_path(spark, uri))
    context = hadoop.FileContext.getFileContext(full.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_fs(spark, uri).makeQualified(_path(spark, part)), full, over)


def get_small(spark: SparkSession, uri: str) -> dict | None:
    """The JSON file at ``uri``, if there."""
    fs, path = _fs(spark, uri), _path(spark, uri)
    if not fs.exists(path):
        return None
    opened = fs.open(path)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(opened)).decode())
    finally:
        opened.close()


# ------------------------------------------------------------------ counted writes
def counted(df: DataFrame, write: Callable[[DataFrame], None], counts: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Row counts of ``df`` taken while ``write`` writes it (``rows``, and any
    conditions to count): no second scan."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in (counts or {}).items()]]
    write(df.observe(seen, *metrics))
    got = seen.get
    return {k: int(got.get(k) or 0) for k in ["rows", *(counts or {})]}


# ------------------------------------------------------------------ published tables
def _pointer(root: str, name: str, of: str) -> str:
    return f"{root.rstrip('/')}/{name}_{of}.json"


def publish(df: DataFrame, root: str, name: str, date: str, counts: Mapping[str, Column] | None = None) -> dict:
    """Write ``df`` as a new version and point ``date`` and ``latest`` at it.
    Returns what the pointers hold: version folder, date and counts."""
    spark = df.sparkSession
    folder = f"{name}_versions/{date}-{uuid.uuid4().hex}"
    rows = counted(df, lambda d: d.write.parquet(f"{root.rstrip('/')}/{folder}"), counts)
    value = {"folder": folder, "date": date, "counts": rows}
    for of in (date, "latest"):
        put_small(spark, _pointer(root, name, of), value)
    return value


def published(spark: SparkSession, root: str, name: str, of: str = "latest") -> DataFrame:
    """The version that ``latest``, or a date, stands for."""
    value = get_small(spark, _pointer(root, name, of))
    if value is None:
        raise ValueError(f"nothing published as {name} for {of}")
    return spark.read.parquet(f"{root.rstrip('/')}/{value['folder']}")


def published_all(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """What all dates stand for, one below the other; ``None`` if nothing."""
    fs, base = _fs(spark, root), root.rstrip("/")
    if not fs.exists(_path(spark, base)):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(_path(spark, base))]
    pointers = sorted(n for n in names if n.startswith(f"{name}_") and n.endswith(".json") and n != f"{name}_latest.json")
    folders = [f"{base}/{get_small(spark, f'{base}/{n}')['folder']}" for n in pointers]
    return spark.read.parquet(*folders) if folders else None


def drop_unreferenced(spark: SparkSession, root: str, name: str) -> list[str]:
    """Delete the versions that no pointer names (replaced ones, and those of
    writes that ended half-way). Not while readers or writers are at work."""
    fs, base = _fs(spark, root), root.rstrip("/")
    listed = [f.getPath() for f in fs.listStatus(_path(spark, base))]
    names = [p.getName() for p in listed]
    used = {get_small(spark, f"{base}/{n}")["folder"].rsplit("/", 1)[1] for n in names if n.startswith(f"{name}_") and n.endswith(".json")}
    gone = []
    for f in fs.listStatus(_path(spark, f"{base}/{name}_versions")):
        if f.getPath().getName() not in used:
            fs.delete(f.getPath(), True)
            gone.append(f.getPath().getName())
    return sorted(gone)


# ------------------------------------------------------------------ phase markers
def files_of(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files below ``path``: an input's identity."""
    fs = _fs(spark, path)
    if not fs.exists(_path(spark, path)):
        return ""
    files, found = fs.listFiles(_path(spark, path), True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}")
    return str(uuid.uuid5(uuid.NAMESPACE_OID, "\n".join(sorted(found))))


class Markers:
    """Markers of a run below ``root``: one per phase and item."""

    def __init__(self, spark: SparkSession, root: str, resume: bool):
        self.spark, self.root, self.resume = spark, f"{root.rstrip('/')}/_phases", resume

    def _file(self, phase: str, item: str) -> str:
        return f"{self.root}/{phase}/{item}.json"

    def id(self, phase: str, item: str) -> str | None:
        value = get_small(self.spark, self._file(phase, item))
        return value and value["id"]

    def do(self, phase: str, item: str, inputs: list[str | None], work: Callable[[], Mapping[str, int]]) -> dict[str, int]:
        """The item's counts: from its marker if the run is resumed and the
        marker stands on the same inputs, else from ``work``."""
        old = get_small(self.spark, self._file(phase, item))
        if self.resume and old and old["inputs"] == inputs:
            return dict(old["counts"])
        counts = dict(work())
        put_small(self.spark, self._file(phase, item), {"id": uuid.uuid4().hex, "inputs": inputs, "counts": counts})
        return counts
