"""Materialised layers.

The source system builds its marts once (``CREATE TABLE AS``) and every
indicator reads them. Here the same happens: a layer is written once as
Parquet under the session's checkpoint folder (the shared folder named by
``spark.checkpoint.dir`` on a cluster) and read back by every query. That
cuts the six-way join lineage of the contract view out of each query plan,
and lets filters on the mart reach the Parquet scan.

A written layer is reused only when its ``_SUCCESS`` marker exists, so a job
that lost executors half-way is simply rebuilt.
"""

from __future__ import annotations

import contextlib
import hashlib
import inspect
import threading
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import ensure_checkpoint_dir
from ..sources import fixtures
from ..sources.tables import TABLES, table_path

LAYOUT_VERSION = "v2-range-layout"
_lock = threading.RLock()
_known: dict[tuple[str, str, str], str] = {}


def _io_code() -> str:
    """Digest of the package's source: a layer written by other code (other
    cleaning rules, other readers) is never reused."""
    import pathlib

    pkg = pathlib.Path(__file__).resolve().parent.parent
    h = hashlib.sha1()
    for f in sorted(pkg.rglob("*.py")):
        h.update(f.relative_to(pkg).as_posix().encode())
        h.update(f.read_bytes())
    return h.hexdigest()


_IO_CODE = _io_code()
_RUN_TAG: dict[str, str] = {}


def set_run_tag(tag: str) -> None:
    """Namespace every layer and landing of this process under ``tag`` (the
    bench uses a fresh tag so it times the builds instead of reusing them)."""
    _RUN_TAG["tag"] = tag


def input_files(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the input tables' files: paths, sizes, modification times.

    A listing of the tables' folders, no data; with it in a layer's name a
    changed, added or removed file never meets a layer made before.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    h = hashlib.sha1()
    for table in TABLES:
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, table))
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            continue
        files, found = fs.listFiles(path, True), []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()


#: Input bytes (Parquet) per shuffle partition while a layer is built: half a
#: million fact rows, some 200 MB while they are sorted.
PARTITION_BYTES = 8 << 20
MERGED = "32m"


def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the input tables' files, from a listing."""
    jvm, conf, total = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for table in TABLES:
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, table))
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            files = fs.listFiles(path, True)
            while files.hasNext():
                total += files.next().getLen()
    return total


@contextlib.contextmanager
def sized(spark: SparkSession, sf_dir: str) -> Iterator[None]:
    """Shuffle partitions that grow with the input, where the session has
    fewer: a sort of a partition then stays in memory at any size. Adaptive
    execution merges small ones again, to ``MERGED`` each, and still splits
    skewed ones. The session's settings come back afterwards."""
    count, merged = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, had = spark.conf.get(count), spark.conf.get(merged, None)
    spark.conf.set(count, str(max(int(before), -(-input_bytes(spark, sf_dir) // PARTITION_BYTES))))
    if had is None or had == "67108864b":  # Spark's own default
        spark.conf.set(merged, MERGED)
    try:
        yield
    finally:
        spark.conf.set(count, before)
        spark.conf.unset(merged) if had is None else spark.conf.set(merged, had)


def _key(spark: SparkSession, sf_dir: str, name: str, build: Callable) -> str:
    """Layer folder: input folder and files + the builder's code, so neither
    changed data nor a changed builder reads an older layer."""
    try:
        code = inspect.getsource(build) + _IO_CODE
    except (OSError, TypeError):
        code = getattr(build, "__qualname__", repr(build)) + _IO_CODE
    run = _RUN_TAG.get("tag", "")
    h = hashlib.sha1(f"{LAYOUT_VERSION}|{run}|{sf_dir.rstrip('/')}|{input_files(spark, sf_dir)}|{code}".encode()).hexdigest()[:16]
    return f"tesela-layers/{name}-{h}"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(f"{path}/_SUCCESS").schema  # listing only, no job
        return True
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def materialize(spark: SparkSession, sf_dir: str, name: str,
                build: Callable[[SparkSession, str], DataFrame],
                sort_within: list[str | Column] | None = None, ranged: bool = True) -> DataFrame:
    """Return layer ``name`` for ``sf_dir``, writing it once if absent.

    ``ranged``: rows are dealt by ranges of the sort key, so files follow
    each other in its order; else each file is sorted by itself, which saves
    a shuffle of the whole layer (filters still skip a file's pages).
    """
    if spark.conf.get("tesela.materialize", "true").lower() != "true":
        return build(spark, sf_dir)
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{_key(spark, sf_dir, name, build)}"
    ident = (spark.sparkContext.applicationId, path, name)
    with _lock:
        if ident not in _known:
            if not _exists(spark, path):
                with sized(spark, sf_dir):
                    df = build(spark, sf_dir)
                    if sort_within:
                        # range-partition on the sort key (the trailing columns
                        # split a hot department over many files), sort inside:
                        # files and row groups carry tight min/max statistics
                        df = (df.repartitionByRange(*sort_within) if ranged else df).sortWithinPartitions(*sort_within)
                    else:
                        # no useful key: spread rows evenly (round robin is
                        # skew-free) so readers get one task per file
                        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
                    df.write.mode("overwrite").parquet(path)
            _known[ident] = path
    return spark.read.parquet(path)


def land(spark: SparkSession, sf_dir: str, name: str, write: Callable[[SparkSession, str, str], None],
         fresh: bool = False) -> str:
    """Run the writer of ``name`` (``write(spark, sf_dir, path)``) and return
    its folder.

    Input landings are written once per application and read by several
    queries; another application writes its own, so a stored landing is never
    taken for the writer's work. ``fresh`` writes on every call (queries that
    exercise a sink).
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    app = spark.sparkContext.applicationId
    path = f"{root}/{_key(spark, sf_dir, name, write).replace('tesela-layers', 'tesela-landing')}-{app}"
    if fresh:
        path = f"{path}-{uuid.uuid4().hex[:12]}"
        write(spark, sf_dir, path)
        return path
    ident = (app, path, name)
    with _lock:
        if ident not in _known:
            write(spark, sf_dir, path)
            _known[ident] = path
    return path


def by_department_and_date() -> Column:
    """Keeps a department's rows together, by start date, as one number: a
    radix sort of its own, where names that begin alike (``NATION_1``) would
    each be compared in their rows. Only a layout: two departments of one hash
    would share pages."""
    day = F.coalesce(F.unix_date("fecha_inicio"), F.lit(0)).cast("bigint")
    return F.shiftleft(F.xxhash64("departamento"), 32) + day


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract view, materialised; rows grouped by department and sorted
    by start date inside each file so Parquet min/max statistics prune pages."""
    return materialize(spark, sf_dir, "contracts", fixtures.contracts, sort_within=[by_department_and_date()], ranged=False)


# Layout keys of the other layers (leading column = the usual filter or
# grouping key, trailing columns spread a hot key over many files).
LAYER_KEYS = {
    "edu_dropout": ["departamento", "anno", "nivel"],
    "edu_enrolment": ["departamento", "anno", "institucion"],
    "edu_exam": ["departamento", "anno", "puntaje_global"],
    "edu_employment": ["departamento", "nivel_educativo", "ingreso"],
    "edu_establishments": ["departamento", "municipio"],
}


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "contracts":
        return contracts(spark, sf_dir)
    return materialize(spark, sf_dir, name, fixtures.BUILDERS[name], sort_within=LAYER_KEYS.get(name))
