"""Session helpers.

The library never creates a session behind the caller's back inside an
operator. ``build_session`` is for scripts, tests and the bench; on a cluster
the caller passes its own session.
"""

from __future__ import annotations

import os
import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tesela") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("TESELA_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TESELA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    try:
        sc_dir = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        sc_dir = None
    return sc_dir or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used
    as is. Only a local session without one (tests, local runs) gets a fresh
    folder under the system temp directory: elsewhere each executor would
    write to its own disk, so a missing folder is an error there.
    """
    root = checkpoint_root(spark)
    if root:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(root)
        except Exception:  # pragma: no cover
            pass
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    root = tempfile.mkdtemp(prefix="tesela-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


#: Bytes of bytecode beyond which HotSpot leaves a method to its interpreter.
METHOD_CONF, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def compiled_rules(spark: SparkSession) -> None:
    """Let rule projections over many columns run compiled.

    Whole-stage code puts all expressions of a projection into one method, and
    HotSpot compiles none beyond ``METHOD_BYTES``; Spark's own limit is the 64
    KB of a class file. With this limit such a stage is generated expression by
    expression, in methods that are compiled. Set only where the session has
    Spark's default; results do not depend on it.
    """
    if spark.conf.get(METHOD_CONF) == "65535":
        spark.conf.set(METHOD_CONF, str(METHOD_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Give this package to the application's Python workers, once: operators
    that run numpy in tasks need it there, installed or not."""
    sc = spark.sparkContext
    if getattr(sc, "_tesela_shipped", False):
        return
    top = pathlib.Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="tesela-ship-"), "tesela_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent).as_posix())
    sc.addPyFile(path)
    sc._tesela_shipped = True
