"""Files in the shared folder that ``spark.checkpoint.dir`` names.

Tables go through Spark's writers. Arrays that workers memory-map are plain
files written by tasks: first under a name of the attempt, then renamed, so
a task that runs again after a lost executor only writes the same file anew.
Where the folder is a mounted file system, workers map the file itself;
otherwise a worker fetches its own copy, maps it and unlinks it at once.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from tesela.session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder of this run in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tesela-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the
    lineage, and lost executors cost no recomputation of it."""
    spark = df.sparkSession
    path = f"{folder or new_folder(spark, name)}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def put(uri: str, data) -> None:
    """Write ``data`` (bytes or a numpy array) as file ``uri``."""
    fs, path = filesystem(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(memoryview(np.ascontiguousarray(data)).cast("B") if isinstance(data, np.ndarray) and data.size else bytes(data) if not isinstance(data, np.ndarray) else b"")
    fs.move(part, path)


_mapped: dict[tuple[str, str], np.ndarray] = {}


def mapped(uri: str, dtype) -> np.ndarray:
    """The array in file ``uri``, memory-mapped once per worker."""
    key = (uri, str(dtype))
    if key not in _mapped:
        fs, path = filesystem(uri)
        if not isinstance(fs, pafs.LocalFileSystem):
            fd, local = tempfile.mkstemp(prefix="tesela-map-")
            with os.fdopen(fd, "wb") as out, fs.open_input_stream(path) as src:
                while block := src.read(8 << 20):
                    out.write(block)
        else:
            local = path
        if os.path.getsize(local):
            _mapped[key] = np.memmap(local, dtype=dtype, mode="r")
        else:
            _mapped[key] = np.zeros(0, dtype)
        if local != path:
            os.unlink(local)  # the mapping stays valid
    return _mapped[key]


def discard(uri: str) -> None:
    """Delete a folder that :func:`new_folder` made."""
    if "/tesela-llm/" not in uri:
        raise ValueError(f"not a folder of this library: {uri}")
    fs, path = filesystem(uri)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_dir(path)
