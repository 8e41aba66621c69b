"""Landed pages as a Spark data source (SRC-01, SRC-02).

A landing is a folder with two parts: run files, each many pages of JSON
lines one after another, and a manifest, a small table with a row per page
``(offset, rows, file, start, bytes)``. Landings can be appended: each adds a
numbered part of the manifest.

The pager's stop rule needs only the manifest, so it is decided before any
page is read. The source then plans one partition per run of neighbouring
pages of a file, up to ``runBytes``, and a task reads that byte range once.
It gives lines; the JSON itself is parsed by Spark's own functions.

``landed_pages`` reads in batch (``spark.read``) and as a stream
(``spark.readStream``), where a micro-batch is what was landed since.

Files are reached through pyarrow's file systems (local and mounted folders,
HDFS, S3, GCS), by the tasks and, for the manifest, by the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..session import ship_package

RUN_BYTES = 128 << 20
MANIFEST = "offset long, rows long, file string, start long, bytes long, landing long"
_LINES = pa.schema([("offset", pa.int64()), ("value", pa.string())])


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


# ------------------------------------------------------------------ landing
def _write_runs(root: str, size: int):
    """Write the lines of a task's pages, which come in order, as run files;
    one row of the manifest per page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(root)
        fs.create_dir(f"{path}/runs", recursive=True)
        out, pages, name = None, [], ""

        def close() -> Iterator[pa.RecordBatch]:
            out.close()
            fs.move(f"{path}/runs/_{name}", f"{path}/runs/{name}")
            cols = list(zip(*pages, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array([f"runs/{name}"] * len(pages)), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], names=["offset", "rows", "file", "start", "bytes"])

        for batch in batches:
            for offset, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is not None and pages[-1][0] != offset and pages[-1][2] + pages[-1][3] >= size:
                    yield from close()
                    out = None
                if out is None:
                    name, pages = f"{uuid.uuid4().hex}.jsonl", []
                    out = fs.open_output_stream(f"{path}/runs/_{name}")
                if not pages or pages[-1][0] != offset:
                    pages.append([offset, 0, pages[-1][2] + pages[-1][3] if pages else 0, 0])
                data = line.encode() + b"\n"
                out.write(data)
                pages[-1][1] += 1
                pages[-1][3] += len(data)
        if out is not None:
            yield from close()
    return run


def land_pages(df: DataFrame, root: str, offset: str = "offset", order: Sequence[str] = (), run_bytes: int = RUN_BYTES, **json_options) -> None:
    """Append the rows of ``df`` to the landing at ``root``, one page per
    value of ``offset``, rows of a page in ``order``. A page's rows must fit
    in a task, and pages that come twice are both kept (in two landings)."""
    spark = df.sparkSession
    ship_package(spark)
    cols = [c for c in df.columns if c != offset]
    lines = df.select(F.col(offset).cast("long").alias("offset"), F.to_json(F.struct(*cols), {"ignoreNullFields": "true", **json_options}).alias("value"), *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)])
    dealt = lines.repartitionByRange("offset").sortWithinPartitions("offset", *[f"_o{k}" for k in range(len(order))]).select("offset", "value")
    number = max(_landings(root), default=0) + 1
    pages = dealt.mapInArrow(_write_runs(root, run_bytes), "offset long, rows long, file string, start long, bytes long")
    # the number is taken by the part's success marker: a landing that ends half-way is not seen
    pages.coalesce(max(1, min(8, pages.rdd.getNumPartitions()))).write.mode("overwrite").parquet(f"{root}/manifest/landing={number:09d}")


def _landings(root: str) -> list[int]:
    """Numbers of the landings that ended."""
    fs, path = _filesystem(root)
    found = fs.get_file_info(pafs.FileSelector(f"{path}/manifest", recursive=True, allow_not_found=True))
    return sorted(int(f.path.rsplit("/", 2)[1].split("=")[1]) for f in found if f.base_name == "_SUCCESS")


def read_manifest(spark: SparkSession, root: str, landings: Sequence[int] | None = None) -> DataFrame:
    """The manifest's rows of the landings that ended."""
    have = _landings(root) if landings is None else list(landings)
    if not have:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST.rsplit(",", 1)[0]).option("basePath", f"{root}/manifest").parquet(*[f"{root}/manifest/landing={n:09d}" for n in have])


def pages_to_keep(pages: DataFrame, page_size: int, max_rows: int | None = None) -> tuple[int, int | None]:
    """``(last offset, cap)`` of a pager that stops at the first short or
    missing page, from the manifest alone."""
    counts = pages.groupBy("offset").agg(F.sum("rows").alias("_n"))
    full = counts.where((F.col("_n") == page_size) & (F.col("offset") % page_size == 0)).select(F.col("offset").alias("_at"))
    starts = pages.sparkSession.range(1).select(F.col("id").alias("_start")).unionByName(full.select((F.col("_at") + page_size).alias("_start")))
    stop = starts.join(full, F.col("_start") == F.col("_at"), "left_anti").agg(F.min("_start")).first()[0]
    return stop, max_rows


# ------------------------------------------------------------------ the source
class Run(InputPartition):
    """A byte range of a run file, and where its pages end."""

    def __init__(self, file: str, start: int, pages: list[tuple[int, int]]):
        self.file, self.start, self.pages = file, start, pages  # (offset, bytes)


class PageSource(DataSource):
    """``spark.read.format("landed_pages")``: ``(offset, value)`` per line of
    the landing ``root``. Options: ``lastOffset`` and ``maxOffset`` (pages up
    to and below), ``pageSize`` (only pages on its grid), ``runBytes``."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "offset long, value string"

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))

    def streamReader(self, schema) -> PageStream:
        return PageStream(dict(self.options))


class _Pages:
    """Planning and reading, which batch and stream share."""

    def __init__(self, options: dict):
        low = {k.lower(): v for k, v in options.items()}
        self.root = (low.get("root") or low["path"]).rstrip("/")
        self.size = int(low.get("runbytes", RUN_BYTES))
        self.last, self.cap, self.grid = (int(low[k]) if k in low else None for k in ("lastoffset", "maxoffset", "pagesize"))

    def runs(self, landings: Sequence[int]) -> list[Run]:
        fs, path = _filesystem(self.root)
        out: list[Run] = []
        for n in landings:
            table = pads.dataset(f"{path}/manifest/landing={n:09d}", filesystem=fs, format="parquet", exclude_invalid_files=False, ignore_prefixes=["_", "."]).to_table(use_threads=False)
            keep = pc.fill_null(pc.greater_equal(table["offset"], 0), False)
            if self.last is not None:
                keep = pc.and_(keep, pc.less_equal(table["offset"], self.last))
            if self.cap is not None:
                keep = pc.and_(keep, pc.less(table["offset"], self.cap))
            rows = table.filter(keep).sort_by([("file", "ascending"), ("start", "ascending")])
            end, held = -1, 0
            for offset, file, start, size in zip(*(rows[c].to_pylist() for c in ("offset", "file", "start", "bytes")), strict=True):
                if self.grid and offset % self.grid:
                    continue
                if not out or out[-1].file != file or start != end or held + size > self.size:
                    out.append(Run(file, start, []))
                    held = 0
                out[-1].pages.append((offset, size))
                end, held = start + size, held + size
        return out

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(self.root)
        with fs.open_input_file(f"{path}/{partition.file}") as f:
            f.seek(partition.start)
            for offset, size in partition.pages:  # one page at a time
                lines = f.read(size).decode().split("\n")[:-1]
                for k in range(0, len(lines), 10_000):
                    part = lines[k:k + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([offset] * len(part), pa.int64()), pa.array(part, pa.string())], schema=_LINES)


class PageReader(_Pages, DataSourceReader):
    def partitions(self) -> list[Run]:
        return self.runs(_landings(self.root)) or [Run("", 0, [])]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        return super().read(partition) if partition.pages else iter(())


class PageStream(_Pages, DataSourceStreamReader):
    """A micro-batch is the landings that ended since the last one."""

    def initialOffset(self) -> dict:
        return {"landing": 0}

    def latestOffset(self) -> dict:
        return {"landing": max(_landings(self.root), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Run]:
        return self.runs([n for n in _landings(self.root) if start["landing"] < n <= end["landing"]])

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        return super().read(partition)

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession) -> None:
    """Make ``landed_pages`` known to the session."""
    ship_package(spark)
    spark.dataSource.register(PageSource)


def parsed(lines: DataFrame, schema, json_options: dict | None = None) -> DataFrame:
    """Columns of ``schema`` and ``offset`` from lines of the source."""
    one = F.from_json("value", schema.json() if not isinstance(schema, str) else schema, {"mode": "PERMISSIVE", **(json_options or {})}).alias("_row")
    names = [f.name for f in schema.fields]
    return lines.select("offset", one).select(*[F.col("_row")[n].alias(n) for n in names], "offset")
