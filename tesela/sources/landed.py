"""Readers for landed files (SRC-01 ... SRC-11).

The source system pulls pages over HTTP and reads CSV/JSON with pandas. The
network part is out of scope (see README); what remains is reading the
landed files in parallel and applying the same stopping, selection and
null rules with DataFrame operations.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from . import page_source

# FIXED VALUES: text that pandas.read_csv reads as missing by default.
PANDAS_NA_TOKENS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Landed JSON keeps microseconds (the writer's default is milliseconds).
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# FIXED VALUES: page sizes of the extractors (rows). Their row caps are an
# argument of ``apply_paging``, off by default.
CONTRACTS_PAGE = 10_000
EDUCATION_PAGE = 5_000
CRAWLER_PAGE = 1_000


# ------------------------------------------------------------------ SRC-01 / SRC-02
def apply_paging(pages: DataFrame, page_size: int, max_rows: int | None = None, offset_col: str = "offset") -> DataFrame:
    """Keep what a pager that stops at the first short or empty page would
    have fetched; ``max_rows`` caps the *offset* (the last page is not
    truncated), ``None`` takes everything.

    The pager stops at the smallest page start whose page is not full. Page
    starts are 0 and the ends of the full pages, so that is one anti-join of
    the full pages with themselves and a minimum, with no order over all
    pages. The stop is one number and goes into the filter as a literal,
    which prunes the pages' folders. Stray pages after a gap or a short page,
    and pages that start off the grid, are ignored.
    """
    counts = pages.groupBy(offset_col).agg(F.count(F.lit(1)).alias("_n"))
    full = counts.filter((F.col("_n") == page_size) & (F.col(offset_col) % page_size == 0)).select(F.col(offset_col).alias("_at"))
    first = pages.sparkSession.range(1).select(F.col("id").alias("_start"))
    starts = first.unionByName(full.select((F.col("_at") + page_size).alias("_start")))
    stop = starts.join(full, F.col("_start") == F.col("_at"), "left_anti").agg(F.min("_start")).first()[0]
    kept = (F.col(offset_col) <= F.lit(stop)) & (F.col(offset_col) % page_size == 0)
    return pages.filter(kept if max_rows is None else kept & (F.col(offset_col) < max_rows))


def read_pages(spark: SparkSession, root: str, schema: StructType, page_size: int, max_rows: int | None = None,
               run_bytes: int = page_source.RUN_BYTES) -> DataFrame:
    """SRC-01/02: rows of the landed pages that a pager would have fetched,
    with their page's ``offset``.

    The stop rule reads the manifest only; pages after the stop are never
    opened, the others are read once, a run of them per task.
    """
    page_source.register(spark)
    stop, cap = page_source.pages_to_keep(page_source.read_manifest(spark, root), page_size, max_rows)
    reader = spark.read.format("landed_pages").option("lastOffset", stop).option("pageSize", page_size).option("runBytes", run_bytes)
    if cap is not None:
        reader = reader.option("maxOffset", cap)
    return page_source.parsed(reader.load(root), schema, JSON_TIME_OPTIONS)


# ------------------------------------------------------------------ SRC-03 / SRC-07
def csv_files(spark: SparkSession, path: str | Sequence[str], **options) -> tuple[list[str], list[str]]:
    """Files below ``path`` that a CSV reader can split at line ends, and
    those that it cannot.

    A line end lies inside quotes exactly if a line with an odd number of
    quotes stands before or after it, so whether a file has one is a maximum
    over its lines, whatever their order: one native scan, no order, no
    state. Files with a lone carriage return or with lines of white space
    alone, which the reader's two modes treat differently, count as not
    splittable too. The driver gets one row per file, as for any listing.
    """
    reader = spark.read.option("lineSep", "\n")
    for k, v in options.items():
        reader = reader.option(k, v)
    text, quote = F.col("value"), F.lit('"')
    line = F.when(text.contains("\r"), F.regexp_replace(text, "\r$", "")).otherwise(text)
    odd = text.contains('"') & ((F.length(text) - F.length(F.replace(text, quote))) % 2 == 1)
    hard = odd | line.contains("\r") | ((line != "") & (F.btrim(line, F.lit(" \t")) == ""))
    found = reader.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max(hard).alias("hard")).collect()
    names = sorted((re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(r["file"])), r["hard"]) for r in found)
    return [f for f, h in names if not h], [f for f, h in names if h]


def _read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None, shape=lambda df: df, listing: dict | None = None, **options) -> DataFrame:
    """CSV with header and ``""`` escapes, every column read as text unless a
    schema says otherwise. Only files whose quoted fields span lines are read
    whole by one task; the others are split. ``shape`` is applied to what is
    read of each kind, where ``_metadata`` is known."""
    def reader(multi: bool):
        r = spark.read.option("header", True).option("multiLine", multi).option("escape", '"').option("mode", "PERMISSIVE")
        for k, v in options.items():
            r = r.option(k, v)
        return r

    def listed(r):
        for k, v in (listing or {}).items():
            r = r.option(k, v)
        return r

    if schema is None:
        # the header of the first file, as for a read of all
        schema = listed(reader(True)).csv(path).schema
    whole = listed(reader(True)).schema(schema)
    plain, multi = csv_files(spark, path, **(listing or {}))
    if not plain or not multi:
        return shape((whole if multi or not plain else listed(reader(False)).schema(schema)).csv(path))
    parts = []
    for files, kind in ((plain, False), (multi, True)):
        r = reader(kind).schema(schema)
        if isinstance(path, str):
            r = r.option("basePath", path)
        parts.append(shape(r.csv(files)))
    return parts[0].unionByName(parts[1])


def read_csv_text(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
                  na_tokens: Sequence[str] | None = PANDAS_NA_TOKENS) -> DataFrame:
    """SRC-07: CSV with header, quoted fields that may span lines and ``""``
    escapes (what pandas writes), every column read as text; then the
    pandas missing-value tokens become null in one projection."""
    df = _read_csv(spark, path, schema)
    if not na_tokens:
        return df
    tokens = list(na_tokens)
    return df.select(*[F.when(F.col(f"`{c}`").isin(*tokens), F.lit(None).cast("string"))
                       .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_csv_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC-03: a missing drop file gives an empty table of ``schema``; any
    other fault of the file or the schema is raised."""
    try:
        return read_csv_text(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# ------------------------------------------------------------------ SRC-04
def read_from_manifest(spark: SparkSession, manifest: str, resolve=lambda url: url,
                       schema: StructType | None = None) -> DataFrame | None:
    """SRC-04: the first entry of ``datasets[]`` names a CSV to read.

    Only the one URL crosses to the driver. No list, an empty list, or a
    first entry without a URL gives ``None`` (the source returns an empty
    frame).
    """
    m = (spark.read.schema("datasets array<struct<download_url:string>>").option("multiLine", True).json(manifest))
    first = m.select(F.get("datasets", F.lit(0))["download_url"]).limit(1).collect()
    if not first or not first[0][0]:
        return None
    return read_csv_text(spark, resolve(first[0][0]), schema)


# ------------------------------------------------------------------ SRC-05
def extract_all(spark: SparkSession, registry: Sequence[dict], readers: dict) -> DataFrame:
    """SRC-05: run the reader of each registry entry's kind and return the
    ``(dataset, rows)`` summary; datasets with no rows are skipped.

    The registry is a short, fixed list of datasets (a driver-side loop over
    configuration, not over data); every count is a distributed job.
    """
    rows = []
    for entry in registry:
        reader = readers.get(entry["kind"])
        if reader is None:
            continue
        df = reader(spark, entry)
        if df is None:
            continue
        n = df.count()
        if n > 0:
            rows.append((entry["dataset"], n))
    return spark.createDataFrame(rows, "dataset string, rows long")


# ------------------------------------------------------------------ SRC-06
def read_json_dump(spark: SparkSession, path: str, schema: StructType | None = None,
                   pretty: bool = False) -> DataFrame:
    """SRC-06: JSON array dumps; a one-line top-level array is split into
    rows by the JSON reader, pretty-printed files need ``multiLine``."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if pretty:
        r = r.option("multiLine", True)
    return r.json(path)


# ------------------------------------------------------------------ SRC-08
def scan_directory(spark: SparkSession, root: str, glob: str = "*.csv", recursive: bool = False,
                   min_bytes: int = 0, fmt: str = "csv", **options) -> DataFrame:
    """SRC-08: every file under ``root`` matching ``glob`` (optionally
    recursive) larger than ``min_bytes`` (by default: not empty), read as
    one table with the file name attached."""
    listing = {"pathGlobFilter": glob, **({"recursiveFileLookup": True} if recursive else {})}

    def shape(df: DataFrame) -> DataFrame:
        return df.filter(F.col("_metadata.file_size") > min_bytes).withColumn("source_file", F.col("_metadata.file_name"))

    if fmt == "csv":
        return _read_csv(spark, root, None, shape, listing, **options)
    r = spark.read.format(fmt)
    for k, v in {**listing, **options}.items():
        r = r.option(k, v)
    return shape(r.load(root))


# ------------------------------------------------------------------ SRC-09
def latest_snapshots(files: DataFrame, datasets: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """SRC-09: for each dataset prefix, the rows of its most recently
    modified snapshot, without snapshots whose name starts with a key in
    ``exclude`` (a dataset's yearly variant, say; a date inside a name
    excludes nothing).

    ``files`` must expose ``_metadata`` (a file-based DataFrame). A snapshot
    is a folder named like a dataset, with all its part files, else the
    files that share a name up to a part suffix (``-part-0001``, ``.part2``).
    The dataset is the longest listed prefix of its name. Ties on
    modification time go to the greater name.
    """
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"([._-]part[._-]?[0-9]+)?\.[A-Za-z0-9.]+$", "")
    in_folder = F.lit(False)
    for d in datasets:
        in_folder = in_folder | folder.startswith(d + "_")
    name = F.when(in_folder, folder).otherwise(stem)
    ds = None
    for d in sorted(datasets, key=len, reverse=True):
        cond = name.startswith(d + "_")
        ds = F.when(cond, F.lit(d)) if ds is None else ds.when(cond, F.lit(d))
    tagged = files.withColumn("_dataset", ds).withColumn("_file", name).withColumn(
        "_mtime", F.col("_metadata.file_modification_time"))
    for key in exclude:
        tagged = tagged.filter(~F.col("_file").startswith(key))
    tagged = tagged.filter(F.col("_dataset").isNotNull())
    per_file = tagged.groupBy("_dataset", "_file").agg(F.max("_mtime").alias("_mtime"))
    best = (per_file.groupBy(F.col("_dataset").alias("_bd"))  # one row per listed dataset
            .agg(F.max_by("_file", F.struct("_mtime", "_file")).alias("_bf")))
    out = tagged.join(F.broadcast(best), (F.col("_dataset") == F.col("_bd")) & (F.col("_file") == F.col("_bf")),
                      "left_semi")
    return out.withColumnRenamed("_dataset", "dataset").drop("_file", "_mtime")


# ------------------------------------------------------------------ SRC-10 / SRC-11
def read_table(spark: SparkSession, table: str, schema: str = "marts", limit: int | None = None,
               order: Sequence[str] | None = None) -> DataFrame:
    """SRC-10: a catalog table, optionally limited (with an explicit order so
    the limit is deterministic)."""
    df = spark.table(f"{schema}.{table}")
    if limit is not None:
        df = df.orderBy(*(order or df.columns)).limit(limit)
    return df


def load_catalog_csv(spark: SparkSession, path: str, table: str = "raw.catalogo") -> DataFrame:
    """SRC-11: the manual catalogue CSV saved as ``raw.catalogo``."""
    from .sinks import load_as_table  # the sink owns table placement
    db, _, stem = table.rpartition(".")
    if not spark.catalog.databaseExists(db or "raw"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db or 'raw'}")
    # an explicit folder under the database: a rerun in a new session
    # replaces it instead of failing on an existing managed location
    return spark.table(load_as_table(read_csv_text(spark, path), stem, db or "raw"))
