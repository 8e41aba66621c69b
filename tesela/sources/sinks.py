"""Writers and catalog helpers (SNK-01 ... SNK-09).

All writes are parallel (one file per task); nothing is funnelled through
one task or the driver. Fan-out of one result to two places writes the
first copy and reads it back for the second, which cuts the lineage instead
of recomputing the plan (and survives executor loss, unlike a cache).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import publish

LAYERS = ["raw", "staging", "clean", "marts"]


def write_snapshot(df: DataFrame, root: str, snapshot_date: str, fmt: str = "parquet") -> str:
    """SNK-01: dated raw snapshot as a ``snapshot_date=`` partition folder; a
    rerun on the same day replaces that day only, even when the rerun has
    no rows (a dynamic partition overwrite would keep the old day then)."""
    path = f"{root}/snapshot_date={snapshot_date}"
    df.drop("snapshot_date").write.mode("overwrite").format(fmt).save(path)
    return path


def write_clean_and_export(df: DataFrame, clean_path: str, export_path: str) -> DataFrame:
    """SNK-02: Parquet to the clean layer, CSV (with header) to the export
    layer, from one computation: the CSV is written from the Parquet copy."""
    df.write.mode("overwrite").parquet(clean_path)
    return export_clean(df.sparkSession, clean_path, export_path)


def export_clean(spark: SparkSession, clean_path: str, export_path: str) -> DataFrame:
    """The export copy of a written clean table; returns the clean table."""
    clean = spark.read.parquet(clean_path)
    clean.write.mode("overwrite").option("header", True).option("escape", '"').csv(export_path)
    return clean


def write_parquet(df: DataFrame, path: str) -> None:
    """SNK-03."""
    df.write.mode("overwrite").parquet(path)


#: Name of the published consolidated table.
CONSOLIDATED = "secop_consolidado"


def write_dated_and_latest(df: DataFrame, root: str, date_str: str, counts: Mapping[str, Column] | None = None) -> dict:
    """SNK-04: the consolidated table under its date and as ``latest``: one
    write, then both names are switched to it at once (``publish``)."""
    return publish.publish(df, root, CONSOLIDATED, date_str, counts)


def read_consolidated(spark: SparkSession, root: str, of: str = "latest") -> DataFrame:
    """The consolidated table of a date, or the latest."""
    return publish.published(spark, root, CONSOLIDATED, of)


def init_schemas(spark: SparkSession, names: Sequence[str] = LAYERS, location: str | None = None) -> list[str]:
    """SNK-05: ``CREATE DATABASE IF NOT EXISTS`` for each layer."""
    for n in names:
        loc = f" LOCATION '{location.rstrip('/')}/{n}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}{loc}")
    return list(names)


def _save_table(df: DataFrame, name: str) -> str:
    """Replace a table's contents. The table lives in its database's
    folder as an explicit path, so a rerun (or a new session of an
    in-memory catalog) overwrites the folder instead of failing on it."""
    spark = df.sparkSession
    db, _, table = name.rpartition(".")
    writer = df.write.mode("overwrite").format("parquet")
    if db and spark.catalog.databaseExists(db):
        loc = spark.catalog.getDatabase(db).locationUri.rstrip("/")
        writer = writer.option("path", f"{loc}/{table}")
    writer.saveAsTable(name)
    return name


def load_as_table(df: DataFrame, stem: str, schema: str = "raw") -> str:
    """SNK-06: replace-load a table named after the file stem."""
    return _save_table(df, f"{schema}.{stem}")


def rebuild_table(df: DataFrame, name: str) -> str:
    """SNK-07: ``DROP TABLE IF EXISTS`` + ``CREATE TABLE AS``."""
    return _save_table(df, name)


def export_csv(df: DataFrame, path: str) -> None:
    """SNK-08: a mart as CSV with header, written in parallel."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def list_tables(spark: SparkSession, schemas: Sequence[str] = LAYERS) -> DataFrame:
    """SNK-09: ``(table_schema, table_name)`` of the given databases."""
    rows = []
    for s in schemas:
        if spark.catalog.databaseExists(s):
            rows += [(s, t.name) for t in spark.catalog.listTables(s)]
    return spark.createDataFrame(rows, "table_schema string, table_name string")


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    """SNK-09: ``(column_name, data_type, ordinal_position)`` of a table."""
    rows = [(c.name, c.dataType, i + 1) for i, c in enumerate(spark.catalog.listColumns(table))]
    return spark.createDataFrame(rows, "column_name string, data_type string, ordinal_position int")


def education_tables(tables: DataFrame) -> DataFrame:
    """SNK-09: clean-schema tables whose name marks education data. The
    source query mixes AND/OR without parentheses; this is the intended
    grouping: ``schema = 'clean' AND (name LIKE ...)``."""
    n = F.col("table_name")
    return tables.filter((F.col("table_schema") == "clean") &
                         (n.like("%educacion%") | n.like("%men_%") | n.like("%dane_%")))
