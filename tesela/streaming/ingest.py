"""Incremental ingest of landed files with Structured Streaming.

The source system re-runs its extractors and rewrites dated snapshots. With
landed files arriving over time, the Spark form is a file stream run with
``trigger(availableNow=True)``: each run picks up only the files not seen
before (tracked in the checkpoint), writes them exactly once to a Parquet
table (the sink's metadata log makes half-finished batches invisible), and
stops. Re-running after a failure or an executor loss resumes from the
checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources import page_source


def ingest_available(spark: SparkSession, source_dir: str, schema: StructType, target: str,
                     fmt: str = "json", max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Append every not-yet-ingested file under ``source_dir`` to the Parquet
    table at ``target/data`` and return that table (batch DataFrame).

    Partition folders ``key=value`` under ``source_dir`` fill the matching
    schema columns.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir)
    q = (stream.writeStream.format("parquet")
         .option("checkpointLocation", f"{target}/_checkpoint")
         .option("path", f"{target}/data")
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()
    return spark.read.schema(schema).parquet(f"{target}/data")


def ingest_pages(spark: SparkSession, root: str, schema: StructType, target: str, json_options: dict | None = None) -> DataFrame:
    """Append the pages landed since the last run to the Parquet table at
    ``target/data`` and return that table, with each row's page ``offset``.

    The stream's position is the number of the last landing; a run that ends
    half-way is taken up again from the checkpoint.
    """
    page_source.register(spark)
    lines = spark.readStream.format("landed_pages").load(root)
    q = (page_source.parsed(lines, schema, json_options).writeStream.format("parquet")
         .option("checkpointLocation", f"{target}/_checkpoint").option("path", f"{target}/data")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(schema.add("offset", "long") if "offset" not in schema.names else schema).parquet(f"{target}/data")
