"""Landed pages: stop rule from the manifest, each page read once, streams."""

import os

import pytest
from pyspark.sql import functions as F

from tesela.sources import landed, page_source
from tesela.streaming import ingest

SCHEMA = "i long, t string, at timestamp"


@pytest.fixture()
def rows(spark):
    """95 rows in pages of 10 (the last one short), a stray page and one off the grid."""
    base = spark.range(95).selectExpr("id as i", "concat('é\"\\n', id, ' ]}') as t", "timestamp_micros(id * 1000001) as at", "id div 10 * 10 as offset")
    stray = base.where("offset = 0").withColumn("offset", F.lit(120).cast("long"))
    off_grid = base.where("offset = 20").withColumn("offset", F.lit(25).cast("long"))
    return base, base.unionByName(stray).unionByName(off_grid).repartition(7)


def schema_of(spark):
    return spark.createDataFrame([], SCHEMA).schema


def land(df, root, **how):
    page_source.land_pages(df, root, order=["i"], **how, **landed.JSON_TIME_OPTIONS)


def got(df):
    return sorted(tuple(r) for r in df.select("i", "t", "at", "offset").collect())


@pytest.mark.parametrize("write_bytes, run_bytes", [(1 << 20, 1 << 20), (900, 1 << 20), (1 << 20, 700), (1, 1)])
def test_pages_up_to_the_stop(spark, tmpdir_path, rows, write_bytes, run_bytes):
    base, all_ = rows
    root = f"{tmpdir_path}/pages"
    land(all_, root, run_bytes=write_bytes)
    assert not [d for d in os.listdir(root) if "offset" in d]  # no folder per page
    df = landed.read_pages(spark, root, schema_of(spark), 10, run_bytes=run_bytes)
    assert got(df) == got(base)
    assert got(landed.read_pages(spark, root, schema_of(spark), 10, max_rows=35)) == got(base.where("offset < 35"))
    assert got(landed.read_pages(spark, root, schema_of(spark), 20)) == got(base.where("offset = 0"))  # the first page is short already


def test_first_page_short_and_gap(spark, tmpdir_path, rows):
    base, _ = rows
    land(base.where("i < 4 or i >= 10"), f"{tmpdir_path}/a")
    assert got(landed.read_pages(spark, f"{tmpdir_path}/a", schema_of(spark), 10)) == got(base.where("i < 4"))
    land(base.where("offset != 30"), f"{tmpdir_path}/b")
    assert got(landed.read_pages(spark, f"{tmpdir_path}/b", schema_of(spark), 10)) == got(base.where("offset < 30"))
    land(base.limit(0), f"{tmpdir_path}/c")
    assert got(landed.read_pages(spark, f"{tmpdir_path}/c", schema_of(spark), 10)) == []


def test_each_page_is_in_one_run(spark, tmpdir_path, rows):
    _, all_ = rows
    root = f"{tmpdir_path}/pages"
    land(all_, root)
    reader = page_source.PageReader({"path": root, "lastOffset": "90", "pageSize": "10", "runBytes": "1300"})
    runs = reader.partitions()
    offsets = [o for r in runs for o, _ in r.pages]
    assert sorted(offsets) == list(range(0, 100, 10)) and len(runs) in (5, 6, 7)
    sizes = {r["offset"]: r["bytes"] for r in page_source.read_manifest(spark, root).collect()}
    assert all(sum(s for _, s in r.pages) <= 1300 or len(r.pages) == 1 for r in runs)
    assert all(s == sizes[o] for r in runs for o, s in r.pages)


def test_stream_takes_each_landing_once(spark, tmpdir_path, rows):
    base, _ = rows
    root, target = f"{tmpdir_path}/pages", f"{tmpdir_path}/table"
    land(base.where("offset < 40"), root)
    first = ingest.ingest_pages(spark, root, schema_of(spark), target, landed.JSON_TIME_OPTIONS)
    assert got(first) == got(base.where("offset < 40"))
    # a landing that did not end is not seen
    half = f"{root}/manifest/landing={2:09d}"
    land(base.where("offset >= 40"), root)
    os.rename(f"{half}/_SUCCESS", f"{half}/was_success")
    again = ingest.ingest_pages(spark, root, schema_of(spark), target, landed.JSON_TIME_OPTIONS)
    assert again.count() == 40
    os.rename(f"{half}/was_success", f"{half}/_SUCCESS")
    for _ in range(2):
        assert got(ingest.ingest_pages(spark, root, schema_of(spark), target, landed.JSON_TIME_OPTIONS)) == got(base)
    assert got(landed.read_pages(spark, root, schema_of(spark), 10)) == got(base)
