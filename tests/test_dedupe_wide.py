"""Full-row distinct by hashes first: same rows, narrow shuffle, clashes harmless."""

import pytest
from pyspark.sql import functions as F

from tesela.operators import filters


@pytest.fixture(scope="module")
def df(spark):
    rows = [(i % 40, "x" * (i % 7), None if i % 3 else i % 5, [float("nan"), 0.0, -0.0, 1.5][i % 4]) for i in range(400)]
    rows += [(None, "a", None, 1.0), (None, "a", None, 1.0), (1, None, None, None), (None, "1", None, None)] + [(7, "hot", 7, 7.0)] * 300
    return spark.createDataFrame(rows, "a int, b string, `c.d` int, e double").repartition(5)


def rows(x):
    return sorted(str(r).replace("-0.0", "0.0") for r in x.collect())  # equal, either may be kept


@pytest.mark.parametrize("hashes", [None, lambda d: [F.pmod(F.xxhash64("a"), F.lit(3)), F.lit(0)], lambda d: [F.lit(0), F.lit(0)]])
@pytest.mark.parametrize("most", [filters.REPEATED_HASHES, 1])
def test_same_as_distinct(df, hashes, most):
    how = {"hashes": hashes} if hashes else {}
    assert rows(filters.dedupe_wide(df, most=most, **how)) == rows(df.distinct())


def test_unique_rows_and_empty(df):
    once = df.distinct()
    assert rows(filters.dedupe_wide(once)) == rows(once)
    assert filters.dedupe_wide(df.limit(0)).count() == 0


def test_only_hashes_of_single_rows_are_shuffled(spark, tmpdir_path):
    """Ten wide rows of a thousand are repeated: the plan's only shuffle of
    whole rows is above the semi join with the broadcast hashes."""
    wide = spark.range(1000).selectExpr("id", "repeat(cast(id as string), 2000) as t")
    wide.unionByName(wide.limit(10)).write.parquet(f"{tmpdir_path}/w")
    out = filters.dedupe_wide(spark.read.parquet(f"{tmpdir_path}/w"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange hashpartitioning") < plan.index("LeftSemi")
    assert "LeftAnti" in plan and out.count() == 1000
