"""Hot-key joins: same rows as a plain join, no task with a hot key's rows."""

import pytest
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from tesela.operators import indicators, marts, measures
from tesela.operators.split_join import heavy_keys, split_join
from tesela.plans import q_contracts


@pytest.fixture(scope="module")
def tables(spark):
    """Keys: a third null, a third one value, the rest thin; some without a match."""
    fact = spark.range(30_000).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then 'hot' else concat('k', id % 997) end as a", "cast(id % 2 as int) as b", "id * 2 as v")
    dim = spark.range(900).selectExpr("concat('k', id) as x", "cast(id % 2 as int) as y", "id as w").unionByName(spark.createDataFrame([("hot", 1, -1), ("hot", 0, -2), (None, 1, -3), ("unseen", 0, -4), ("k5", 1, -5), ("k6", None, -6)], "x string, y int, w long"))
    return fact, dim


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("bound", [100_000, 100])
def test_same_rows_as_a_plain_join(tables, how, bound):
    fact, dim = tables
    on = [("a", "x"), ("b", "y")]
    want = fact.join(dim, (fact.a == dim.x) & (fact.b == dim.y), how).select("id", "a", "b", "v", "w")
    assert rows(split_join(fact, dim, on, how, broadcast_rows=bound)) == rows(want)
    one = fact.join(dim.where("y = 1"), fact.a == dim.where("y = 1").x, how).select("id", "a", "b", "v", "y", "w")
    assert rows(split_join(fact, dim.where("y = 1"), [("a", "x")], how, broadcast_rows=bound)) == rows(one)
    assert rows(split_join(fact.limit(0), dim, on, how, broadcast_rows=bound)) == []
    none = split_join(fact, dim.limit(0), on, how, broadcast_rows=bound)
    assert none.where("w is not null").count() == 0 and none.count() == (30_000 if how == "left" else 0)


def test_heavy_keys(tables, spark):
    fact, _ = tables
    hashes = spark.createDataFrame([("hot", 0), ("hot", 1)], "a string, b int").select(F.xxhash64("a", "b")).collect()
    assert set(heavy_keys(fact, ["a", "b"])) == {r[0] for r in hashes}
    assert heavy_keys(fact.limit(0), ["a"]) == []


def test_no_partition_holds_the_hot_key(spark, tables):
    fact, dim = tables
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        plain = fact.join(dim, fact.a == dim.x, "left").groupBy(F.spark_partition_id().alias("p")).count()
        split = split_join(fact, dim.where("y = 1"), [("a", "x")], broadcast_rows=10).groupBy(F.spark_partition_id().alias("p")).count()
        assert max(r["count"] for r in plain.collect()) > 9000
        assert max(r["count"] for r in split.collect()) < 3000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def _with_threshold(spark, value, plan):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
    try:
        return plan()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_fact_is_not_exchanged_on_sector_or_department(spark):
    m = q_contracts.master(spark, SF_SMALL)
    joined = _with_threshold(spark, "-1", lambda: measures.fact_with_summaries(m, marts.resumen_departamento(m), marts.entity_totals(m), marts.resumen_sector(m), marts.resumen_tipo_proceso(m)))
    assert "Exchange hashpartitioning" not in joined and "BroadcastHashJoin" in joined
    above = _with_threshold(spark, "-1", lambda: indicators.above_sector_average(m, marts.resumen_sector(m)))
    assert "hashpartitioning(sector" not in above and "BroadcastHashJoin" in above


def test_split_form_of_the_report_relationships(spark):
    m = q_contracts.master(spark, SF_SMALL)
    dims = (marts.resumen_departamento(m), marts.entity_totals(m), marts.resumen_sector(m), marts.resumen_tipo_proceso(m))
    few = ["id_contrato", "depto_num_contratos", "depto_valor_total", "entidad_valor_total", "sector_valor_total", "proceso_valor_total"]
    whole = measures.fact_with_summaries(m, *dims).select(*few)
    split = measures.fact_with_summaries(m, *dims, broadcast_rows=2).select(*few)
    assert rows(whole) == rows(split)


def test_partitions_grow_with_the_fact(tables, spark, monkeypatch):
    from tesela.operators import split_join as S

    fact, dim = tables
    on = [("a", "x"), ("b", "y")]
    want = rows(split_join(fact, dim, on, broadcast_rows=10))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    monkeypatch.setattr(S, "PARTITION_ROWS", 1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        got = split_join(fact, dim, on, broadcast_rows=10)
        assert rows(got) == want
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 20
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
