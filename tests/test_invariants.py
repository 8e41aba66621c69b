"""Invariants: gate counts, totals, shares, dense numbering, percentiles,
TOPN ties, paging and catalog helpers."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from tesela.operators import filters, marts, measures
from tesela.operators.aggregates import top_n_with_ties
from tesela.operators.indexing import dense_index
from tesela.operators.quantiles import percentiles
from tesela.plans import jobs, q_contracts
from tesela.sources import fixtures, landed, sinks


def test_gate_counts_sum_to_dropped(spark):
    pre = jobs.consolidate_sources(fixtures.raw_sources(spark, SF_SMALL))
    post = filters.quality_gate(pre)
    counts = filters.gate_counts(pre)
    assert sum(r["descartados"] for r in counts.collect()) == pre.count() - post.count()


def test_summary_totals_equal_master_total(spark):
    m = q_contracts.master(spark, SF_SMALL)
    total = m.agg(F.sum("valor_contrato")).first()[0]
    for mart in (marts.resumen_departamento(m), marts.resumen_sector(m), marts.resumen_tipo_proceso(m)):
        assert mart.agg(F.sum("valor_total")).first()[0] == total
        assert mart.agg(F.sum("num_contratos")).first()[0] == m.count()


def test_shares_sum_to_one(spark):
    m = q_contracts.master(spark, SF_SMALL)
    s = measures.category_comparison(m).agg(F.sum("pct_total")).first()[0]
    assert abs(s - 1.0) < 1e-9
    s2 = measures.modality_summary(m).agg(F.sum("pct_contratos")).first()[0]
    assert abs(s2 - 1.0) < 1e-9


def test_dense_index_is_a_permutation(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5000).repartition(7)
    out = dense_index(df, [F.col("k").asc()], "i").collect()
    assert sorted(r["i"] for r in out) == list(range(5000))
    assert all(r["i"] == r["k"] for r in out)


def test_percentiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 3000), rng.lognormal(10, 2, 3000))]
    vals += [(3, 5.0)] * 1000 + [(3, 7.0)]  # one hot value
    df = spark.createDataFrame(vals, "g int, v double")
    got = {r["g"]: r for r in percentiles(df, "v", {"p25": 0.25, "p50": 0.5, "p95": 0.95}, group=["g"],
                                          accuracy=50, small=200).collect()}
    for g in range(4):
        xs = np.array([v for gg, v in vals if gg == g])
        for name, p in [("p25", 0.25), ("p50", 0.5), ("p95", 0.95)]:
            assert abs(got[g][name] - np.quantile(xs, p)) <= 1e-6 * max(1.0, abs(np.quantile(xs, p)))
    glob = percentiles(df, "v", {"med": 0.5}).first()["med"]
    assert abs(glob - np.quantile(np.array([v for _, v in vals]), 0.5)) < 1e-6


@pytest.mark.parametrize("accuracy, small", [(10_000, 40_000), (100, 400), (20, 80)])
def test_global_percentiles_inside_intervals(spark, accuracy, small):
    """With and without intervals from the sketch, and a hot value holding
    a third of the rows; compare with numpy's linear interpolation."""
    rng = np.random.default_rng(11)
    xs = list(rng.normal(0, 1000, 4000)) + [12.5] * 2000 + list(rng.integers(-50, 50, 500).astype(float))
    df = spark.createDataFrame([(float(x),) for x in xs], "v double").repartition(5)
    probs = {"p0": 0.0, "p01": 0.01, "p33": 0.33, "p50": 0.5, "p77": 0.777, "p100": 1.0}
    got = percentiles(df, "v", probs, accuracy=accuracy, small=small).first()
    for name, p in probs.items():
        want = np.quantile(np.array(xs), p)
        assert abs(got[name] - want) <= 1e-9 * max(1.0, abs(want)), (name, got[name], want)
    empty = percentiles(df.filter("v > 1e12"), "v", {"med": 0.5}).collect()
    assert len(empty) == 1 and empty[0]["med"] is None


@pytest.mark.parametrize("misled", [False, True])
def test_grouped_percentiles_inside_intervals(spark, monkeypatch, misled):
    """Large, small, null and empty groups; also with intervals that miss the
    targets, which has to be noticed."""
    from tesela.operators import quantiles
    if misled:
        monkeypatch.setattr(quantiles, "_intervals", lambda probs, accuracy: [(0.3, 0.31), (0.7, 0.71)])
    rng = np.random.default_rng(13)
    vals = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 3000), rng.normal(50, 20, 3000))]
    vals += [(1, 42.0)] * 900 + [(7, 3.5), (7, 4.5), (8, None)] + [(None, float(x)) for x in range(600)]
    df = spark.createDataFrame(vals, "g int, v double").repartition(4)
    got = {r["g"]: r for r in percentiles(df, "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, group=["g"],
                                          accuracy=100, small=400).collect()}
    assert set(got) == {0, 1, 2, 7, 8, None} and got[8]["p50"] is None
    for g in (0, 1, 2, 7, None):
        xs = np.array([v for gg, v in vals if gg == g])
        for name, p in [("p10", 0.1), ("p50", 0.5), ("p90", 0.9)]:
            assert abs(got[g][name] - np.quantile(xs, p)) <= 1e-9 * max(1.0, abs(np.quantile(xs, p)))


def test_percentile_bounds_reach_the_scan(spark, tmpdir_path, monkeypatch):
    """DECIMAL bounds on the raw column, two scans, and only the interval's
    values counted one by one."""
    from tesela.operators import quantiles
    spark.range(20_000).selectExpr("cast(id * 7919 % 20000 / 4 as decimal(20,2)) as v").write.parquet(f"{tmpdir_path}/t")
    df = spark.read.parquet(f"{tmpdir_path}/t")
    seen = []
    whole = quantiles._counters

    def counters(rows, keys, v, bounds):
        out = whole(rows, keys, v, bounds)
        seen.append((out._jdf.queryExecution().executedPlan().toString(), out.count()))
        return out

    monkeypatch.setattr(quantiles, "_counters", counters)
    got = percentiles(df, "v", {"p25": 0.25, "p75": 0.75}, accuracy=1000, small=4000).first()
    xs = np.sort(np.array([x * 7919 % 20000 / 4 for x in range(20_000)]))
    assert abs(got["p25"] - np.quantile(np.round(xs, 2), 0.25)) < 0.02 and abs(got["p75"] - np.quantile(np.round(xs, 2), 0.75)) < 0.02
    ((plan, counted),) = seen  # one second scan
    assert "PushedFilters: [IsNotNull(v), LessThanOrEqual(v," in plan and plan.count("FileScan") == 1
    assert counted < 0.03 * 20_000


def test_iqr_fences_reach_the_scan(spark, tmpdir_path):
    from tesela.operators import indicators
    m = q_contracts.master(spark, SF_SMALL)
    m.write.parquet(f"{tmpdir_path}/m")
    df = spark.read.parquet(f"{tmpdir_path}/m")
    out = indicators.iqr_outliers(df, k=0.1, n=10_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(valor_contrato," in plan and "GreaterThan(valor_contrato," in plan
    xs = np.array([float(r[0]) for r in df.select("valor_contrato").collect()])
    a, b = np.quantile(xs, 0.25), np.quantile(xs, 0.75)
    assert out.count() == int(((xs < a - 0.1 * (b - a)) | (xs > b + 0.1 * (b - a))).sum())
    assert indicators.iqr_outliers(df.limit(0)).count() == 0


def test_top_n_with_ties_equals_rank(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 5, 4, 4, 4, 3, 2, 2, 1])], "k int, v int")
    got = sorted(r["k"] for r in top_n_with_ties(df, 3, "v").collect())
    want = sorted(r["k"] for r in df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())))
                  .filter("r <= 3").collect())
    assert got == want == [0, 1, 2, 3, 4]


def test_paging_cap_on_offset(spark):
    rows = [(o, i) for o in (0, 10000) for i in range(10000)] + [(20000, i) for i in range(10)]
    df = spark.createDataFrame(rows, "offset long, i int")
    assert landed.apply_paging(df, 10000, 12000).count() == 20000
    short = [(0, i) for i in range(10000)] + [(10000, i) for i in range(5)] + [(30000, 1)]
    assert landed.apply_paging(spark.createDataFrame(short, "offset long, i int"), 10000, 10 ** 9).count() == 10005
    gap = [(0, i) for i in range(10000)] + [(20000, i) for i in range(10000)]
    assert landed.apply_paging(spark.createDataFrame(gap, "offset long, i int"), 10000, 10 ** 9).count() == 10000


def test_catalog_helpers(spark, tmpdir_path):
    sinks.init_schemas(spark, ["clean"], location=tmpdir_path)
    df = spark.createDataFrame([(1,)], "x int")
    sinks.load_as_table(df, "men_matricula_test", "clean")
    sinks.load_as_table(df, "otra_tabla_test", "clean")
    names = {r["table_name"] for r in sinks.education_tables(sinks.list_tables(spark, ["clean"])).collect()}
    assert "men_matricula_test" in names and "otra_tabla_test" not in names
    cols = sinks.list_columns(spark, "clean.men_matricula_test").collect()
    assert [(c["column_name"], c["ordinal_position"]) for c in cols] == [("x", 1)]


def test_retrieve_matches_brute_force(spark):
    """Per-department ranking then fan-out equals ranking each question's
    hits directly: a hot department (a third of the rows), questions that
    share departments, substring over-match and the fallback."""
    from tesela.operators import documents as D
    rng = np.random.default_rng(17)
    deps = ["alpha", "alpha norte", "beta", "gamma", None]
    rows = []
    for i in range(1200):
        dep = "alpha" if i % 3 == 0 else deps[int(rng.integers(0, len(deps)))]
        rows.append((f"id{int(rng.integers(0, 400)):04d}", dep, int(rng.integers(0, 5))))
    table = spark.createDataFrame(rows, "id string, departamento string, v int")
    qs = spark.createDataFrame([("q1", "x"), ("q2", "x"), ("q3", "x"), ("q4", "x")], "qid string, question string")
    men = spark.createDataFrame([("q1", "alpha"), ("q2", "beta"), ("q2", "gamma"), ("q3", "beta")],
                                "qid string, name string")
    order = ["id", "departamento", "v"]
    got = sorted(tuple(r) for r in D.retrieve(table, qs, men, order, 7, max_broadcast_pairs=1)
                 .select("qid", "rn", *order).collect())
    got_broadcast = sorted(tuple(r) for r in D.retrieve(table, qs, men, order, 7)
                           .select("qid", "rn", *order).collect())
    assert got == got_broadcast

    def key(r):
        return tuple((x is not None, x) for x in (r[0], r[1], r[2]))
    want = []
    names = {}
    for q, n in [("q1", "alpha"), ("q2", "beta"), ("q2", "gamma"), ("q3", "beta")]:
        names.setdefault(q, []).append(n)
    for q in ["q1", "q2", "q3", "q4"]:
        hits = [r for r in rows if r[1] is not None and any(n in r[1].lower() for n in names.get(q, []))]
        pool = sorted(hits or rows, key=key)[:7]
        want += [(q, i + 1, *r) for i, r in enumerate(pool)]
    assert got == sorted(want)


def test_paging_takes_all_pages_without_a_cap(spark):
    rows = [(o, i) for o in range(0, 60_000, 10_000) for i in range(10_000)] + [(60_000, 1), (5, 5)]
    df = spark.createDataFrame(rows, "offset long, i int")
    assert landed.apply_paging(df, 10_000).count() == 60_001
    assert landed.apply_paging(df.limit(0), 10_000).count() == 0


def test_small_files_and_snapshots(spark, tmpdir_path):
    import os

    def put(name, body, at):
        os.makedirs(os.path.dirname(f"{tmpdir_path}/{name}"), exist_ok=True)
        with open(f"{tmpdir_path}/{name}", "w") as f:
            f.write(body)
        os.utime(f"{tmpdir_path}/{name}", (at, at))

    put("s/a.csv", "k,v\n1,2\n3,4\n", 1)
    assert landed.scan_directory(spark, f"{tmpdir_path}/s").count() == 2
    put("t/secop_i_20240101.csv", "k\n1\n", 1000)
    put("t/secop_i_20250101-part-0001.csv", "k\n2\n", 2000)
    put("t/secop_i_20250101-part-0002.csv", "k\n3\n", 2001)
    put("t/secop_ii_2025_x.csv", "k\n9\n", 3000)
    files = spark.read.option("header", True).csv(f"{tmpdir_path}/t")
    got = landed.latest_snapshots(files, ["secop_i", "secop_ii"], exclude=["secop_ii_2025_"])
    assert sorted(r["k"] for r in got.collect()) == ["2", "3"]


def test_manifest_without_url(spark, tmpdir_path):
    for k, body in enumerate(('{"datasets": []}', '{}', '{"datasets": [{"name": "x"}]}', '{"datasets": [{"download_url": null}]}')):
        with open(f"{tmpdir_path}/{k}.json", "w") as f:
            f.write(body)
        assert landed.read_from_manifest(spark, f"{tmpdir_path}/{k}.json") is None


def test_education_cleans_every_text_column(spark):
    df = spark.createDataFrame([tuple(" nan " for _ in range(20)), tuple(f" x{i} " for i in range(20))], ", ".join(f"c{i} string" for i in range(20)))
    rows = {tuple(r) for r in jobs.clean_education(df).collect()}
    assert tuple(f"x{i}" for i in range(20)) in rows
    assert all(v in (None, "") for r in rows for v in r if r[0] != "x0")


def test_changed_input_makes_a_new_layer(spark, tmpdir_path):
    from tesela.plans import warehouse

    def build(s, d):
        return s.read.parquet(f"{d}/region.parquet")

    spark.range(6).write.parquet(f"{tmpdir_path}/region.parquet")
    assert warehouse.materialize(spark, tmpdir_path, "probe", build).count() == 6
    spark.range(2).write.mode("overwrite").parquet(f"{tmpdir_path}/region.parquet")
    assert warehouse.materialize(spark, tmpdir_path, "probe", build).count() == 2


def test_no_machine_local_folder_on_a_cluster():
    from tesela import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_rank_inside_department_with_ties_and_null_departments(spark):
    """QRY-38: ranks skip after ties, and a null department is one of its own."""
    from decimal import Decimal

    from tesela.operators import measures

    totals = [("a", 9), ("a", 9), ("a", 7), ("a", 3), ("b", 8), ("b", 7), (None, 7), (None, 9), (None, 1)]
    rows = [(f"e{i}", d, f"n{i}", None if i % 2 else "p", Decimal(v)) for i, (d, v) in enumerate(totals)]
    df = spark.createDataFrame(rows, "nombre_entidad string, departamento string, nit_entidad string, proveedor string, valor_contrato decimal(20,2)")
    got = {r["nombre_entidad"]: r["rank_depto"] for r in measures.entity_summary(df, 5).collect()}
    # the fifth greatest total is 7: all ties at it stay
    want = {f"e{i}": 1 + sum(d2 == d and w > v for d2, w in totals) for i, (d, v) in enumerate(totals) if v >= 7}
    assert got == want
    kpis = measures.kpis(df).first()
    assert (kpis["num_entidades"], kpis["num_departamentos"], kpis["num_proveedores"]) == (9, 3, 2)
    assert measures.entity_summary(df.limit(0)).count() == 0 and measures.kpis(df.limit(0)).first()["num_entidades"] is None
    by_dep = {r["departamento"]: (r["num_entidades"], r["num_proveedores"], r["num_contratos"]) for r in measures.department_summary(df).collect()}
    assert by_dep == {"a": (4, 2, 4), "b": (2, 2, 2), None: (3, 2, 3)}


def test_pipeline_phases_with_education_and_marts_from_the_load(spark, tmp_path):
    """Every landed dataset is in every phase of the report; the marts follow
    the landed files; the Spark variant is an option of transform."""
    from tesela.plans import pipeline

    head = "id_contrato,nombre_entidad,nit_entidad,departamento,valor_del_contrato,fecha_de_firma,proceso_de_compra,sector\n"
    rows = ["a1,uno,NIT 800-1,bogota,$ 100,2024-01-02,P-1,salud\n", "a2,dos,NIT 801-1,,$ 200,,P-2,salud\n", "a3,tres,NIT 802-1,bogota,$ 0,2024-01-02,P-3,\n"]
    (tmp_path / "secop_ii").mkdir()
    (tmp_path / "secop_ii" / "a.csv").write_text(head + "".join(rows))
    (tmp_path / "edu").mkdir()
    (tmp_path / "edu" / "a.csv").write_text("Departamento,Total\nbogota, 5\nbogota,5\nMETA,x\n")
    contracts, schools = {"secop_ii": str(tmp_path / "secop_ii")}, {"men_prueba": str(tmp_path / "edu")}
    spark.sql("drop table if exists clean.secop_ii")
    root = str(tmp_path / "run")
    with pytest.raises(ValueError):
        pipeline.run(spark, "marts", contracts, root, education=schools)
    got = {(r["phase"], r["item"]): r["rows"] for r in pipeline.run(spark, "all", contracts, root, education=schools).collect()}
    assert got == {("extract", "secop_ii"): 3, ("extract", "men_prueba"): 3, ("transform", "secop_ii"): 2, ("transform", "men_prueba"): 2,
                   ("consolidate", "SECOP_II"): 1, ("load", "clean.secop_ii"): 2, ("load", "clean.men_prueba"): 2,
                   ("marts", "marts.contratacion"): 2, ("marts", "marts.resumen_departamento"): 2, ("marts", "marts.resumen_entidad"): 2,
                   ("marts", "marts.resumen_sector"): 1, ("marts", "marts.resumen_tipo_proceso"): 2}
    master = {r["id_contrato"]: r for r in spark.table("marts.contratacion").collect()}
    assert str(master["a1"]["fecha_firma"]) == "2024-01-02" and master["a2"]["fecha_firma"] is None
    assert str(master["a1"]["valor_contrato"]) == "100.00" and dict(spark.table("marts.contratacion").dtypes)["valor_contrato"] == "decimal(20,2)"
    assert {r["depto"] for r in spark.table("marts.resumen_departamento").collect()} == {"Bogotá D.C.".title(), "Sin info"}
    variant = {r["item"]: r["rows"] for r in pipeline.run(spark, "transform", contracts, root, education=schools, spark_variant=True).collect()}
    assert variant == {"secop_ii": 3, "men_prueba": 3}
    assert {r["nombre_entidad"] for r in spark.read.parquet(f"{root}/clean_spark/secop_ii").collect()} == {"uno", "dos", "tres"}
    with pytest.raises(ValueError):
        pipeline.run(spark, "all", contracts, root, education=schools, spark_variant=True)


def test_kpis_group_no_wide_key(spark, monkeypatch):
    """QRY-33: each distinct count shuffles its own column only, and nothing is stored."""
    from decimal import Decimal

    from tesela.operators import measures

    rows = [(None if i % 7 == 0 else f"e{i % 5}", f"d{i % 3}", "p", None if i % 4 == 0 else Decimal(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "nombre_entidad string, departamento string, proveedor string, valor_contrato decimal(20,2)")

    def stored(_):
        raise AssertionError("the fact's groups were stored")

    monkeypatch.setattr(measures, "settled", stored)
    got = measures.kpis(df).first()
    values = [r[3] for r in rows if r[3] is not None]
    assert (got["total_contratos"], got["valor_total"], got["num_entidades"], got["num_departamentos"], got["num_proveedores"]) == (50, sum(values), 6, 3, 1)
    assert abs(got["valor_promedio"] - float(sum(values)) / len(values)) < 1e-9
