"""The rule projections of the cleaning jobs: compiled, and run once a row."""

import re

import pytest
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from tesela import session
from tesela.functions import cleaning as C
from tesela.operators import filters
from tesela.plans import jobs
from tesela.sources import fixtures, landed


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_gate_stays_above_the_rules(spark):
    sources = fixtures.raw_sources(spark, SF_SMALL)
    pre = jobs.consolidate_sources(sources)
    cons = jobs.consolidate(sources)
    n = len(re.findall("initcap", optimized(pre)))
    assert n > 0 and len(re.findall("initcap", optimized(cons))) == n  # not checkpointed, no second copy in the gate
    assert sorted(map(repr, cons.collect())) == sorted(map(repr, filters.quality_gate(pre).collect()))


@pytest.mark.parametrize("job", [jobs.clean_contracts, jobs.clean_education, jobs.clean_contracts_spark_variant,
                                 lambda df: jobs.consolidate_sources({"secop_ii": df})])
def test_methods_that_hotspot_would_not_compile_are_split(spark, job):
    df = spark.createDataFrame([("a", "x", "7", "meta", "5", "2024-01-02")],
                               "id_contrato string, nombre_entidad string, nit_entidad string, departamento string, valor_del_contrato string, fecha_de_firma string")
    kept = spark.conf.get(session.METHOD_CONF)
    try:
        for before, after in (("65535", str(session.METHOD_BYTES)), ("9000", "9000")):  # the session's own choice stays
            spark.conf.set(session.METHOD_CONF, before)
            assert job(df).count() == 1
            assert spark.conf.get(session.METHOD_CONF) == after
    finally:
        spark.conf.set(session.METHOD_CONF, kept)


def test_text_layers_equal_the_nested_rule(spark):
    odd = [None, "", " ", "NaN", " none\t", "a  b\t", "o'neil 3a s.a.s ñandú", " x  y ", "1-URGENT", "d.c.  e", "ß.ß", "Null x"]
    df = spark.createDataFrame([(str(i), v, "meta", "$ 5") for i, v in enumerate(odd)],
                               "id_contrato string, nombre_entidad string, departamento string, valor_del_contrato string")
    got = {r["id_contrato"]: r["nombre_entidad"] for r in jobs.clean_contracts(df).collect()}
    null_like = {"nan", "none", "null", ""}
    plain = {str(i): "" if v is None or v.strip().lower() in null_like else " ".join(v.strip().title().split()) for i, v in enumerate(odd)}
    assert got == plain == {r["id_contrato"]: r["o"] for r in df.select("id_contrato", C.normalize_text("nombre_entidad").alias("o")).collect()}


def test_money_and_tax_id_read_their_text_once(spark):
    values = ["$ 1.234.567,89", " +5 ", "1e+16", "1e400", "5d", "1 2\n", "\u00a07\u2028", "\x1c8\x1f", "9\x1f0", "-", "", None, "١", "NaN", "--5", " NIT 800.1-7 "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    s = C.strip_ws("v")  # the rules as they were
    t = F.regexp_replace(s, C._MONEY_STRIP, "")
    money = F.coalesce(F.when(t.rlike(C._FLOAT_TEXT), t.try_cast("double")), F.lit(0.0))
    digits = F.regexp_replace(s, r"[^0-9-]", "")
    nit = F.when(digits.isNull() | (digits == ""), F.lit(None).cast("string")).otherwise(digits)
    got = df.select("i", C.clean_money("v").alias("m"), C.clean_nit("v").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.select("i", money, nit).collect()))
    assert optimized(df.select(C.clean_money("v").alias("o"))).count("regexp_replace") == 1
    assert "trim(" not in optimized(df.select(C.clean_nit("v").alias("o")))


def test_lines_that_a_csv_reader_cannot_split(spark, tmp_path):
    lines = {"plain": "a,b", "crlf": "a,b\r", "two": "a,b\r\r", "lone": "a\rb", "blank": " \t", "tab": "\t\r", "nbsp": " ",
             "odd": '"a', "even": '"a"', "odd_cr": '"a\r', "empty": "", "cr": "\r"}
    for k, v in lines.items():
        (tmp_path / f"{k}.csv").write_bytes(f"x,y\n{v}\n1,2\n".encode())
    plain, hard = landed.csv_files(spark, str(tmp_path))
    assert sorted(f.rsplit("/", 1)[1][:-4] for f in hard) == ["blank", "lone", "odd", "odd_cr", "tab"]
    assert len(plain) + len(hard) == len(lines)
