"""Literal cases of the cleaning rules (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tesela.functions import cleaning as C


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("raw,expected", [
    ("BOGOTA D.C.", "Bogota D.C."),
    ("o'neil 3a s.a.s ñandú", "O'Neil 3A S.A.S Ñandú"),
    ("a  b\t", "A B"),
    ("NULL", ""), ("nan", ""), ("None", ""), (None, ""),
])
def test_normalize_text(spark, raw, expected):
    assert one(spark, C.normalize_text, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("2024-01-15", dt.date(2024, 1, 15)),
    ("2024-01-15 10:30:00", dt.date(2024, 1, 15)),
    ("03/04/2024", dt.date(2024, 4, 3)),
    ("12/25/2024", dt.date(2024, 12, 25)),
    ("2024/1/5", dt.date(2024, 1, 5)),
    ("2024-1-5", dt.date(2024, 1, 5)),
    ("2024-01-15 1:5:0", dt.date(2024, 1, 15)),
    ("2024-01-15T00:00:00.000", None), ("20240115", None), ("2024-02-30", None), ("", None),
])
def test_clean_date(spark, raw, expected):
    assert one(spark, C.clean_date, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("$ 1.234.567,89", 123456789.0), ("50000000", 5e7), ("50000000.0", 5e8), ("-5", -5.0),
    ("1e+16", 1e16), ("COP 500", 0.0), ("5d", 0.0), ("", 0.0), (None, 0.0), ("1_000", 0.0), ("inf", 0.0),
])
def test_clean_money(spark, raw, expected):
    assert one(spark, C.clean_money, raw) == expected


@pytest.mark.parametrize("raw,expected", [("1.234,50", 1.2345), ("-5", 5.0), ("", None)])
def test_clean_money_decimal_mode(spark, raw, expected):
    assert one(spark, lambda c: C.clean_money(c, "decimal"), raw) == expected


@pytest.mark.parametrize("raw,expected", [("NIT 800.123.456-7", "800123456-7"), ("n/a", None)])
def test_clean_nit(spark, raw, expected):
    assert one(spark, C.clean_nit, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("BOGOTA", "Bogotá D.C."), ("bogota d.c.", "Bogotá D.C."), ("atlantico", "Atlántico"),
    ("valle del cauca", "Valle del Cauca"), ("san andres", "San Andres"), (None, None), ("", None),
])
def test_canonical_department(spark, raw, expected):
    assert one(spark, C.canonical_department, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("ATLANTICO", "Atlántico"), ("san andrés", "San Andrés"), ("cordoba", "cordoba"),
    ("  Casanare ", "Casanare"), ("VICHADA", "Vichada"),
])
def test_education_department(spark, raw, expected):
    assert one(spark, C.education_department, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    (999999.99, "Menor a 1M"), (1000000.0, "1M - 5M"), (1000000000.0, "Mayor a 1B"), (7.5e8, "500M - 1B"),
])
def test_value_band(spark, raw, expected):
    assert one(spark, C.value_band, raw, "double") == expected


def test_column_names():
    assert C.normalize_name("Año Firma") == "ao_firma"
    assert C.normalize_name("Código DANE") == "cdigo_dane"
    assert C.normalize_name_spark_variant("Fecha-Inicio Año") == "fecha_inicio_año"


def test_name_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int")
    with pytest.raises(ValueError):
        C.normalize_column_names(df)


def test_sector_rules(spark):
    rows = [("Educación Nacional",), ("Salud y Protección Social",), ("defensa",), ("DEFENSA",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(C.sector_category5("s")).collect()]
    assert got == ["Educación", "Salud", "Defensa", "Otros", "Otros"]
    got3 = [r[0] for r in df.select(C.sector_category3("s")).collect()]
    assert got3 == ["Educación", "Salud", "Otros", "Otros", "Otros"]


def test_title_case_equals_python_title(spark):
    """Random mixes of cased and uncased characters (accents, digits,
    punctuation, whitespace runs, ß) against Python's ``str.title()``."""
    import random
    rng = random.Random(5)
    alphabet = list("abcXYZ ñÑáÉüÜ\t\n.,-'19_/()ßçÇ") + ["  ", "D.C.", "valle del cauca"]
    vals = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r["o"] for r in df.select(C.title_case("v").alias("o")).collect()]
    assert [v.title() for v in vals] == got
