"""Every registered query runs on sf0.001 and, where an oracle exists,
matches DuckDB on the same tables (row multiset, names, values)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from small_tables import SF_SMALL
from tesela.plans import registry
from tesela.sources.tables import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "depto" in df.columns


registry.load_all()


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        return
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, cur.fetchall())
