"""Query registry: one entry per operator of the blueprint.

Each entry is ``(spark, sf_dir) -> DataFrame`` plus, when the operator is
expressible in SQL, the equivalent DuckDB SQL over the driver tables. Keys
start with the blueprint ID (``mrt_02_...``, ``qry_06_...``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def register(key: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        if headline:
            HEADLINE.append(key)
        return fn
    return deco


MODULES = ["q_contracts", "q_measures", "q_education", "q_cleaning", "q_functions", "q_documents", "q_io"]


def load_all() -> None:
    """Import the modules that register queries."""
    import importlib

    for name in MODULES:
        importlib.import_module(f"{__package__}.{name}")
