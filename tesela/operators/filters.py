"""Filters and de-duplication (FLT-01 ... FLT-08, DED-01).

Predicates on stored columns are plain ``filter`` calls, so Catalyst pushes
them into the Parquet scan (``PushedFilters``); only predicates on derived
columns stay above it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from .aggregates import settled


def _and(preds: Iterable[Column]) -> Column | None:
    out = None
    for p in preds:
        out = p if out is None else (out & p)
    return out


def id_columns(columns: Sequence[str]) -> list[str]:
    """Id-like columns of the cleaning rule: (``id`` and ``contrato`` in the
    name) or exactly ``uid``."""
    return [c for c in columns if ("id" in c and "contrato" in c) or c == "uid"]


def drop_blank_ids(df: DataFrame, id_cols: Sequence[str] | None = None) -> DataFrame:
    """FLT-01: drop rows with a null or empty value in any id column."""
    cols = list(id_cols) if id_cols is not None else id_columns(df.columns)
    pred = _and((F.col(c).isNotNull() & (F.col(c).cast("string") != "")) for c in cols)
    return df if pred is None else df.filter(pred)


def value_column(columns: Sequence[str]) -> str | None:
    if "valor_del_contrato" in columns:
        return "valor_del_contrato"
    if "valor_contrato" in columns:
        return "valor_contrato"
    return None


def keep_positive(df: DataFrame, value_col: str | None = None) -> DataFrame:
    """FLT-02: keep value > 0 (``valor_del_contrato``, else ``valor_contrato``)."""
    col = value_col or value_column(df.columns)
    return df if col is None else df.filter(F.col(col) > 0)


# FIXED VALUES: the consolidation quality gate, in order.
GATE_RULES: list[tuple[str, str]] = [
    ("valor_no_positivo", "valor_contrato > 0"),
    ("nombre_entidad_no_definido", "nombre_entidad != 'No Definido'"),
    ("nit_no_definido", "nit_entidad != 'No Definido'"),
    ("departamento_no_definido", "departamento != 'No Definido'"),
]


def _gate_predicates() -> list[tuple[str, Column]]:
    return [
        ("valor_no_positivo", F.coalesce(F.col("valor_contrato") > 0, F.lit(False))),
        ("nombre_entidad_no_definido", F.coalesce(F.col("nombre_entidad") != vocab.NOT_DEFINED, F.lit(False))),
        ("nit_no_definido", F.coalesce(F.col("nit_entidad") != vocab.NOT_DEFINED, F.lit(False))),
        ("departamento_no_definido", F.coalesce(F.col("departamento") != vocab.NOT_DEFINED, F.lit(False))),
    ]


def quality_gate(df: DataFrame) -> DataFrame:
    """FLT-03: rows passing all four rules (valor > 0, entity, nit and
    department defined)."""
    return df.filter(_and(p for _, p in _gate_predicates()))


def gate_counts(df: DataFrame) -> DataFrame:
    """FLT-03 counts: rows dropped by rule k = failing k, passing 1..k-1.

    One conditional aggregate over the input (map-side partial sums), then
    unpivoted to ``(paso, regla, descartados)``.
    """
    preds = _gate_predicates()
    aggs = []
    passed = F.lit(True)
    for name, p in preds:
        aggs.append(F.sum(F.when(passed & ~p, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(name))
        passed = passed & p
    wide = df.agg(*aggs)
    stack = ", ".join(f"{i + 1}, '{name}', `{name}`" for i, (name, _) in enumerate(preds))
    return wide.select(F.expr(f"stack({len(preds)}, {stack}) as (paso, regla, descartados)"))


def drop_all_null(df: DataFrame) -> DataFrame:
    """FLT-04: drop rows where every column is null."""
    return df.dropna(how="all")


def contract_filter(df: DataFrame, department: str | None = None, years: Sequence[int] | None = None,
                    departments: Sequence[str] | None = None, since: tuple[str, str, int] | None = None,
                    not_blank: str | None = None, date_col: str = "fecha_inicio") -> DataFrame:
    """FLT-05: the parametric predicates of the indicator queries.

    ``years`` becomes a union of date ranges on ``date_col`` so Parquet
    statistics can prune; ``since=(column, as_of, months)`` keeps rows on or
    after ``as_of - months``.
    """
    preds: list[Column] = []
    if department is not None:
        preds.append(F.col("departamento") == department)
    if departments:
        preds.append(F.col("departamento").isin(*departments))
    if years:
        rng = None
        for y in years:
            r = (F.col(date_col) >= F.lit(_dt.date(y, 1, 1))) & (F.col(date_col) < F.lit(_dt.date(y + 1, 1, 1)))
            rng = r if rng is None else (rng | r)
        preds.append(rng)
    if since is not None:
        col, as_of, months = since
        preds.append(F.col(col) >= F.add_months(F.lit(as_of).cast("date"), -int(months)))
    if not_blank is not None:
        preds.append(F.col(not_blank).isNotNull() & (F.col(not_blank) != ""))
    pred = _and(preds)
    return df if pred is None else df.filter(pred)


def slicers(df: DataFrame, selections: Mapping[str, Sequence]) -> DataFrame:
    """FLT-06: multi-select slicers; an empty selection is no filter."""
    pred = _and(F.col(c).isin(*vals) for c, vals in selections.items() if vals)
    return df if pred is None else df.filter(pred)


def having_count(df: DataFrame, keys: Sequence[str], min_count: int, alias: str = "num_contratos") -> DataFrame:
    """FLT-07: ``GROUP BY keys HAVING COUNT(*) > min_count``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
            .filter(F.col(alias) > min_count))


def exclude_values(df: DataFrame, column: str, excluded: Sequence[str] = (vocab.NOT_DEFINED,)) -> DataFrame:
    """FLT-08: filter applied after a top-n (may return fewer than n)."""
    return df.filter(~F.col(column).isin(*excluded) | F.col(column).isNull())


def dedupe(df: DataFrame) -> DataFrame:
    """DED-01: full-row distinct (nulls compare equal)."""
    return df.dropDuplicates()


#: Repeated row hashes (16 bytes each) that are broadcast at most.
REPEATED_HASHES = 500_000


def _row_hashes(df: DataFrame) -> list[Column]:
    """128 bits of a row; a hash skips nulls, so where they stand counts too."""
    nulls = [F.col(f"`{c}`").isNull() for c in df.columns]
    return [F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns], *nulls) for seed in (1, 2)]


def dedupe_wide(df: DataFrame, hashes=_row_hashes, most: int = REPEATED_HASHES) -> DataFrame:
    """DED-01 for wide rows of a stored table, which are read twice instead
    of shuffled: first only their 128-bit hashes are, then the rows whose hash
    occurs again are compared in full, so a clash of hashes drops nothing.

    With more than ``most`` repeated hashes the rows are shuffled after all.
    """
    a, b = hashes(df)
    tagged = df.withColumns({"_hash_a": a, "_hash_b": b})
    counts = tagged.groupBy("_hash_a", "_hash_b").agg(F.count(F.lit(1)).alias("_n"))
    repeated = settled(counts.where(F.col("_n") > 1).select("_hash_a", "_hash_b"))
    n = repeated.count()
    if n == 0:
        return df
    if n > most:
        return dedupe(df)
    few, on, cols = F.broadcast(repeated), ["_hash_a", "_hash_b"], [F.col(f"`{c}`") for c in df.columns]
    again = tagged.join(few, on, "left_semi").select(*cols)
    return tagged.join(few, on, "left_anti").select(*cols).unionByName(dedupe(again))
