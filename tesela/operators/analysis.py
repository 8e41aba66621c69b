"""RAG-08 analysis types as long-format metric rows.

The question service accepts ``summary / compare / trend / anomaly /
insight``; each maps to indicator queries, returned as
``(tipo_analisis, metrica, clave, valor)`` so they can be stacked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import indicators as I
from . import measures as M


def _long(df: DataFrame, kind: str, key: F.Column | str, metrics: list[str]) -> DataFrame:
    k = F.lit(key) if isinstance(key, str) else key
    rows = F.array(*[F.struct(F.lit(m).alias("metrica"), F.col(m).cast("double").alias("valor")) for m in metrics])
    return (df.select(k.cast("string").alias("clave"), F.inline(rows))
            .select(F.lit(kind).alias("tipo_analisis"), "metrica", "clave", "valor"))


def summary(m: DataFrame) -> DataFrame:
    k = M.kpis(m)
    return _long(k, "summary", "total", ["total_contratos", "valor_total", "valor_promedio", "num_entidades",
                                         "num_departamentos", "num_proveedores"])


def compare(m: DataFrame, year: int = I.DEFAULT_YEAR) -> DataFrame:
    return _long(I.education_vs_health(m, year), "compare", F.col("sector"),
                 ["num_contratos", "valor_total", "valor_pagado", "valor_pendiente"])


def trend(m: DataFrame) -> DataFrame:
    t = I.monthly(m).withColumn("_k", F.format_string("%04d-%02d", F.col("anno"), F.col("mes")))
    return _long(t, "trend", F.col("_k"), ["num_contratos", "valor_total"])


def anomaly(m: DataFrame) -> DataFrame:
    return _long(I.iqr_outliers(m), "anomaly", F.col("id_contrato"), ["valor_contrato"])


KINDS = {"summary": summary, "compare": compare, "trend": trend, "anomaly": anomaly}


def analyze(m: DataFrame, kind: str) -> DataFrame:
    """One analysis type, or ``insight`` = all four stacked."""
    if kind == "insight":
        out = None
        for fn in KINDS.values():
            part = fn(m)
            out = part if out is None else out.unionByName(part)
        return out
    return KINDS[kind](m)
