"""Data validations (VAL-01 ... VAL-05): one aggregate each, no driver loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_or_zero_values(m: DataFrame, value: str = "valor_contrato") -> DataFrame:
    """VAL-01."""
    bad = F.col(value).isNull() | (F.col(value) == 0)
    return m.agg(F.count(F.when(bad, F.lit(1))).alias("conteo")).select(
        F.lit(f"{value} nulos").alias("validacion"), "conteo")


def duplicate_ids(m: DataFrame, key: str = "id_contrato") -> DataFrame:
    """VAL-02: number of ids that occur more than once."""
    dup = m.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("conteo")).select(F.lit(f"{key} duplicados").alias("validacion"), "conteo")


def date_range(m: DataFrame, column: str = "fecha_inicio") -> DataFrame:
    """VAL-03."""
    return m.agg(F.min(column).alias("fecha_min"), F.max(column).alias("fecha_max"))


def out_of_range(m: DataFrame, value: str = "valor_contrato", low: float = 0, high: float = 1e12) -> DataFrame:
    """VAL-04: values below ``low`` or above ``high``."""
    bad = (F.col(value) < F.lit(low)) | (F.col(value) > F.lit(high))
    return m.agg(F.count(F.when(bad, F.lit(1))).alias("conteo"))


def dataset_stats(m: DataFrame, dataset: str = "contratacion", date_col: str = "fecha_inicio") -> DataFrame:
    """VAL-05 / FN-05: ``(dataset, ultima_actualizacion, num_registros)``."""
    return m.agg(F.max(date_col).cast("timestamp_ntz").alias("ultima_actualizacion"),
                 F.count(F.lit(1)).alias("num_registros")).select(
        F.lit(dataset).alias("dataset"), "ultima_actualizacion", "num_registros")
