"""Education indicators (QRY-26 ... QRY-32)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import pct_half_up
from .quantiles import percentiles


def _mean_exact(c: str, scale: int = 2):
    """Average of a value with at most ``scale`` decimals, from an exact
    decimal sum (independent of summation order)."""
    s = F.sum(F.col(c).cast(f"decimal(18,{scale})"))
    return F.try_divide(s.cast("double"), F.count(F.col(c)).cast("double"))


def dropout_rate(dropout: DataFrame) -> DataFrame:
    """QRY-26 (E-E1): rate = desertores * 100 / matricula, null when the
    enrolment is 0. Readers sort with nulls first (PostgreSQL DESC)."""
    agg = dropout.groupBy("departamento", "anno", "nivel").agg(
        F.sum("matricula").alias("total_matriculados"), F.sum("desertores").alias("total_desertores"))
    return agg.withColumn("tasa_desercion", pct_half_up("total_desertores", "total_matriculados"))


def enrolment_by_level(enrolment: DataFrame, levels: Sequence[str]) -> DataFrame:
    """QRY-27 (E-E2): the levels' aggregates one below the other. A level is
    a grouping key, so the union of one aggregate per level is one aggregate
    over the rows of those levels."""
    return (enrolment.where(F.col("nivel_educativo").isin(*levels)).groupBy("departamento", "nivel_educativo")
            .agg(F.sum("cantidad").alias("total_matricula"), F.count_distinct("institucion").alias("num_instituciones")))


def enrolment_by_year(enrolment: DataFrame) -> DataFrame:
    """QRY-28."""
    return enrolment.groupBy("anno", "nivel_educativo").agg(F.sum("cantidad").alias("total_matricula"))


def employment_by_level(employment: DataFrame) -> DataFrame:
    """QRY-29 (E-E3): ``SUM(CASE WHEN ... THEN 1 END)`` is null when no row
    matches, so the rate is null then too."""
    agg = employment.groupBy("departamento", "nivel_educativo").agg(
        F.count(F.lit(1)).alias("muestra"),
        F.sum(F.when(F.col("ocupada") == 1, F.lit(1))).cast("bigint").alias("ocupadas"),
        F.sum(F.when(F.col("desempleo") == 1, F.lit(1))).cast("bigint").alias("desempleadas"))
    return agg.withColumn("tasa_desempleo", pct_half_up("desempleadas", "muestra"))


def income_by_level(employment: DataFrame) -> DataFrame:
    """QRY-30: mean and median income of earners (``ingreso > 0``)."""
    earners = employment.filter(F.col("ingreso") > 0)
    keys = ["departamento", "nivel_educativo"]
    agg = earners.groupBy(*keys).agg(_mean_exact("ingreso").alias("ingreso_promedio"),
                                     F.count(F.lit(1)).alias("muestra"))
    med = percentiles(earners, "ingreso", {"ingreso_mediano": 0.5}, group=keys)
    return (agg.join(med, on=keys)
            .select(*keys, "ingreso_promedio", "ingreso_mediano", "muestra"))


def establishments(est: DataFrame) -> DataFrame:
    """QRY-31 (E-E4)."""
    return est.groupBy("departamento", "tipo_establecimiento").agg(
        F.count(F.lit(1)).alias("num_establecimientos"),
        F.count_distinct("municipio").alias("num_municipios"))


def exam_results(exam: DataFrame) -> DataFrame:
    """QRY-32 (E-E5)."""
    return exam.groupBy("departamento", "anno").agg(
        _mean_exact("puntaje_global", 0).alias("promedio_puntaje"),
        F.min("puntaje_global").alias("puntaje_min"),
        F.max("puntaje_global").alias("puntaje_max"),
        F.count(F.lit(1)).alias("num_estudiantes"))
