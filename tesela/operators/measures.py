"""Dashboard measures (QRY-33 ... QRY-47), the DAX tables as DataFrames.

DAX semantics kept on purpose:

- ``DISTINCTCOUNT`` counts a blank as a value;
- ``TOPN`` keeps every tie at the cut (``top_n_with_ties``);
- ``RANKX`` ties skip (``rank``);
- ``CONTAINSSTRING`` is case-insensitive;
- ``DIVIDE`` is a guarded ratio (not a percentage, not rounded).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import vocab
from .aggregates import (avg_as_double, distinct_count_with_blank, distinct_values, money_sum, settled, top_n_with_ties,
                         with_total)
from .filters import exclude_values
from .split_join import BROADCAST_ROWS, split_join


def _ratio(num: str, den: str):
    return F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))


def kpis(df: DataFrame) -> DataFrame:
    """QRY-33: the KPI cards; one-row tables put side by side.

    Totals and each distinct count read their own column of the fact. Groups
    of the three counted columns are nearly as many as its rows, so they would
    be shuffled and stored like it.
    """
    keys = (("nombre_entidad", "num_entidades"), ("departamento", "num_departamentos"), ("proveedor", "num_proveedores"))
    value = money_sum()
    out = df.agg(F.count(F.lit(1)).alias("total_contratos"), value.alias("valor_total"),
                 F.try_divide(value.cast("double"), F.count("valor_contrato").cast("double")).alias("valor_promedio"))
    for c, alias in keys:
        out = out.crossJoin(F.broadcast(distinct_values(df, c, alias)))
    return out


def by_value_band(df: DataFrame) -> DataFrame:
    """QRY-34: contracts and value per value band."""
    return (df.groupBy(C.value_band("valor_contrato").alias("rango_valor"))
            .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total")))


def type_summary(df: DataFrame, n: int = 10) -> DataFrame:
    """QRY-35: per contract type with share of value; ``TOPN(n)`` by value."""
    agg = df.groupBy("tipo_contrato").agg(
        F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
        avg_as_double().alias("valor_promedio"))
    out = (with_total(agg, "valor_total", "_total")
           .withColumn("pct_total", _ratio("valor_total", "_total")).drop("_total"))
    return top_n_with_ties(out, n, "valor_total")


def modality_summary(df: DataFrame) -> DataFrame:
    """QRY-36: per modality with share of rows."""
    agg = df.groupBy("modalidad").agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"))
    return (with_total(agg, "num_contratos", "_total")
            .withColumn("pct_contratos", _ratio("num_contratos", "_total")).drop("_total"))


def department_summary(df: DataFrame, n: int = 10) -> DataFrame:
    """QRY-37: per department, ``TOPN(n)`` by value, with share of value.

    Entities and suppliers are counted in two levels each, the sums come
    from the level of entities.
    """
    money = df.agg(money_sum().alias("v")).schema["v"].dataType
    by_entity = df.groupBy("departamento", "nombre_entidad").agg(
        F.count(F.lit(1)).alias("_c"), money_sum().alias("_s"), F.count("valor_contrato").alias("_n"))
    agg = by_entity.groupBy("departamento").agg(
        F.sum("_c").alias("num_contratos"), F.sum("_s").cast(money).alias("valor_total"),
        F.try_divide(F.sum("_s").cast("double"), F.sum("_n").cast("double")).alias("valor_promedio"),
        F.count(F.lit(1)).alias("num_entidades"))
    suppliers = (df.select(F.col("departamento").alias("_d"), "proveedor").distinct()
                 .groupBy("_d").agg(F.count(F.lit(1)).alias("num_proveedores")))
    agg = agg.join(suppliers, F.col("departamento").eqNullSafe(F.col("_d"))).drop("_d")
    out = (with_total(agg, "valor_total", "_total")
           .withColumn("pct_valor", _ratio("valor_total", "_total")).drop("_total"))
    return top_n_with_ties(out, n, "valor_total")


def entity_summary(df: DataFrame, n: int = 20) -> DataFrame:
    """QRY-38: per (entity, department, tax id); ``RANKX`` inside the
    department over the whole summary, then ``TOPN(n)`` by value.

    A rank is one more than the entities of the department with a greater
    total. They are counted for the top rows only, by partial aggregation,
    so no department is ordered in one task. The totals asked for are at
    most ``n`` and one per department (ties at the cut), hence broadcast.
    """
    agg = settled(df.groupBy("nombre_entidad", "departamento", "nit_entidad").agg(
        F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
        avg_as_double().alias("valor_promedio"),
        distinct_count_with_blank("proveedor").alias("num_proveedores")))
    top = settled(top_n_with_ties(agg, n, "valor_total"))
    asked = top.select(F.col("departamento").alias("_d"), F.col("valor_total").alias("_v")).distinct()
    same = F.col("departamento").eqNullSafe(F.col("_d"))
    above = (agg.select("departamento", "valor_total").join(F.broadcast(asked), same & (F.col("valor_total") > F.col("_v")))
             .groupBy("_d", "_v").agg(F.count(F.lit(1)).alias("_above")))
    return (top.join(above, same & (F.col("valor_total") == F.col("_v")), "left")
            .withColumn("rank_depto", (F.coalesce("_above", F.lit(0)) + 1).cast("int")).drop("_d", "_v", "_above"))


def category_comparison(df: DataFrame) -> DataFrame:
    """QRY-39: Salud / Educación / Otros from type and entity names."""
    agg = (df.groupBy(C.sector_from_names("tipo_contrato", "nombre_entidad").alias("categoria"))
           .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total")))
    return (with_total(agg, "valor_total", "_total")
            .withColumn("pct_total", _ratio("valor_total", "_total")).drop("_total"))


def supplier_summary(df: DataFrame, n: int = 20, exclude: Sequence[str] | None = (vocab.NOT_DEFINED,)) -> DataFrame:
    """QRY-40: per supplier, ``TOPN(n)`` by value, then ``No Definido``
    removed (so fewer than ``n`` rows may come back)."""
    agg = settled(df.groupBy("proveedor").agg(
        F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
        avg_as_double().alias("valor_promedio"),
        distinct_count_with_blank("nombre_entidad").alias("num_entidades")))
    top = top_n_with_ties(agg, n, "valor_total")
    return exclude_values(top, "proveedor", exclude) if exclude else top


def entities_in_selected_department(df: DataFrame, selected: Sequence[str]) -> DataFrame:
    """QRY-41: ``SELECTEDVALUE`` rule: the distinct entity count of the
    selected department when exactly one is selected, else blank."""
    f = df.filter(F.col("departamento").isin(*selected)) if selected else df
    agg = f.agg(F.count_distinct("departamento").alias("_nd"),
                distinct_count_with_blank("nombre_entidad").alias("_ne"))
    return agg.select(F.when(F.col("_nd") == 1, F.col("_ne")).cast("bigint").alias("num_entidades"))


def rows_of_department(df: DataFrame, department: str) -> DataFrame:
    """QRY-42: row listing for one department (filter pushed to the scan)."""
    return df.filter(F.col("departamento") == department)


def education_health_values(df: DataFrame) -> DataFrame:
    """QRY-43: ``CALCULATE(SUM, CONTAINSSTRING(sector, ...))``."""
    s = F.lower(F.col("sector"))
    return df.agg(
        F.sum(F.when(s.contains("educaci"), F.col("valor_contrato"))).alias("valor_educacion"),
        F.sum(F.when(s.contains("salud"), F.col("valor_contrato"))).alias("valor_salud"))


def sector_period_matrix(df: DataFrame, grain: str = "year") -> DataFrame:
    """QRY-44: stacked-column data, long form ``(periodo, sector, ...)``."""
    if grain == "year":
        period = F.year("fecha_inicio").cast("string")
    elif grain == "month":
        period = F.date_format("fecha_inicio", "yyyy-MM")
    else:
        raise ValueError("grain must be 'year' or 'month'")
    return (df.filter(F.col("fecha_inicio").isNotNull())
            .groupBy(period.alias("periodo"), C.no_info("sector").alias("sector"))
            .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total")))


def value_vs_count(df: DataFrame) -> DataFrame:
    """QRY-45: scatter data per entity."""
    return df.groupBy("nombre_entidad").agg(F.count(F.lit(1)).alias("num_contratos"),
                                            money_sum().alias("valor_total"))


def fact_with_summaries(m: DataFrame, dep: DataFrame, ent: DataFrame, sec: DataFrame, proc: DataFrame,
                        broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """QRY-46: the report relationships as left joins on the summaries'
    keys (the mart side carries ``Sin info`` for null, so the fact side is
    coalesced the same way).

    Summaries whose rows were counted and are few are broadcast; the entity
    and process summaries can be nearly as large as the fact, so their joins
    are split by key (``split_join``): departments, entities and the
    ``Sin info`` process may hold a large share of the rows.
    """
    d = dep.select(F.col("depto").alias("_dep_key"), F.col("num_contratos").alias("depto_num_contratos"),
                   F.col("valor_total").alias("depto_valor_total"))
    e = ent.select(F.col("nombre_entidad").alias("_ent"), F.col("depto").alias("_edep"),
                   F.col("valor_total").alias("entidad_valor_total"))
    s = sec.select(F.col("sector").alias("_sec_key"), F.col("valor_total").alias("sector_valor_total"))
    p = proc.select(F.col("proceso").alias("_proc_key"), F.col("valor_total").alias("proceso_valor_total"))
    # entities first: theirs is the largest summary, and the fact is narrowest then
    out = split_join(m.withColumn("_dep", C.no_info("departamento")), e, [("nombre_entidad", "_ent"), ("_dep", "_edep")], broadcast_rows=broadcast_rows)
    out = split_join(out, d, [("_dep", "_dep_key")], broadcast_rows=broadcast_rows).drop("_dep")
    out = split_join(out.withColumn("_proc", C.no_info("proceso_de_compra")), p, [("_proc", "_proc_key")], broadcast_rows=broadcast_rows).drop("_proc")
    out = split_join(out.withColumn("_sec", C.no_info("sector")), s, [("_sec", "_sec_key")], broadcast_rows=broadcast_rows).drop("_sec")
    return out.select(*m.columns, "depto_num_contratos", "depto_valor_total", "entidad_valor_total", "sector_valor_total", "proceso_valor_total")


def origin_breakdown(df: DataFrame) -> DataFrame:
    """QRY-47: rows per origin in one pass."""
    return df.groupBy("origen").agg(F.count(F.lit(1)).alias("count"))
