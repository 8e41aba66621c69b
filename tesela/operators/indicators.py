"""Contract indicators (QRY-01 ... QRY-25) over the master mart.

Conventions that keep the results deterministic and scalable:

- every ``LIMIT`` gets a total order (value, then the group keys), and is
  planned as a distributed top-n (``TakeOrderedAndProject``);
- shares use a one-row total joined by broadcast, never ``OVER ()`` on raw
  rows;
- averages of money are exact: ``CAST(SUM(x) AS DOUBLE) / COUNT(x)``;
- year and month are INT.
"""

from __future__ import annotations

import datetime as _dt
import decimal as _decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import vocab
from .aggregates import avg_as_double, money_sum, order_limit, pct_half_up, with_total
from .quantiles import percentiles
from .split_join import split_join

# Default parameters for the driver tables (department, year, as-of date).
DEFAULT_DEPARTMENT = "NATION_7"
DEFAULT_DEPARTMENTS = ("NATION_7", "NATION_3", "NATION_1")
DEFAULT_YEAR = 1998
DEFAULT_YEARS = (1997, 1998)
DEFAULT_AS_OF = "2001-11-04"


def _year_range(year: int):
    """``EXTRACT(YEAR FROM fecha_inicio) = year`` as a range predicate, which
    Parquet statistics can prune on."""
    start = _dt.date(year, 1, 1)
    end = _dt.date(year + 1, 1, 1)
    return (F.col("fecha_inicio") >= F.lit(start)) & (F.col("fecha_inicio") < F.lit(end))


def _basic(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_contratos"),
        money_sum().alias("valor_total"),
        avg_as_double().alias("valor_promedio"),
    )


# --------------------------------------------------------------- E-02
def value_distribution(m: DataFrame) -> DataFrame:
    """QRY-01: min, max, avg, q25, median, q75, p95, sample stddev."""
    moments = m.agg(
        F.min("valor_contrato").alias("valor_minimo"),
        F.max("valor_contrato").alias("valor_maximo"),
        avg_as_double().alias("valor_promedio"),
        F.stddev_samp(F.col("valor_contrato").cast("double")).alias("desviacion_estandar"),
    )
    q = percentiles(m, "valor_contrato", {"q25": 0.25, "mediana": 0.5, "q75": 0.75, "p95": 0.95})
    return moments.crossJoin(q).select(
        "valor_minimo", "valor_maximo", "valor_promedio", "q25", "mediana", "q75", "p95", "desviacion_estandar")


def by_contract_type(m: DataFrame) -> DataFrame:
    """QRY-02: per type with the share of rows (``porcentaje``)."""
    agg = _basic(m, "tipo_contrato")
    return (with_total(agg, "num_contratos", "_n")
            .select("tipo_contrato", "num_contratos", "valor_total", "valor_promedio",
                    pct_half_up("num_contratos", "_n").alias("porcentaje")))


def monthly(m: DataFrame) -> DataFrame:
    """QRY-03: contracts and value per (year, month) of the start date."""
    return (m.filter(F.col("fecha_inicio").isNotNull())
            .groupBy(C.year_of("fecha_inicio").alias("anno"), C.month_of("fecha_inicio").alias("mes"))
            .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total")))


def by_modality(m: DataFrame) -> DataFrame:
    """QRY-04."""
    return _basic(m, "modalidad")


def department_year(m: DataFrame, years=DEFAULT_YEARS) -> DataFrame:
    """QRY-05: groups on the raw department (the alias differs, so SQL
    groups on the input column) and shows ``Sin información`` for null."""
    yr = C.year_of("fecha_inicio")
    pred = None
    for y in years:
        p = _year_range(y)
        pred = p if pred is None else (pred | p)
    agg = (m.filter(pred)
           .groupBy(F.col("departamento").alias("_dep"), yr.alias("anno"))
           .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
                avg_as_double().alias("valor_promedio")))
    return agg.select(C.no_info("_dep", vocab.NO_INFORMATION).alias("departamento"),
                      "num_contratos", "valor_total", "valor_promedio", "anno")


def top_departments(m: DataFrame, n: int = 10) -> DataFrame:
    """QRY-06: the department summary's top ``n`` by value, with the
    supplier count the summary lacks."""
    agg = (m.groupBy(C.no_info("departamento").alias("departamento"))
           .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
                avg_as_double().alias("valor_promedio"),
                F.count_distinct("nombre_entidad").alias("num_entidades"),
                F.count_distinct("proveedor").alias("num_proveedores")))
    return order_limit(agg, n, F.col("valor_total").desc(), F.col("departamento").asc())


def entities_of_department(m: DataFrame, department: str = DEFAULT_DEPARTMENT, n: int = 20) -> DataFrame:
    """QRY-07: top entities of one department (filter reaches the scan)."""
    agg = _basic(m.filter(F.col("departamento") == department), "nombre_entidad")
    return order_limit(agg, n, F.col("valor_total").desc(), F.col("nombre_entidad").asc())


def entity_rank_in_department(m: DataFrame, departments=DEFAULT_DEPARTMENTS,
                              n: int = 30) -> DataFrame:
    """QRY-08: ``ROW_NUMBER`` of entities inside their department, over all
    entities of the listed departments (the result is the first ``n`` rows,
    so a department is ranked only up to ``n``: a map-side group limit)."""
    agg = (m.groupBy("nombre_entidad", C.no_info("departamento").alias("departamento"))
           .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
                avg_as_double().alias("valor_promedio")))
    w = Window.partitionBy("departamento").orderBy(F.col("valor_total").desc(), F.col("nombre_entidad").asc())
    ranked = (agg.filter(F.col("departamento").isin(*departments)).withColumn("ranking", F.row_number().over(w))
              .filter(F.col("ranking") <= n))
    return order_limit(ranked, n, F.col("departamento").asc(), F.col("ranking").asc())


def entities_by_count(m: DataFrame, n: int = 20) -> DataFrame:
    """QRY-09: (entity, department) pairs with most contracts."""
    agg = (m.groupBy("nombre_entidad", "departamento")
           .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total")))
    return order_limit(agg, n, F.col("num_contratos").desc(), F.col("valor_total").desc(),
                       F.col("nombre_entidad").asc(), F.col("departamento").asc_nulls_first())


def sector_buckets_year(m: DataFrame, year: int = DEFAULT_YEAR) -> DataFrame:
    """QRY-10: five case-sensitive sector classes in one year."""
    return _basic(m.filter(_year_range(year)), C.sector_category5("sector").alias("categoria"))


def sector_share(m: DataFrame) -> DataFrame:
    """QRY-11: value share per sector through a one-row total. Groups on
    the raw sector (as the SQL does), labels null ``Sin información``."""
    agg = m.groupBy(F.col("sector").alias("_s")).agg(F.count(F.lit(1)).alias("num_contratos"),
                                                     money_sum().alias("valor_total"))
    return (with_total(agg, "valor_total", "_t")
            .select(C.no_info("_s", vocab.NO_INFORMATION).alias("sector"), "num_contratos", "valor_total",
                    pct_half_up("valor_total", "_t").alias("porcentaje")))


def top_process_types(process_summary: DataFrame, n: int = 15) -> DataFrame:
    """QRY-12: top processes by count from MRT-05 with a rounded ratio."""
    out = process_summary.select(
        "proceso", "num_contratos", "valor_total",
        F.round(F.try_divide(F.col("valor_total").cast("double"), F.col("num_contratos").cast("double")), 0)
        .alias("valor_promedio_contrato"))
    return order_limit(out, n, F.col("num_contratos").desc(), F.col("valor_total").desc(), F.col("proceso").asc())


def frequent_processes(m: DataFrame, n: int = 10) -> DataFrame:
    """QRY-13."""
    agg = _basic(m, "proceso_de_compra")
    return order_limit(agg, n, F.col("num_contratos").desc(), F.col("valor_total").desc(),
                       F.col("proceso_de_compra").asc())


def top_entities_last_year(m: DataFrame, department: str = DEFAULT_DEPARTMENT, as_of: str = DEFAULT_AS_OF,
                           n: int = 10) -> DataFrame:
    """QRY-14 (P1): ``fecha_inicio >= as_of - INTERVAL 1 YEAR``."""
    since = F.add_months(F.lit(as_of).cast("date"), -12)
    agg = (m.filter((F.col("departamento") == department) & (F.col("fecha_inicio") >= since))
           .groupBy("nombre_entidad", "departamento")
           .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
                F.max("fecha_inicio").alias("ultimo_contrato")))
    return order_limit(agg, n, F.col("valor_total").desc(), F.col("nombre_entidad").asc())


def education_vs_health(m: DataFrame, year: int = DEFAULT_YEAR) -> DataFrame:
    """QRY-15 (P2): paid and pending value for education and health."""
    f = m.filter(_year_range(year) & C.is_education_or_health("sector"))
    return (f.groupBy(C.sector_category3("sector").alias("sector"))
            .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
                 money_sum("valor_pagado").alias("valor_pagado"))
            .withColumn("valor_pendiente", F.col("valor_total") - F.col("valor_pagado")))


def suppliers_of_region(m: DataFrame, department: str = DEFAULT_DEPARTMENT, n: int = 20) -> DataFrame:
    """QRY-16 (P3): suppliers with the number of distinct buying entities."""
    f = m.filter((F.col("departamento") == department) & F.col("proveedor").isNotNull() & (F.col("proveedor") != ""))
    agg = f.groupBy("proveedor").agg(
        F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total"),
        avg_as_double().alias("valor_promedio"),
        F.count_distinct("nombre_entidad").alias("num_entidades_contratantes"))
    return order_limit(agg, n, F.col("valor_total").desc(), F.col("proveedor").asc())


def repeated_pairs(m: DataFrame, process: str | None = None, min_count: int = 5) -> DataFrame:
    """QRY-17 (A1): entity-supplier pairs with more than ``min_count``
    contracts (``HAVING COUNT(*) > min_count``), optional process filter."""
    f = m if process is None else m.filter(F.col("proceso_de_compra") == process)
    return (f.groupBy("nombre_entidad", "proveedor")
            .agg(F.count(F.lit(1)).alias("num_contratos_similar"), money_sum().alias("valor_total"),
                 avg_as_double().alias("valor_promedio"))
            .filter(F.col("num_contratos_similar") > min_count))


def _near(x: float, up: bool) -> _decimal.Decimal:
    """``x`` in cents, moved by the error of a double and a cent."""
    slack = _decimal.Decimal(abs(x)) * _decimal.Decimal("1e-15") + _decimal.Decimal("0.01")
    exact = _decimal.Decimal(x) + (slack if up else -slack)
    return exact.quantize(_decimal.Decimal("0.01"), rounding=_decimal.ROUND_CEILING if up else _decimal.ROUND_FLOOR)


def iqr_outliers(m: DataFrame, k: float = 1.5, n: int = 50) -> DataFrame:
    """QRY-18 (A2): values outside ``[q25 - k*IQR, q75 + k*IQR]``.

    The fences are two numbers on the driver. As DECIMAL literals, a cent
    wider than a double's error, they go to the scan as filters on the raw
    column; the exact comparison in DOUBLE follows.
    """
    p25, p75 = percentiles(m, "valor_contrato", {"p25": 0.25, "p75": 0.75}).first()
    v, raw = F.col("valor_contrato").cast("double"), F.col("valor_contrato")
    if p25 is None:
        out = m.where(F.lit(False))
    else:
        lo, hi = p25 - k * (p75 - p25), p75 + k * (p75 - p25)
        kind = m.schema["valor_contrato"].dataType
        low, high = (F.lit(_near(x, up)).cast(kind) for x, up in ((lo, True), (hi, False)))
        out = m.where((raw < low) | (raw > high)).where((v < lo) | (v > hi))
    out = out.select("id_contrato", "nombre_entidad", "proveedor", "valor_contrato", "fecha_inicio", "departamento")
    return order_limit(out, n, F.col("valor_contrato").desc(), F.col("id_contrato").asc(),
                       F.col("nombre_entidad").asc(), F.col("proveedor").asc(), F.col("fecha_inicio").asc())


def above_sector_average(m: DataFrame, sector_summary: DataFrame, factor: float = 10.0, n: int = 30) -> DataFrame:
    """QRY-19 (A3): value above ``factor`` x the sector average.

    Inner equi-join on the raw sector against MRT-04 (one row per sector).
    The summary is counted and broadcast; were it large, the join would be
    split by key, since a sector can hold a large share of the rows. Null
    sectors drop out, as in the SQL.
    """
    r = sector_summary.select(F.col("sector").alias("_rs"), F.col("valor_promedio").alias("promedio_sector"))
    j = split_join(m, r, [("sector", "_rs")], "inner")
    v = F.col("valor_contrato").cast("double")
    avg = F.col("promedio_sector").cast("double")
    out = (j.filter(v > avg * factor)
           .select("id_contrato", "nombre_entidad", "sector", "valor_contrato", "proveedor",
                   F.col("promedio_sector"),
                   F.round(F.try_divide(v, avg), 6).alias("ratio_vs_promedio")))
    return order_limit(out, n, F.col("ratio_vs_promedio").desc(), F.col("id_contrato").asc(),
                       F.col("valor_contrato").desc(), F.col("proveedor").asc())


# --------------------------------------------------------------- catalogue proxies
def publication_activity(m: DataFrame, n: int = 50) -> DataFrame:
    """QRY-20: per entity, contracts, distinct processes, first/last start."""
    agg = m.groupBy("nombre_entidad").agg(
        F.count(F.lit(1)).alias("num_contratos"),
        F.count_distinct("proceso_de_compra").alias("num_tipos_proceso"),
        F.min("fecha_inicio").alias("primera_publicacion"),
        F.max("fecha_inicio").alias("ultima_publicacion"))
    return order_limit(agg, n, F.col("num_contratos").desc(), F.col("nombre_entidad").asc())


def simulated_catalog(m: DataFrame) -> DataFrame:
    """QRY-21: entity x region as a simulated dataset catalogue."""
    return m.groupBy(F.col("nombre_entidad").alias("organizacion"), F.col("departamento").alias("region")).agg(
        F.count(F.lit(1)).alias("num_datasets_simulado"),
        F.count_distinct("proceso_de_compra").alias("num_tipos_datos"),
        money_sum().alias("tamano_simulado"))


def sector_coverage(m: DataFrame) -> DataFrame:
    """QRY-22 (P-C1)."""
    return m.groupBy("sector").agg(
        F.count(F.lit(1)).alias("num_registros"),
        F.count_distinct("nombre_entidad").alias("num_entidades"),
        money_sum().alias("valor_total"))


def freshness(m: DataFrame, as_of: str = DEFAULT_AS_OF, n: int = 20) -> DataFrame:
    """QRY-23 (P-C2): span and freshness class per entity x department."""
    agg = (m.filter(F.col("fecha_inicio").isNotNull())
           .groupBy("nombre_entidad", "departamento")
           .agg(F.count(F.lit(1)).alias("num_contratos"),
                F.min("fecha_inicio").alias("desde"), F.max("fecha_inicio").alias("hasta")))
    out = agg.select("nombre_entidad", "departamento", "num_contratos", "desde", "hasta",
                     C.days_between("hasta", "desde").alias("rango_dias"),
                     C.freshness_class("hasta", F.lit(as_of).cast("date")).alias("estado_actualizacion"))
    return order_limit(out, n, F.col("num_contratos").desc(), F.col("nombre_entidad").asc(),
                       F.col("departamento").asc_nulls_first())


def least_active_regions(m: DataFrame, n: int = 10) -> DataFrame:
    """QRY-24 (P-C3): ``ROW_NUMBER() OVER (ORDER BY COUNT(*))``, first ``n``.

    The row number of the first ``n`` rows in a total order is their
    position, so a distributed top-n followed by a window over ``n`` rows
    replaces the global window over every group.
    """
    agg = (m.groupBy(F.col("departamento").alias("_dep"))
           .agg(F.count(F.lit(1)).alias("num_contratos"),
                F.count_distinct("nombre_entidad").alias("num_entidades"),
                money_sum().alias("valor_total"))
           .withColumn("region", C.no_info("_dep", vocab.NO_INFORMATION)))
    first = order_limit(agg, n, F.col("num_contratos").asc(), F.col("_dep").asc_nulls_first())
    w = Window.orderBy(F.col("num_contratos").asc(), F.col("_dep").asc_nulls_first())
    return first.select("region", "num_contratos", "num_entidades", "valor_total",
                        F.row_number().over(w).alias("ranking_disponibilidad"))


def coverage_gaps(m: DataFrame) -> DataFrame:
    """QRY-25: coverage class per department."""
    agg = m.groupBy("departamento").agg(F.count(F.lit(1)).alias("num_contratos"))
    return agg.select(F.lit("Posible brecha").alias("nota"), "departamento", "num_contratos",
                      C.coverage_class("num_contratos").alias("clasificacion"))
