"""Marts (MRT-01 ... MRT-06).

Each mart is a grouped aggregate: partial aggregation runs map-side, so a
department holding a third of all rows costs one hash-map entry per task,
not a third of the data in one task. ``count_distinct`` next to other
aggregates is planned by Spark as a two-level aggregation keyed by
``(group, value)``, which spreads a hot group over many tasks too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import vocab
from .aggregates import avg_money_2, money_sum, order_limit

MASTER_COLUMNS = [
    "id_contrato", "referencia", "nombre_entidad", "nit_entidad", "departamento", "ciudad",
    "proceso_de_compra", "tipo_contrato", "modalidad", "estado_contrato", "fecha_firma",
    "fecha_inicio", "valor_contrato", "valor_pagado", "proveedor", "sector",
]
# Extra columns the table functions read (objeto_contrato, numero_proponentes)
# and the origin tag the measures group on.
MASTER_EXTRA = ["objeto_contrato", "numero_proponentes", "origen"]

# Source (clean SECOP II) names -> documented master names.
SECOP_II_TO_MASTER = {
    "referencia_del_contrato": "referencia",
    "tipo_de_contrato": "tipo_contrato",
    "modalidad_de_contratacion": "modalidad",
    "proveedor_adjudicado": "proveedor",
    "fecha_de_firma": "fecha_firma",
    "fecha_de_inicio_del_contrato": "fecha_inicio",
    "valor_del_contrato": "valor_contrato",
}


def master_from_clean(clean: DataFrame) -> DataFrame:
    """PRJ-07: clean SECOP II names -> master names, blank text -> DATE,
    money -> DECIMAL(20,2). Columns already in master form pass through."""
    cols = set(clean.columns)
    out: list[Column] = []
    for src, dst in SECOP_II_TO_MASTER.items():
        if dst in cols:
            continue
        if src in cols:
            cols.discard(src)
            out.append(F.col(src).alias(dst))
    df = clean.select(*[F.col(c) for c in clean.columns if c in cols], *out)
    exprs = []
    for c in df.columns:
        if c in ("fecha_firma", "fecha_inicio") and dict(df.dtypes)[c] not in ("date",):
            exprs.append(C.blank_to_date(c).alias(c))
        elif c in ("valor_contrato", "valor_pagado") and not dict(df.dtypes)[c].startswith("decimal"):
            exprs.append(F.col(c).try_cast("decimal(20,2)").alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def master(clean: DataFrame, with_load_time: bool = True) -> DataFrame:
    """MRT-01 ``marts.contratacion``: documented columns, value > 0.

    ``fecha_carga`` is the load time; it is left out of comparisons.
    """
    df = master_from_clean(clean)
    keep = [c for c in MASTER_COLUMNS + MASTER_EXTRA if c in df.columns]
    out = df.filter(F.col("valor_contrato").isNotNull() & (F.col("valor_contrato") > 0)).select(*keep)
    if with_load_time:
        out = out.withColumn("fecha_carga", F.current_timestamp())
    return out


def resumen_departamento(m: DataFrame) -> DataFrame:
    """MRT-02: groups on the coalesced department (the alias is not an input
    column name, so the output expression is the grouping key)."""
    return (m.groupBy(C.no_info("departamento").alias("depto"))
            .agg(F.count(F.lit(1)).alias("num_contratos"),
                 money_sum().alias("valor_total"),
                 avg_money_2().alias("valor_promedio"),
                 F.count_distinct("nombre_entidad").alias("num_entidades")))


def entity_totals(m: DataFrame) -> DataFrame:
    """Every (entity, department) pair with its contracts and value."""
    return (m.groupBy("nombre_entidad", C.no_info("departamento").alias("depto"))
            .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total")))


def resumen_entidad(m: DataFrame, n: int = 100) -> DataFrame:
    """MRT-03: top ``n`` (entity, department) pairs by value."""
    return order_limit(entity_totals(m), n, F.col("valor_total").desc(), F.col("nombre_entidad").asc(), F.col("depto").asc())


def resumen_sector(m: DataFrame) -> DataFrame:
    """MRT-04: the output alias equals the input name, so SQL groups on the
    *raw* sector; null and a literal ``Sin info`` stay two groups. Adds
    ``valor_promedio`` (DOUBLE), which the sector-average anomaly needs."""
    agg = (m.groupBy("sector")
           .agg(F.count(F.lit(1)).alias("num_contratos"),
                money_sum().alias("valor_total"),
                avg_money_2().alias("valor_promedio")))
    return agg.select(C.no_info("sector").alias("sector"), "num_contratos", "valor_total", "valor_promedio")


def resumen_tipo_proceso(m: DataFrame) -> DataFrame:
    """MRT-05: near-unique key; partial aggregation buys little, AQE
    coalesces the shuffle output."""
    return (m.groupBy(C.no_info("proceso_de_compra").alias("proceso"))
            .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total")))


def catalog_from_master(m: DataFrame) -> DataFrame:
    """A dataset catalogue simulated from the master mart (the open-data
    catalogue API of the source is not reachable): one dataset per
    (entity, purchase process), tags = its sorted distinct modalities."""
    return (m.groupBy(F.col("nombre_entidad").alias("organization"), F.col("proceso_de_compra").alias("id"))
            .agg(F.array_sort(F.collect_set("modalidad")).alias("tags"),
                 F.min("fecha_firma").alias("created_at"),
                 F.max("fecha_inicio").alias("last_modified_at")))


def resumen_catalogo(catalog: DataFrame, as_of: str) -> DataFrame:
    """MRT-06: per organisation, datasets, distinct tag sets, first and last
    dates, and datasets touched in the 30 days before ``as_of``."""
    recent = F.col("last_modified_at") >= F.date_sub(F.lit(as_of).cast("date"), 30)
    return (catalog.groupBy("organization")
            .agg(F.count(F.lit(1)).alias("num_datasets"),
                 F.count_distinct("tags").alias("num_tags"),
                 F.min("created_at").alias("primer_dataset"),
                 F.max("last_modified_at").alias("ultimo_update"),
                 F.count(F.when(recent, F.lit(1))).alias("datasets_activos")))


def row_count_check(m: DataFrame, name: str = "marts.contratacion") -> DataFrame:
    """The migration's closing check: ``(tabla, registros)``."""
    return m.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("tabla"), "registros")


__all__ = [
    "master", "master_from_clean", "resumen_departamento", "resumen_entidad", "resumen_sector",
    "resumen_tipo_proceso", "catalog_from_master", "resumen_catalogo", "row_count_check", "vocab",
]
