"""Table functions (FN-01 ... FN-05), the reference's only user functions.

Each is available two ways: as a Python function returning a DataFrame,
and as a Spark SQL table function (``CREATE TEMPORARY FUNCTION ...
RETURNS TABLE``) over a view of the master mart, so SQL users call
``SELECT * FROM entidades_por_departamento('NATION_7', 20)``.

Spark SQL functions reject ``LIMIT <parameter>``; the SQL bodies use
``row_number() <= p``, which Spark plans as a window group limit (each task
keeps its own first ``p`` rows before the exchange).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators.aggregates import money_sum, order_limit
from ..operators.validations import dataset_stats as _stats


def _year(m: DataFrame, year: int) -> DataFrame:
    lo, hi = _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)
    return m.filter((F.col("fecha_inicio") >= F.lit(lo)) & (F.col("fecha_inicio") < F.lit(hi)))


def entidades_por_departamento(m: DataFrame, departamento: str, limite: int = 20) -> DataFrame:
    """FN-01: top entities of a department by value."""
    agg = (m.filter(F.col("departamento") == departamento).groupBy(F.col("nombre_entidad").alias("entidad"))
           .agg(F.count(F.lit(1)).alias("total_contratos"), money_sum().alias("valor_total")))
    return order_limit(agg, limite, F.col("valor_total").desc(), F.col("entidad").asc())


def contratos_por_sector(m: DataFrame, anno: int) -> DataFrame:
    """FN-02: three sector buckets of the contract object in one year
    (ordered by the sum, which is the intent of the source function)."""
    return (_year(m, anno).groupBy(C.sector_from_object("objeto_contrato").alias("sector"))
            .agg(F.count(F.lit(1)).alias("total_contratos"), money_sum().alias("valor_total")))


def top_proveedores_region(m: DataFrame, departamento: str, limite: int = 10) -> DataFrame:
    """FN-03: top suppliers of a department by value."""
    agg = (m.filter(F.col("departamento") == departamento).groupBy("proveedor")
           .agg(F.count(F.lit(1)).alias("num_contratos"), money_sum().alias("valor_total")))
    return order_limit(agg, limite, F.col("valor_total").desc(), F.col("proveedor").asc_nulls_first())


def contratos_un_proponente(m: DataFrame, anno: int, limite: int = 100) -> DataFrame:
    """FN-04: single-bidder contracts of a year, top ``limite`` by value."""
    f = _year(m, anno).filter(F.col("numero_proponentes") == 1).select(
        F.col("nombre_entidad").alias("entidad"), "objeto_contrato", "valor_contrato", "proveedor")
    return order_limit(f, limite, F.col("valor_contrato").desc(), F.col("entidad").asc(),
                       F.col("objeto_contrato").asc(), F.col("proveedor").asc_nulls_first())


def dataset_stats(m: DataFrame) -> DataFrame:
    """FN-05."""
    return _stats(m, "contratacion", "fecha_inicio")


SQL_FUNCTIONS = {
    "entidades_por_departamento": """
CREATE OR REPLACE TEMPORARY FUNCTION entidades_por_departamento(p_departamento STRING, p_limite INT DEFAULT 20)
RETURNS TABLE (entidad STRING, total_contratos BIGINT, valor_total DECIMAL(30,2))
RETURN SELECT entidad, total_contratos, valor_total FROM (
  SELECT nombre_entidad AS entidad, count(*) AS total_contratos, sum(valor_contrato) AS valor_total,
         row_number() OVER (ORDER BY sum(valor_contrato) DESC, nombre_entidad) AS rn
  FROM {view} WHERE departamento = p_departamento GROUP BY nombre_entidad)
WHERE rn <= p_limite""",
    "contratos_por_sector": """
CREATE OR REPLACE TEMPORARY FUNCTION contratos_por_sector(p_anno INT)
RETURNS TABLE (sector STRING, total_contratos BIGINT, valor_total DECIMAL(30,2))
RETURN SELECT CASE WHEN lower(objeto_contrato) LIKE '%educacion%' THEN 'Educación'
                   WHEN lower(objeto_contrato) LIKE '%salud%' THEN 'Salud' ELSE 'Otros' END AS sector,
              count(*) AS total_contratos, sum(valor_contrato) AS valor_total
FROM {view} WHERE fecha_inicio >= make_date(p_anno, 1, 1) AND fecha_inicio < make_date(p_anno + 1, 1, 1) GROUP BY 1""",
    "top_proveedores_region": """
CREATE OR REPLACE TEMPORARY FUNCTION top_proveedores_region(p_departamento STRING, p_limite INT DEFAULT 10)
RETURNS TABLE (proveedor STRING, num_contratos BIGINT, valor_total DECIMAL(30,2))
RETURN SELECT proveedor, num_contratos, valor_total FROM (
  SELECT proveedor, count(*) AS num_contratos, sum(valor_contrato) AS valor_total,
         row_number() OVER (ORDER BY sum(valor_contrato) DESC, proveedor) AS rn
  FROM {view} WHERE departamento = p_departamento GROUP BY proveedor)
WHERE rn <= p_limite""",
    "contratos_un_proponente": """
CREATE OR REPLACE TEMPORARY FUNCTION contratos_un_proponente(p_anno INT)
RETURNS TABLE (entidad STRING, objeto_contrato STRING, valor_contrato DECIMAL(20,2), proveedor STRING)
RETURN SELECT entidad, objeto_contrato, valor_contrato, proveedor FROM (
  SELECT nombre_entidad AS entidad, objeto_contrato, valor_contrato, proveedor,
         row_number() OVER (ORDER BY valor_contrato DESC, nombre_entidad, objeto_contrato, proveedor) AS rn
  FROM {view} WHERE fecha_inicio >= make_date(p_anno, 1, 1) AND fecha_inicio < make_date(p_anno + 1, 1, 1)
    AND numero_proponentes = 1)
WHERE rn <= 100""",
    "dataset_stats": """
CREATE OR REPLACE TEMPORARY FUNCTION dataset_stats()
RETURNS TABLE (dataset STRING, ultima_actualizacion TIMESTAMP_NTZ, num_registros BIGINT)
RETURN SELECT 'contratacion', CAST(max(fecha_inicio) AS TIMESTAMP_NTZ), count(*) FROM {view}""",
}


def register_sql_functions(spark: SparkSession, master: DataFrame, view: str = "marts_contratacion") -> list[str]:
    """Expose the master mart as ``view`` and create the five SQL table
    functions over it; returns their names."""
    master.createOrReplaceTempView(view)
    for body in SQL_FUNCTIONS.values():
        spark.sql(body.format(view=view))
    return list(SQL_FUNCTIONS)
