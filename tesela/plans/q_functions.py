"""Registered table functions (FN-01 ... FN-05)."""

from __future__ import annotations

from . import tablefuncs as T
from .q_contracts import DEP, YEAR, master
from .registry import ORACLE, register
from .sqlkit import on_master


@register("fn_01_entidades_por_departamento", on_master(f"""
select nombre_entidad as entidad, count(*) as total_contratos, sum(valor_contrato) as valor_total
from master where departamento = '{DEP}' group by 1 order by valor_total desc, entidad limit 20"""))
def q_fn_01(spark, d):
    return T.entidades_por_departamento(master(spark, d), DEP, 20)


@register("fn_02_contratos_por_sector", on_master(f"""
select case when lower(objeto_contrato) like '%educacion%' then 'Educación'
  when lower(objeto_contrato) like '%salud%' then 'Salud' else 'Otros' end as sector,
  count(*) as total_contratos, sum(valor_contrato) as valor_total
from master where year(fecha_inicio) = {YEAR} group by 1"""))
def q_fn_02(spark, d):
    return T.contratos_por_sector(master(spark, d), YEAR)


@register("fn_03_top_proveedores_region", on_master(f"""
select proveedor, count(*) as num_contratos, sum(valor_contrato) as valor_total
from master where departamento = '{DEP}' group by 1 order by valor_total desc, proveedor nulls first limit 10"""))
def q_fn_03(spark, d):
    return T.top_proveedores_region(master(spark, d), DEP, 10)


@register("fn_04_contratos_un_proponente", on_master(f"""
select nombre_entidad as entidad, objeto_contrato, valor_contrato, proveedor
from master where year(fecha_inicio) = {YEAR} and numero_proponentes = 1
order by valor_contrato desc, entidad, objeto_contrato, proveedor nulls first limit 100"""))
def q_fn_04(spark, d):
    return T.contratos_un_proponente(master(spark, d), YEAR)


@register("fn_05_dataset_stats", on_master(
    "select 'contratacion' as dataset, cast(max(fecha_inicio) as timestamp) as ultima_actualizacion, "
    "count(*) as num_registros from master"))
def q_fn_05(spark, d):
    return T.dataset_stats(master(spark, d))


@register("fn_01_sql_entidades_por_departamento", on_master(f"""
select nombre_entidad as entidad, count(*) as total_contratos, sum(valor_contrato) as valor_total
from master where departamento = '{DEP}' group by 1 order by valor_total desc, entidad limit 20"""))
def q_fn_01_sql(spark, d):
    T.register_sql_functions(spark, master(spark, d))
    return spark.sql(f"SELECT * FROM entidades_por_departamento('{DEP}', 20)")


@register("fn_02_sql_contratos_por_sector", ORACLE["fn_02_contratos_por_sector"])
def q_fn_02_sql(spark, d):
    T.register_sql_functions(spark, master(spark, d))
    return spark.sql(f"SELECT * FROM contratos_por_sector({YEAR})")


@register("fn_03_sql_top_proveedores_region", ORACLE["fn_03_top_proveedores_region"])
def q_fn_03_sql(spark, d):
    T.register_sql_functions(spark, master(spark, d))
    return spark.sql(f"SELECT * FROM top_proveedores_region('{DEP}', 10)")


@register("fn_05_sql_dataset_stats", ORACLE["fn_05_dataset_stats"])
def q_fn_05_sql(spark, d):
    T.register_sql_functions(spark, master(spark, d))
    return spark.sql("SELECT * FROM dataset_stats()")


@register("fn_04_sql_contratos_un_proponente", on_master(f"""
select nombre_entidad as entidad, objeto_contrato, valor_contrato, proveedor
from master where year(fecha_inicio) = {YEAR} and numero_proponentes = 1
order by valor_contrato desc, entidad, objeto_contrato, proveedor nulls first limit 100"""))
def q_fn_04_sql(spark, d):
    T.register_sql_functions(spark, master(spark, d))
    return spark.sql(f"SELECT * FROM contratos_un_proponente({YEAR})")
