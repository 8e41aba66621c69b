"""Registered dashboard measures (QRY-33 ... QRY-47) over the master mart."""

from __future__ import annotations

from ..operators import marts, measures as M
from .q_contracts import DEP, master
from .registry import register
from .sqlkit import avgd, on_master

BASIC = f"count(*) as num_contratos, sum(valor_contrato) as valor_total, {avgd()} as valor_promedio"


def dcb(c: str) -> str:
    """DAX DISTINCTCOUNT in SQL: blank counts as a value."""
    return f"(count(distinct {c}) + max(case when {c} is null then 1 else 0 end))"


def topn(table: str, n: int, col: str = "valor_total") -> str:
    return (f"select * from {table} where {col} >= (select min({col}) from "
            f"(select {col} from {table} order by {col} desc limit {n}))")


@register("qry_33_kpis", on_master(f"""
select count(*) as total_contratos, sum(valor_contrato) as valor_total, {avgd()} as valor_promedio,
  {dcb('nombre_entidad')} as num_entidades, {dcb('departamento')} as num_departamentos,
  {dcb('proveedor')} as num_proveedores
from master"""), headline=True)
def q_qry_33(spark, d):
    return M.kpis(master(spark, d))


@register("qry_34_rangos_valor", on_master("""
select case when valor_contrato < 1000000 then 'Menor a 1M' when valor_contrato < 5000000 then '1M - 5M'
  when valor_contrato < 10000000 then '5M - 10M' when valor_contrato < 50000000 then '10M - 50M'
  when valor_contrato < 100000000 then '50M - 100M' when valor_contrato < 500000000 then '100M - 500M'
  when valor_contrato < 1000000000 then '500M - 1B' else 'Mayor a 1B' end as rango_valor,
  count(*) as num_contratos, sum(valor_contrato) as valor_total
from master group by 1"""))
def q_qry_34(spark, d):
    return M.by_value_band(master(spark, d))


@register("qry_35_resumen_tipo", on_master(f"""
, a as (select tipo_contrato, {BASIC} from master group by 1),
t as (select sum(valor_contrato) as total from master),
b as (select a.*, cast(valor_total as double) / cast(t.total as double) as pct_total from a, t)
{topn('b', 10)}"""))
def q_qry_35(spark, d):
    return M.type_summary(master(spark, d))


@register("qry_36_resumen_modalidad", on_master("""
, a as (select modalidad, count(*) as num_contratos, sum(valor_contrato) as valor_total from master group by 1),
t as (select count(*) as total from master)
select a.*, cast(num_contratos as double) / cast(t.total as double) as pct_contratos from a, t"""))
def q_qry_36(spark, d):
    return M.modality_summary(master(spark, d))


@register("qry_37_resumen_departamento", on_master(f"""
, a as (select departamento, {BASIC}, {dcb('nombre_entidad')} as num_entidades,
  {dcb('proveedor')} as num_proveedores from master group by 1),
t as (select sum(valor_contrato) as total from master),
b as (select a.*, cast(valor_total as double) / cast(t.total as double) as pct_valor from a, t)
{topn('b', 10)}"""))
def q_qry_37(spark, d):
    return M.department_summary(master(spark, d))


@register("qry_38_resumen_entidad", on_master(f"""
, a as (select nombre_entidad, departamento, nit_entidad, {BASIC}, {dcb('proveedor')} as num_proveedores
  from master group by 1, 2, 3),
r as (select *, rank() over (partition by departamento order by valor_total desc) as rank_depto from a)
{topn('r', 20)}"""))
def q_qry_38(spark, d):
    return M.entity_summary(master(spark, d))


def _has(col: str, word: str) -> str:
    return f"coalesce(contains(lower({col}), '{word.lower()}'), false)"


_SALUD = " or ".join(_has(c, w) for c, w in [("tipo_contrato", "Salud"), ("tipo_contrato", "Hospital"),
                                              ("nombre_entidad", "Salud"), ("nombre_entidad", "Hospital")])
_EDUC = " or ".join(_has(c, w) for c, w in [("tipo_contrato", "Educacion"), ("tipo_contrato", "Educación"),
                                             ("nombre_entidad", "Educacion"), ("nombre_entidad", "Universidad"),
                                             ("nombre_entidad", "Colegio")])


@register("qry_39_comparativa_sectores", on_master(f"""
, a as (select case when {_SALUD} then 'Salud' when {_EDUC} then 'Educación' else 'Otros' end as categoria,
  count(*) as num_contratos, sum(valor_contrato) as valor_total from master group by 1),
t as (select sum(valor_contrato) as total from master)
select a.*, cast(valor_total as double) / cast(t.total as double) as pct_total from a, t"""))
def q_qry_39(spark, d):
    return M.category_comparison(master(spark, d))


@register("qry_40_top_proveedores", on_master(f"""
, a as (select proveedor, {BASIC}, {dcb('nombre_entidad')} as num_entidades from master group by 1),
top as ({topn('a', 20)})
select * from top where proveedor is null or proveedor <> 'No Definido'"""))
def q_qry_40(spark, d):
    return M.supplier_summary(master(spark, d))


@register("qry_41_entidades_depto_seleccionado", on_master(f"""
select cast(case when count(distinct departamento) = 1 then {dcb('nombre_entidad')} end as bigint) as num_entidades
from master where departamento in ('{DEP}')"""))
def q_qry_41(spark, d):
    return M.entities_in_selected_department(master(spark, d), [DEP])


@register("qry_42_filas_departamento", on_master(f"select * from master where departamento = '{DEP}'"))
def q_qry_42(spark, d):
    return M.rows_of_department(master(spark, d), DEP)


@register("qry_43_valor_educacion_salud", on_master("""
select sum(case when contains(lower(sector), 'educaci') then valor_contrato end) as valor_educacion,
  sum(case when contains(lower(sector), 'salud') then valor_contrato end) as valor_salud
from master"""))
def q_qry_43(spark, d):
    return M.education_health_values(master(spark, d))


@register("qry_44_sector_periodo_anno", on_master("""
select cast(year(fecha_inicio) as varchar) as periodo, coalesce(sector, 'Sin info') as sector,
  count(*) as num_contratos, sum(valor_contrato) as valor_total
from master where fecha_inicio is not null group by 1, 2"""))
def q_qry_44(spark, d):
    return M.sector_period_matrix(master(spark, d), "year")


@register("qry_44_sector_periodo_mes", on_master("""
select strftime(fecha_inicio, '%Y-%m') as periodo, coalesce(sector, 'Sin info') as sector,
  count(*) as num_contratos, sum(valor_contrato) as valor_total
from master where fecha_inicio is not null group by 1, 2"""))
def q_qry_44m(spark, d):
    return M.sector_period_matrix(master(spark, d), "month")


@register("qry_45_valor_vs_cantidad", on_master("""
select nombre_entidad, count(*) as num_contratos, sum(valor_contrato) as valor_total from master group by 1"""))
def q_qry_45(spark, d):
    return M.value_vs_count(master(spark, d))


@register("qry_46_relaciones_resumenes", on_master("""
, dep as (select coalesce(departamento, 'Sin info') as depto, count(*) as num_contratos,
  sum(valor_contrato) as valor_total from master group by 1),
ent as (select nombre_entidad, coalesce(departamento, 'Sin info') as depto, sum(valor_contrato) as valor_total
  from master group by 1, 2),
sec as (select coalesce(sector, 'Sin info') as sector, sum(valor_contrato) as valor_total from master group by master.sector),
proc as (select coalesce(proceso_de_compra, 'Sin info') as proceso, sum(valor_contrato) as valor_total
  from master group by 1)
select m.*, dep.num_contratos as depto_num_contratos, dep.valor_total as depto_valor_total,
  ent.valor_total as entidad_valor_total, sec.valor_total as sector_valor_total,
  proc.valor_total as proceso_valor_total
from master m
left join dep on coalesce(m.departamento, 'Sin info') = dep.depto
left join ent on m.nombre_entidad = ent.nombre_entidad and coalesce(m.departamento, 'Sin info') = ent.depto
left join sec on coalesce(m.sector, 'Sin info') = sec.sector
left join proc on coalesce(m.proceso_de_compra, 'Sin info') = proc.proceso"""))
def q_qry_46(spark, d):
    m = master(spark, d)
    return M.fact_with_summaries(m, marts.resumen_departamento(m), marts.entity_totals(m),
                                 marts.resumen_sector(m), marts.resumen_tipo_proceso(m))


@register("qry_47_por_origen", on_master("select origen, count(*) as count from master group by 1"))
def q_qry_47(spark, d):
    return M.origin_breakdown(master(spark, d))
