"""Registered queries over the master mart: marts, indicators, validations,
filters and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters, indicators as I, marts, upkeep, validations as V
from . import registry, warehouse
from .registry import register
from .sqlkit import avg2, avgd, on_master, pct, sig

DEP = I.DEFAULT_DEPARTMENT
DEPS = I.DEFAULT_DEPARTMENTS
YEAR = I.DEFAULT_YEAR
YEARS = I.DEFAULT_YEARS
AS_OF = I.DEFAULT_AS_OF
_DEPS_SQL = ", ".join(f"'{d}'" for d in DEPS)
_YEARS_SQL = ", ".join(str(y) for y in YEARS)

BASIC = f"count(*) as num_contratos, sum(valor_contrato) as valor_total, {avgd()} as valor_promedio"


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-01 over the materialised contract view (load time left out)."""
    return marts.master(warehouse.contracts(spark, sf_dir), with_load_time=False)


# ------------------------------------------------------------------ marts
@register("mrt_01_master", on_master("select * from master"))
def q_mrt_01(spark, d):
    return master(spark, d)


@register("mrt_01_row_count", on_master(
    "select 'marts.contratacion' as tabla, count(*) as registros from master"))
def q_mrt_01_count(spark, d):
    return marts.row_count_check(master(spark, d))


@register("mrt_02_resumen_departamento", on_master(f"""
select coalesce(departamento, 'Sin info') as depto, count(*) as num_contratos,
  sum(valor_contrato) as valor_total, {avg2()} as valor_promedio,
  count(distinct nombre_entidad) as num_entidades
from master group by coalesce(departamento, 'Sin info')"""), headline=True)
def q_mrt_02(spark, d):
    return marts.resumen_departamento(master(spark, d))


@register("mrt_03_resumen_entidad", on_master("""
select nombre_entidad, coalesce(departamento, 'Sin info') as depto, count(*) as num_contratos,
  sum(valor_contrato) as valor_total
from master group by 1, 2 order by valor_total desc, nombre_entidad, depto limit 100"""))
def q_mrt_03(spark, d):
    return marts.resumen_entidad(master(spark, d))


@register("mrt_04_resumen_sector", on_master(f"""
select coalesce(sector, 'Sin info') as sector, count(*) as num_contratos, sum(valor_contrato) as valor_total,
  {avg2()} as valor_promedio
from master group by master.sector"""))
def q_mrt_04(spark, d):
    return marts.resumen_sector(master(spark, d))


@register("mrt_05_resumen_tipo_proceso", on_master("""
select coalesce(proceso_de_compra, 'Sin info') as proceso, count(*) as num_contratos,
  sum(valor_contrato) as valor_total
from master group by 1"""))
def q_mrt_05(spark, d):
    return marts.resumen_tipo_proceso(master(spark, d))


@register("mrt_06_resumen_catalogo", on_master(f"""
, cat as (select nombre_entidad as organization, proceso_de_compra as id, list_sort(list(distinct modalidad)) as tags,
  min(fecha_firma) as created_at, max(fecha_inicio) as last_modified_at from master group by 1, 2)
select organization, count(*) as num_datasets, count(distinct tags) as num_tags, min(created_at) as primer_dataset,
  max(last_modified_at) as ultimo_update,
  count(case when last_modified_at >= date '{AS_OF}' - interval 30 day then 1 end) as datasets_activos
from cat group by organization"""))
def q_mrt_06(spark, d):
    return marts.resumen_catalogo(marts.catalog_from_master(master(spark, d)), AS_OF)


# ------------------------------------------------------------------ marts kept from snapshots
def _snapshots(spark, d, path):
    """Three snapshots of the master; the second comes first with other rows
    and is applied again."""
    m = master(spark, d)
    part = F.pmod(F.crc32(F.coalesce("id_contrato", F.lit("")).cast("binary")), F.lit(3))
    for name, rows in (("s1", part == 0), ("s2", part != 1), ("s3", part == 2), ("s2", part == 1)):
        upkeep.apply_snapshot(m.where(rows), path, name)


def _kept(spark, d) -> str:
    return warehouse.land(spark, d, "mart_states", _snapshots)


for _key, _mart in (("mrt_02_resumen_departamento", upkeep.resumen_departamento), ("mrt_03_resumen_entidad", upkeep.resumen_entidad),
                    ("mrt_04_resumen_sector", upkeep.resumen_sector), ("mrt_05_resumen_tipo_proceso", upkeep.resumen_tipo_proceso),
                    ("mrt_06_resumen_catalogo", lambda spark, root: upkeep.resumen_catalogo(spark, root, AS_OF))):
    register(f"{_key}_por_snapshots", registry.ORACLE[_key])(lambda spark, d, mart=_mart: mart(spark, _kept(spark, d)))


# ------------------------------------------------------------------ E-02 ... E-06
@register("qry_01_distribucion_valores", on_master(f"""
select min(valor_contrato) as valor_minimo, max(valor_contrato) as valor_maximo, {avgd()} as valor_promedio,
  round(quantile_cont(cast(valor_contrato as double), 0.25), 4) as q25,
  round(quantile_cont(cast(valor_contrato as double), 0.5), 4) as mediana,
  round(quantile_cont(cast(valor_contrato as double), 0.75), 4) as q75,
  round(quantile_cont(cast(valor_contrato as double), 0.95), 4) as p95,
  {sig('stddev_samp(cast(valor_contrato as double))')} as desviacion_estandar
from master"""), headline=True)
def q_qry_01(spark, d):
    from ..operators.aggregates import sig as rounded
    # last digits depend on the order of summation and interpolation
    return I.value_distribution(master(spark, d)).withColumns(
        {c: F.round(c, 4) for c in ("q25", "mediana", "q75", "p95")} | {"desviacion_estandar": rounded("desviacion_estandar")})


@register("qry_02_por_tipo_contrato", on_master(f"""
, a as (select tipo_contrato, {BASIC} from master group by 1)
select tipo_contrato, num_contratos, valor_total, valor_promedio,
  {pct('num_contratos', 'sum(num_contratos) over ()')} as porcentaje from a"""))
def q_qry_02(spark, d):
    return I.by_contract_type(master(spark, d))


@register("qry_03_mensual", on_master("""
select cast(year(fecha_inicio) as int) as anno, cast(month(fecha_inicio) as int) as mes,
  count(*) as num_contratos, sum(valor_contrato) as valor_total
from master where fecha_inicio is not null group by 1, 2"""))
def q_qry_03(spark, d):
    return I.monthly(master(spark, d))


@register("qry_04_por_modalidad", on_master(f"select modalidad, {BASIC} from master group by 1"))
def q_qry_04(spark, d):
    return I.by_modality(master(spark, d))


@register("qry_05_departamento_anno", on_master(f"""
select coalesce(departamento, 'Sin información') as departamento, {BASIC},
  cast(year(fecha_inicio) as int) as anno
from master where year(fecha_inicio) in ({_YEARS_SQL})
group by master.departamento, year(fecha_inicio)"""))
def q_qry_05(spark, d):
    return I.department_year(master(spark, d), YEARS)


@register("qry_06_top_departamentos", on_master(f"""
select coalesce(departamento, 'Sin info') as departamento, {BASIC},
  count(distinct nombre_entidad) as num_entidades, count(distinct proveedor) as num_proveedores
from master group by 1 order by valor_total desc, departamento limit 10"""), headline=True)
def q_qry_06(spark, d):
    return I.top_departments(master(spark, d))


@register("qry_07_entidades_departamento", on_master(f"""
select nombre_entidad, {BASIC} from master where departamento = '{DEP}'
group by nombre_entidad order by valor_total desc, nombre_entidad limit 20"""))
def q_qry_07(spark, d):
    return I.entities_of_department(master(spark, d), DEP)


@register("qry_08_ranking_entidades", on_master(f"""
, agg as (select nombre_entidad, coalesce(departamento, 'Sin info') as departamento, {BASIC} from master group by 1, 2),
r as (select *, row_number() over (partition by departamento order by valor_total desc, nombre_entidad) as ranking
      from agg where departamento in ({_DEPS_SQL}))
select nombre_entidad, departamento, num_contratos, valor_total, valor_promedio, ranking
from r order by departamento, ranking limit 30"""))
def q_qry_08(spark, d):
    return I.entity_rank_in_department(master(spark, d), DEPS)


@register("qry_09_entidades_por_numero", on_master("""
select nombre_entidad, departamento, count(*) as num_contratos, sum(valor_contrato) as valor_total
from master group by 1, 2
order by num_contratos desc, valor_total desc, nombre_entidad, departamento nulls first limit 20"""))
def q_qry_09(spark, d):
    return I.entities_by_count(master(spark, d))


@register("qry_10_sectores_anno", on_master(f"""
select case when sector like '%Educaci%' then 'Educación'
  when sector like '%Salud%' or sector like '%Social%' then 'Salud'
  when sector like '%Transporte%' then 'Transporte'
  when sector like '%defensa%' or sector like '%seguridad%' then 'Defensa'
  else 'Otros' end as categoria, {BASIC}
from master where year(fecha_inicio) = {YEAR} group by 1"""))
def q_qry_10(spark, d):
    return I.sector_buckets_year(master(spark, d), YEAR)


@register("qry_11_porcentaje_sector", on_master(f"""
, t as (select sum(valor_contrato) as total_general from master)
select coalesce(sector, 'Sin información') as sector, count(*) as num_contratos, sum(valor_contrato) as valor_total,
  {pct('sum(valor_contrato)', 't.total_general')} as porcentaje
from master cross join t group by master.sector, t.total_general"""))
def q_qry_11(spark, d):
    return I.sector_share(master(spark, d))


@register("qry_12_top_tipos_proceso", on_master("""
, p as (select coalesce(proceso_de_compra, 'Sin info') as proceso, count(*) as num_contratos,
  sum(valor_contrato) as valor_total from master group by 1)
select proceso, num_contratos, valor_total, round(cast(valor_total as double) / num_contratos, 0) as valor_promedio_contrato
from p order by num_contratos desc, valor_total desc, proceso limit 15"""))
def q_qry_12(spark, d):
    return I.top_process_types(marts.resumen_tipo_proceso(master(spark, d)))


@register("qry_13_procesos_frecuentes", on_master(f"""
select proceso_de_compra, {BASIC} from master group by 1
order by num_contratos desc, valor_total desc, proceso_de_compra limit 10"""))
def q_qry_13(spark, d):
    return I.frequent_processes(master(spark, d))


@register("qry_14_entidad_ultimo_anno", on_master(f"""
select nombre_entidad, departamento, count(*) as num_contratos, sum(valor_contrato) as valor_total,
  max(fecha_inicio) as ultimo_contrato
from master where departamento = '{DEP}' and fecha_inicio >= date '{AS_OF}' - interval 1 year
group by 1, 2 order by valor_total desc, nombre_entidad limit 10"""))
def q_qry_14(spark, d):
    return I.top_entities_last_year(master(spark, d), DEP, AS_OF)


_EH = "(lower(sector) like '%educaci%' or lower(sector) like '%salud%' or lower(sector) like '%social%')"


@register("qry_15_educacion_vs_salud", on_master(f"""
select case when lower(sector) like '%educaci%' then 'Educación'
  when lower(sector) like '%salud%' or lower(sector) like '%social%' then 'Salud' else 'Otros' end as sector,
  count(*) as num_contratos, sum(valor_contrato) as valor_total, sum(valor_pagado) as valor_pagado,
  sum(valor_contrato) - sum(valor_pagado) as valor_pendiente
from master where year(fecha_inicio) = {YEAR} and {_EH} group by 1"""))
def q_qry_15(spark, d):
    return I.education_vs_health(master(spark, d), YEAR)


@register("qry_16_proveedores_region", on_master(f"""
select proveedor, {BASIC}, count(distinct nombre_entidad) as num_entidades_contratantes
from master where departamento = '{DEP}' and proveedor is not null and proveedor != ''
group by proveedor order by valor_total desc, proveedor limit 20"""))
def q_qry_16(spark, d):
    return I.suppliers_of_region(master(spark, d), DEP)


@register("qry_17_pares_repetidos", on_master(f"""
select nombre_entidad, proveedor, count(*) as num_contratos_similar, sum(valor_contrato) as valor_total,
  {avgd()} as valor_promedio
from master group by 1, 2 having count(*) > 5"""))
def q_qry_17(spark, d):
    return I.repeated_pairs(master(spark, d), None, 5)


@register("qry_18_atipicos_iqr", on_master("""
, p as (select quantile_cont(cast(valor_contrato as double), 0.25) as p25,
  quantile_cont(cast(valor_contrato as double), 0.75) as p75 from master),
i as (select p25, p75, (p75 - p25) * 1.5 as iqr_mult from p)
select id_contrato, nombre_entidad, proveedor, valor_contrato, fecha_inicio, departamento
from master, i
where cast(valor_contrato as double) < (p25 - iqr_mult) or cast(valor_contrato as double) > (p75 + iqr_mult)
order by valor_contrato desc, id_contrato, nombre_entidad, proveedor, fecha_inicio limit 50"""),
          headline=True)
def q_qry_18(spark, d):
    return I.iqr_outliers(master(spark, d))


@register("qry_19_sobre_promedio_sector", on_master(f"""
, r as (select coalesce(sector, 'Sin info') as sector, {avg2()} as valor_promedio from master group by master.sector)
select c.id_contrato, c.nombre_entidad, c.sector, c.valor_contrato, c.proveedor, r.valor_promedio as promedio_sector,
  round(cast(c.valor_contrato as double) / cast(r.valor_promedio as double), 6) as ratio_vs_promedio
from master c join r on c.sector = r.sector
where c.valor_contrato > r.valor_promedio * 10
order by ratio_vs_promedio desc, c.id_contrato, c.valor_contrato desc, c.proveedor limit 30"""))
def q_qry_19(spark, d):
    m = master(spark, d)
    return I.above_sector_average(m, marts.resumen_sector(m))


@register("qry_20_actividad_publicacion", on_master("""
select nombre_entidad, count(*) as num_contratos, count(distinct proceso_de_compra) as num_tipos_proceso,
  min(fecha_inicio) as primera_publicacion, max(fecha_inicio) as ultima_publicacion
from master group by 1 order by num_contratos desc, nombre_entidad limit 50"""))
def q_qry_20(spark, d):
    return I.publication_activity(master(spark, d))


@register("qry_21_catalogo_simulado", on_master("""
select nombre_entidad as organizacion, departamento as region, count(*) as num_datasets_simulado,
  count(distinct proceso_de_compra) as num_tipos_datos, sum(valor_contrato) as tamano_simulado
from master group by 1, 2"""))
def q_qry_21(spark, d):
    return I.simulated_catalog(master(spark, d))


@register("qry_22_cobertura_sector", on_master("""
select sector, count(*) as num_registros, count(distinct nombre_entidad) as num_entidades,
  sum(valor_contrato) as valor_total
from master group by sector"""))
def q_qry_22(spark, d):
    return I.sector_coverage(master(spark, d))


@register("qry_23_actualizacion", on_master(f"""
, a as (select nombre_entidad, departamento, count(*) as num_contratos, min(fecha_inicio) as desde,
  max(fecha_inicio) as hasta from master where fecha_inicio is not null group by 1, 2)
select nombre_entidad, departamento, num_contratos, desde, hasta, datediff('day', desde, hasta) as rango_dias,
  case when hasta >= date '{AS_OF}' - interval 30 day then 'Actualizado'
       when hasta >= date '{AS_OF}' - interval 90 day then 'Reciente'
       when hasta >= date '{AS_OF}' - interval 365 day then 'Anual'
       else 'Desactualizado' end as estado_actualizacion
from a order by num_contratos desc, nombre_entidad, departamento nulls first limit 20"""))
def q_qry_23(spark, d):
    return I.freshness(master(spark, d), AS_OF)


@register("qry_24_regiones_menos_activas", on_master("""
, a as (select departamento as dep, count(*) as num_contratos, count(distinct nombre_entidad) as num_entidades,
  sum(valor_contrato) as valor_total from master group by 1)
select coalesce(dep, 'Sin información') as region, num_contratos, num_entidades, valor_total,
  row_number() over (order by num_contratos, dep nulls first) as ranking_disponibilidad
from a order by num_contratos, dep nulls first limit 10"""))
def q_qry_24(spark, d):
    return I.least_active_regions(master(spark, d))


@register("qry_25_brecha_cobertura", on_master("""
select 'Posible brecha' as nota, departamento, count(*) as num_contratos,
  case when count(*) < 100 then 'Baja cobertura' when count(*) < 500 then 'Cobertura media'
       else 'Buena cobertura' end as clasificacion
from master group by departamento"""))
def q_qry_25(spark, d):
    return I.coverage_gaps(master(spark, d))


# ------------------------------------------------------------------ validations
@register("val_01_nulos_o_cero", on_master(
    "select 'valor_contrato nulos' as validacion, count(*) as conteo from master "
    "where valor_contrato is null or valor_contrato = 0"))
def q_val_01(spark, d):
    return V.null_or_zero_values(master(spark, d))


@register("val_02_ids_duplicados", on_master(
    "select 'id_contrato duplicados' as validacion, count(*) as conteo from "
    "(select id_contrato from master group by id_contrato having count(*) > 1) dup"))
def q_val_02(spark, d):
    return V.duplicate_ids(master(spark, d))


@register("val_03_rango_fechas", on_master(
    "select min(fecha_inicio) as fecha_min, max(fecha_inicio) as fecha_max from master"))
def q_val_03(spark, d):
    return V.date_range(master(spark, d))


@register("val_04_fuera_de_rango", on_master(
    "select count(*) as conteo from master where valor_contrato < 0 or valor_contrato > 1000000000000"))
def q_val_04(spark, d):
    return V.out_of_range(master(spark, d))


@register("val_05_estado_dataset", on_master(
    "select 'contratacion' as dataset, cast(max(fecha_inicio) as timestamp) as ultima_actualizacion, "
    "count(*) as num_registros from master"))
def q_val_05(spark, d):
    return V.dataset_stats(master(spark, d))


# ------------------------------------------------------------------ filters and ranking
@register("flt_05_filtros_parametricos", on_master(f"""
select * from master
where departamento in ({_DEPS_SQL}) and year(fecha_inicio) in ({_YEARS_SQL})
  and fecha_inicio >= date '{AS_OF}' - interval 5 year and proveedor is not null and proveedor != ''"""))
def q_flt_05(spark, d):
    return filters.contract_filter(master(spark, d), departments=DEPS, years=YEARS,
                                   since=("fecha_inicio", AS_OF, 60), not_blank="proveedor")


@register("flt_06_segmentadores", on_master(f"""
select * from master where departamento in ({_DEPS_SQL}) and origen in ('SECOP_I', 'SECOP_II')
  and modalidad in ('1-URGENT', '2-HIGH')"""))
def q_flt_06(spark, d):
    return filters.slicers(master(spark, d), {
        "departamento": list(DEPS), "origen": ["SECOP_I", "SECOP_II"],
        "modalidad": ["1-URGENT", "2-HIGH"], "tipo_contrato": []})


@register("rnk_01_topn_con_empates", on_master("""
, a as (select numero_proponentes, count(*) as num_contratos from master group by 1)
select numero_proponentes, num_contratos from a
where num_contratos >= (select min(num_contratos) from (select num_contratos from a order by num_contratos desc limit 3))
"""))
def q_rnk_01(spark, d):
    from ..operators.aggregates import settled, top_n_with_ties
    agg = master(spark, d).groupBy("numero_proponentes").agg(F.count(F.lit(1)).alias("num_contratos"))
    return top_n_with_ties(settled(agg), 3, "num_contratos")
