"""Registered education indicators (QRY-26 ... QRY-32)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import education as E
from . import warehouse
from .registry import register
from .sqlkit import on_views, pct


def _t(spark, d, name):
    return warehouse.layer(spark, d, name)


@register("qry_26_desercion", on_views(f"""
select departamento, anno, nivel, sum(matricula) as total_matriculados, sum(desertores) as total_desertores,
  case when sum(matricula) > 0 then {pct('sum(desertores)', 'sum(matricula)')} end as tasa_desercion
from edu_dropout group by 1, 2, 3""", "edu_dropout"), headline=True)
def q_qry_26(spark, d):
    return E.dropout_rate(_t(spark, d, "edu_dropout"))


LEVELS = ["preescolar", "primaria", "secundaria"]


@register("qry_27_matricula_nivel", on_views(" union all ".join(
    f"(select departamento, nivel_educativo, sum(cantidad) as total_matricula, "
    f"count(distinct institucion) as num_instituciones from edu_enrolment where nivel_educativo = '{lv}' "
    f"group by departamento, nivel_educativo)" for lv in LEVELS), "edu_enrolment"))
def q_qry_27(spark, d):
    return E.enrolment_by_level(_t(spark, d, "edu_enrolment"), LEVELS)


@register("qry_28_matricula_anno", on_views("""
select anno, nivel_educativo, sum(cantidad) as total_matricula from edu_enrolment group by 1, 2""", "edu_enrolment"))
def q_qry_28(spark, d):
    return E.enrolment_by_year(_t(spark, d, "edu_enrolment"))


@register("qry_29_empleo_nivel", on_views(f"""
, a as (select departamento, nivel_educativo, count(*) as muestra,
  cast(sum(case when ocupada = 1 then 1 end) as bigint) as ocupadas,
  cast(sum(case when desempleo = 1 then 1 end) as bigint) as desempleadas
  from edu_employment group by 1, 2)
select *, case when muestra > 0 then {pct('desempleadas', 'muestra')} end as tasa_desempleo from a""",
    "edu_employment"))
def q_qry_29(spark, d):
    return E.employment_by_level(_t(spark, d, "edu_employment"))


@register("qry_30_ingreso_nivel", on_views("""
select departamento, nivel_educativo,
  cast(sum(cast(ingreso as decimal(18,2))) as double) / count(ingreso) as ingreso_promedio,
  round(quantile_cont(ingreso, 0.5), 4) as ingreso_mediano, count(*) as muestra
from edu_employment where ingreso > 0 group by 1, 2""", "edu_employment"))
def q_qry_30(spark, d):
    return E.income_by_level(_t(spark, d, "edu_employment")).withColumn("ingreso_mediano", F.round("ingreso_mediano", 4))


@register("qry_31_establecimientos", on_views("""
select departamento, tipo_establecimiento, count(*) as num_establecimientos,
  count(distinct municipio) as num_municipios from edu_establishments group by 1, 2""", "edu_establishments"))
def q_qry_31(spark, d):
    return E.establishments(_t(spark, d, "edu_establishments"))


@register("qry_32_saber11", on_views("""
select departamento, anno, cast(sum(cast(puntaje_global as decimal(18,0))) as double) / count(puntaje_global) as promedio_puntaje,
  min(puntaje_global) as puntaje_min, max(puntaje_global) as puntaje_max, count(*) as num_estudiantes
from edu_exam group by 1, 2""", "edu_exam"))
def q_qry_32(spark, d):
    return E.exam_results(_t(spark, d, "edu_exam"))
