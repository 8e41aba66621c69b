"""Registered cleaning and consolidation jobs (JOB-01 ... JOB-04, FLT-03)."""

from __future__ import annotations

from ..operators import filters, measures
from ..sources import fixtures
from . import jobs, sqlclean as S, warehouse
from .registry import register
from .sqlkit import on_views


def _raw(spark, d, name):
    return warehouse.layer(spark, d, name)


# ------------------------------------------------------------------ JOB-01
_JOB01 = f"""
, n as (select "ID Contrato" as id_contrato, "Nombre Entidad" as nombre_entidad, "Nit Entidad" as nit_entidad,
  "Departamento" as departamento, "Valor del Contrato" as valor_del_contrato, "Fecha de Firma" as fecha_de_firma
  from raw_contracts),
c as (select id_contrato, {S.normalize_text('nombre_entidad')} as nombre_entidad,
  {S.clean_nit('nit_entidad')} as nit_entidad,
  {S.normalize_text(S.canonical_department('departamento'))} as departamento,
  {S.clean_money('valor_del_contrato')} as valor_del_contrato,
  {S.clean_date('fecha_de_firma')} as fecha_de_firma
  from n)
select distinct * from c where id_contrato is not null and id_contrato != '' and valor_del_contrato > 0"""


def _cte(view_sql: str, tail: str) -> str:
    head = view_sql[: view_sql.rindex("\nselect 1")]
    return f"{head}\n{tail}"


@register("job_01_limpieza_contratos", _cte(on_views("select 1", "raw_contracts"), _JOB01), headline=True)
def q_job_01(spark, d):
    return jobs.clean_contracts(_raw(spark, d, "raw_contracts"))


# ------------------------------------------------------------------ JOB-02
def _job02_sql() -> str:
    cols = {
        "departamento": S.blank_text(S.education_department('"Departamento"')),
        "cdigo_institucin": S.blank_text('"Código Institución"'),
        "nombre_sede": S.blank_text('"Nombre Sede"'),
        "matrcula_total": S.to_number(S.blank_text('"Matrícula Total"')),
        "num_docentes": S.to_number(S.blank_text('"Num Docentes"')),
        "zona": S.blank_text('"Zona"'),
    }
    sel = ",\n  ".join(f"{e} as {n}" for n, e in cols.items())
    all_null = " and ".join(f"{n} is null" for n in cols)
    return _cte(on_views("select 1", "raw_education"),
                f", c as (select distinct {sel} from raw_education)\nselect * from c where not ({all_null})")


@register("job_02_limpieza_educacion", _job02_sql())
def q_job_02(spark, d):
    return jobs.clean_education(_raw(spark, d, "raw_education"))


# ------------------------------------------------------------------ JOB-03
_JOB03 = """
select distinct try_cast(regexp_replace("Valor Contrato", '[^0-9.]', '', 'g') as double) as valor_contrato,
  cast(try_strptime("Fecha-Inicio", '%Y-%m-%d') as date) as fecha_inicio,
  cast(try_strptime("Fecha Firma", '%Y-%m-%d') as date) as fecha_firma,
  trim(lower("Nombre Entidad")) as nombre_entidad, trim(lower("Departamento")) as departamento,
  trim(lower("Objeto Contrato")) as objeto_contrato, trim(lower("Proveedor")) as proveedor, "Año" as "año"
from raw_spider"""


@register("job_03_limpieza_variante_spark", on_views(_JOB03, "raw_spider"))
def q_job_03(spark, d):
    return jobs.clean_contracts_spark_variant(_raw(spark, d, "raw_spider"))


# ------------------------------------------------------------------ JOB-04
def _consolidated_cte() -> str:
    s1 = ("select concat(coalesce(numero_de_contrato, 'nan'), '_', coalesce(nit_de_la_entidad, 'nan')) as uid, "
          "nombre_entidad, nit_de_la_entidad as nit_entidad, departamento_entidad as departamento, "
          "modalidad_de_contratacion as modalidad, tipo_de_contrato as tipo_contrato, cuantia_proceso as valor_contrato, "
          "fecha_de_firma_del_contrato as fecha_firma, proponentes_seleccionados as proveedor, 'SECOP_I' as origen "
          "from secop_i")
    s2 = ("select id_contrato as uid, nombre_entidad, nit_entidad, departamento, modalidad_de_contratacion as modalidad, "
          "tipo_de_contrato as tipo_contrato, valor_del_contrato as valor_contrato, fecha_de_firma as fecha_firma, "
          "proveedor_adjudicado as proveedor, 'SECOP_II' as origen from secop_ii")
    s3 = ("select numero_del_contrato as uid, nombre_de_la_entidad as nombre_entidad, nit_de_la_entidad as nit_entidad, "
          "departamento_entidad as departamento, modalidad_de_contrataci_n as modalidad, tipo_de_contrato as tipo_contrato, "
          "valor_contrato, fecha_de_firma_del_contrato as fecha_firma, nom_raz_social_contratista as proveedor, "
          "'SECOP_INTEGRADO' as origen from secop_integrado")
    c = (f"select uid, {S.not_defined(S.normalize_text('nombre_entidad'))} as nombre_entidad, "
         f"{S.not_defined(S.clean_nit('nit_entidad', ''))} as nit_entidad, "
         f"{S.not_defined(S.canonical_department(S.normalize_text('departamento'), ''))} as departamento, "
         f"{S.not_defined(S.normalize_text('modalidad'))} as modalidad, "
         f"{S.not_defined(S.normalize_text('tipo_contrato'))} as tipo_contrato, "
         f"{S.clean_money('valor_contrato')} as valor_contrato, "
         f"{S.not_defined('fecha_firma')} as fecha_firma, "
         f"{S.not_defined(S.normalize_text('proveedor'))} as proveedor, origen from u")
    head = on_views("select 1", "secop_i", "secop_ii", "secop_integrado")
    head = head[: head.rindex("\nselect 1")]
    return f"{head},\nu as ({s1} union all {s2} union all {s3}),\nc as ({c})"


_GATE = ("valor_contrato > 0 and nombre_entidad != 'No Definido' and nit_entidad != 'No Definido' "
         "and departamento != 'No Definido'")


def build_consolidated_pre_gate(spark, d):
    return jobs.consolidate_sources(fixtures.raw_sources(spark, d))


def consolidated_pre_gate(spark, d):
    """The aligned, cleaned union before the gate, written once: the gate,
    its counts and the origin breakdown all read it (the reference writes
    its consolidated file too), and the cleaning expressions are evaluated
    once instead of again inside every pushed-down gate predicate."""
    return warehouse.materialize(spark, d, "consolidated_pre_gate", build_consolidated_pre_gate)


def consolidated(spark, d):
    return filters.quality_gate(consolidated_pre_gate(spark, d))


@register("job_04_consolidacion", f"{_consolidated_cte()}\nselect * from c where {_GATE}", headline=True)
def q_job_04(spark, d):
    return consolidated(spark, d)


_GATE_COUNTS = """
, f as (select coalesce(valor_contrato > 0, false) as p1, coalesce(nombre_entidad != 'No Definido', false) as p2,
  coalesce(nit_entidad != 'No Definido', false) as p3, coalesce(departamento != 'No Definido', false) as p4 from c)
select 1 as paso, 'valor_no_positivo' as regla, cast(sum(case when not p1 then 1 else 0 end) as bigint) as descartados from f
union all select 2, 'nombre_entidad_no_definido', cast(sum(case when p1 and not p2 then 1 else 0 end) as bigint) from f
union all select 3, 'nit_no_definido', cast(sum(case when p1 and p2 and not p3 then 1 else 0 end) as bigint) from f
union all select 4, 'departamento_no_definido', cast(sum(case when p1 and p2 and p3 and not p4 then 1 else 0 end) as bigint) from f
"""


@register("flt_03_conteos_filtro_calidad", f"{_consolidated_cte()}{_GATE_COUNTS}")
def q_flt_03(spark, d):
    return filters.gate_counts(consolidated_pre_gate(spark, d))


@register("qry_47_por_origen_consolidado",
          f"{_consolidated_cte()}\nselect origen, count(*) as count from c where {_GATE} group by 1")
def q_qry_47c(spark, d):
    return measures.origin_breakdown(consolidated(spark, d))
