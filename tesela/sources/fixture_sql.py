"""SQL text of the fixture views, for the DuckDB oracle.

Written independently of the DataFrame builders in ``fixtures``; the
driver's comparison checks that both give the same rows.
"""

from __future__ import annotations

CONTRACTS = """
select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as id_contrato,
  concat('REF-', cast(o_orderkey as varchar)) as referencia,
  concat(case c_custkey % 4 when 0 then 'Hospital ' when 1 then 'Universidad ' else 'Alcaldia ' end, c_name) as nombre_entidad,
  800000000 + c_custkey as nit_entidad,
  nullif(n_name, 'NATION_24') as departamento,
  concat(n_name, '-', cast(c_custkey % 7 as varchar)) as ciudad,
  p_brand as proceso_de_compra, p_type as tipo_contrato, o_orderpriority as modalidad, o_orderstatus as estado_contrato,
  cast(o_orderdate as date) as fecha_firma, cast(l_shipdate as date) as fecha_inicio,
  cast(cast(l_extendedprice as decimal(12,2)) * (case when l_linenumber <= 2 then 100 when l_orderkey % 400 = 0 then 100000 else 10000 end) as decimal(20,2)) as valor_contrato,
  cast(cast(cast(l_extendedprice as decimal(12,2)) * (case when l_linenumber <= 2 then 100 when l_orderkey % 400 = 0 then 100000 else 10000 end) as decimal(20,2)) * cast(1 - l_discount as decimal(4,2)) as decimal(20,2)) as valor_pagado,
  case when s_suppkey % 25 = 0 then 'No Definido' else s_name end as proveedor,
  case c_mktsegment when 'BUILDING' then 'Educación Nacional' when 'HOUSEHOLD' then 'Salud y Protección Social'
    when 'AUTOMOBILE' then 'Transporte' when 'FURNITURE' then 'defensa' else null end as sector,
  case p_size % 3 when 0 then 'Apoyo a la educacion' when 1 then 'Servicios de Salud' else p_name end as objeto_contrato,
  l_linenumber as numero_proponentes,
  case l_returnflag when 'A' then 'SECOP_I' when 'N' then 'SECOP_II' else 'SECOP_INTEGRADO' end as origen
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join supplier on l_suppkey = s_suppkey
join part on l_partkey = p_partkey
"""

RAW_CONTRACTS = """
select case when o_orderkey % 50 = 0 then null else concat('CO1.', cast(o_orderkey as varchar)) end as "ID Contrato",
  concat('  ', lower(c_name), case when o_orderkey % 3 = 0 then ' s.a.s ' else '  d.c.' end) as "Nombre Entidad",
  case when o_orderkey % 40 = 0 then 'n/a' else concat('NIT ', cast(800000000 + c_custkey as varchar), '-', cast(c_custkey % 10 as varchar)) end as "Nit Entidad",
  case o_custkey % 6 when 0 then 'BOGOTA' when 1 then ' valle del cauca ' when 2 then 'Bogota D.C.' when 3 then null when 4 then 'ATLANTICO' else 'san andres' end as "Departamento",
  case when o_orderkey % 30 = 0 then 'sin valor' else concat('$ ', cast(cast(floor(o_totalprice) as bigint) as varchar)) end as "Valor del Contrato",
  case o_orderkey % 4
    when 0 then concat(cast(year(o_orderdate) as varchar), '-', lpad(cast(month(o_orderdate) as varchar), 2, '0'), '-', lpad(cast(day(o_orderdate) as varchar), 2, '0'), ' 10:30:00')
    when 1 then concat(lpad(cast(day(o_orderdate) as varchar), 2, '0'), '/', lpad(cast(month(o_orderdate) as varchar), 2, '0'), '/', cast(year(o_orderdate) as varchar))
    when 2 then concat(cast(year(o_orderdate) as varchar), '/', cast(month(o_orderdate) as varchar), '/', cast(day(o_orderdate) as varchar))
    else concat(cast(year(o_orderdate) as varchar), '-', lpad(cast(month(o_orderdate) as varchar), 2, '0'), '-', lpad(cast(day(o_orderdate) as varchar), 2, '0'), 'T00:00:00.000') end as "Fecha de Firma"
from orders join customer on o_custkey = c_custkey
join (select 1 as k union all select 2 as k) d on d.k = 1 or o_orderkey % 20 = 0
"""

_ORDER_PEOPLE = """
select o.*, c_custkey, c_name, c_nationkey, n_name,
  case when o_orderkey % 41 = 0 then null else concat('NIT ', cast(800000000 + c_custkey as varchar), '-', cast(c_custkey % 10 as varchar)) end as x_nit,
  case when o_orderkey % 37 = 0 then 'nan' when o_orderkey % 43 = 0 then ' ' else concat(' ', lower(c_name), '  alcaldia') end as x_entity,
  case c_nationkey % 5 when 0 then 'bogota' when 1 then lower(n_name) when 2 then ' ATLANTICO ' when 3 then null else n_name end as x_dept,
  case when o_orderkey % 29 = 0 then '0' when o_orderkey % 31 = 0 then 'sin dato' else concat('$ ', cast(cast(floor(o_totalprice) as bigint) as varchar)) end as x_money,
  strftime(o_orderdate, '%Y-%m-%d') as x_fecha,
  case when o_custkey % 11 = 0 then null else concat('proveedor ', cast(o_custkey % 13 as varchar)) end as x_supplier
from orders o join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""

SECOP_I = f"""
select case when o_orderkey % 9 = 0 then null else concat('C1-', cast(o_orderkey as varchar)) end as numero_de_contrato,
  x_entity as nombre_entidad, x_nit as nit_de_la_entidad, x_dept as departamento_entidad,
  o_orderpriority as modalidad_de_contratacion, lower(o_orderstatus) as tipo_de_contrato, x_money as cuantia_proceso,
  x_fecha as fecha_de_firma_del_contrato, x_supplier as proponentes_seleccionados,
  cast(year(o_orderdate) as varchar) as anno_firma_contrato
from ({_ORDER_PEOPLE}) b where o_orderkey % 3 = 0
"""

SECOP_II = f"""
select concat('CO1.PCCNTR.', cast(o_orderkey as varchar)) as id_contrato,
  x_entity as nombre_entidad, x_nit as nit_entidad, x_dept as departamento,
  o_orderpriority as modalidad_de_contratacion, lower(o_orderstatus) as tipo_de_contrato, x_money as valor_del_contrato,
  x_fecha as fecha_de_firma, x_supplier as proveedor_adjudicado,
  concat('P-', cast(o_orderkey % 97 as varchar)) as proceso_de_compra, 'Educación Nacional' as sector
from ({_ORDER_PEOPLE}) b where o_orderkey % 3 = 1
"""

SECOP_INTEGRADO = f"""
select concat('INT-', cast(o_orderkey as varchar)) as numero_del_contrato,
  x_entity as nombre_de_la_entidad, x_nit as nit_de_la_entidad, x_dept as departamento_entidad,
  o_orderpriority as modalidad_de_contrataci_n, lower(o_orderstatus) as tipo_de_contrato, x_money as valor_contrato,
  x_fecha as fecha_de_firma_del_contrato, x_supplier as nom_raz_social_contratista
from ({_ORDER_PEOPLE}) b where o_orderkey % 3 = 2
"""

_LOP = """
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
"""

EDU_DROPOUT = f"""
select n_name as departamento, cast(year(o_orderdate) as int) as anno, c_mktsegment as nivel,
  case when c_mktsegment = 'MACHINERY' then 0 else cast(l_quantity as int) end as matricula,
  case when l_returnflag = 'R' then cast(l_quantity as int) else 0 end as desertores
{_LOP}
"""

EDU_ENROLMENT = f"""
select n_name as departamento, cast(year(o_orderdate) as int) as anno,
  case o_orderpriority when '1-URGENT' then 'preescolar' when '2-HIGH' then 'primaria' else 'secundaria' end as nivel_educativo,
  c_name as institucion, cast(l_quantity as int) as cantidad
{_LOP}
"""

EDU_EMPLOYMENT = """
select n_name as departamento, c_mktsegment as nivel_educativo,
  case when c_custkey % 10 = 0 then 0 else 1 end as ocupada, case when c_custkey % 10 = 0 then 1 else 0 end as desempleo, c_acctbal as ingreso
from customer join nation on c_nationkey = n_nationkey
"""

EDU_ESTABLISHMENTS = """
select n_name as departamento, concat(n_name, '-', cast(c_custkey % 7 as varchar)) as municipio, c_mktsegment as tipo_establecimiento
from customer join nation on c_nationkey = n_nationkey
"""

EDU_EXAM = f"""
select n_name as departamento, cast(year(o_orderdate) as int) as anno, cast(l_quantity * 10 as int) as puntaje_global
{_LOP}
"""

VIEWS = {
    "contracts": CONTRACTS,
    "raw_contracts": RAW_CONTRACTS,
    "secop_i": SECOP_I,
    "secop_ii": SECOP_II,
    "secop_integrado": SECOP_INTEGRADO,
    "edu_dropout": EDU_DROPOUT,
    "edu_enrolment": EDU_ENROLMENT,
    "edu_employment": EDU_EMPLOYMENT,
    "edu_establishments": EDU_ESTABLISHMENTS,
    "edu_exam": EDU_EXAM,
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named fixture views as CTEs."""
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in names)
    return f"with {ctes}\n{sql}"

RAW_EDUCATION = """
with x as (
select case when c_custkey % 7 = 0 then 'ATLANTICO' when c_custkey % 7 = 1 then ' san andrés '
    when c_custkey % 7 = 2 then 'Cordoba' when c_custkey % 7 = 3 then 'VICHADA' when c_custkey % 7 = 4 then null
    else n_name end as "Departamento",
  cast(c_custkey as varchar) as "Código Institución",
  case when c_custkey % 11 = 0 then 'nan' when c_custkey % 13 = 0 then 'None' else concat('  ', c_name, ' ') end as "Nombre Sede",
  case when c_custkey % 17 = 0 then 'sin dato' else concat(' ', cast(cast(floor(c_acctbal) as bigint) as varchar)) end as "Matrícula Total",
  cast(c_custkey % 40 as varchar) as "Num Docentes",
  case when c_mktsegment in ('BUILDING', 'HOUSEHOLD') then 'URBANA' else 'RURAL' end as "Zona",
  c_custkey as k
from customer join nation on c_nationkey = n_nationkey)
select * exclude (k) from x union all select * exclude (k) from x where k % 9 = 0
"""

RAW_SPIDER = """
with x as (
select case when o_orderkey % 13 = 0 then '' when o_orderkey % 19 = 0 then concat('-', cast(cast(floor(o_totalprice) as bigint) as varchar))
    else concat('$ ', cast(cast(o_totalprice as decimal(12,2)) as varchar)) end as "Valor Contrato",
  case when o_orderkey % 7 = 0 then strftime(o_orderdate, '%d/%m/%Y') else strftime(o_orderdate, '%Y-%m-%d') end as "Fecha-Inicio",
  strftime(o_orderdate, '%Y-%m-%d') as "Fecha Firma",
  concat('  ', upper(c_name), ' ') as "Nombre Entidad",
  concat('Depto ', cast(c_nationkey as varchar)) as "Departamento",
  o_orderpriority as "Objeto Contrato",
  concat(' Prov ', cast(o_custkey % 13 as varchar)) as "Proveedor",
  cast(year(o_orderdate) as varchar) as "Año",
  o_orderkey as k
from orders join customer on o_custkey = c_custkey)
select * exclude (k) from x union all select * exclude (k) from x where k % 10 = 0
"""

VIEWS.update({"raw_education": RAW_EDUCATION, "raw_spider": RAW_SPIDER})
