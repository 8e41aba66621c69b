"""Registered ingest and write round trips (SRC, SNK, streaming ingest).

Each query lands files derived from the driver tables under the session's
checkpoint folder (once per input folder and writer version), reads them
back with the operator under test, and is compared with SQL over the
original tables.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import marts
from ..operators.indexing import dense_index
from ..sources import landed, page_source, sinks
from ..sources.tables import read_table
from ..streaming import ingest
from . import jobs, sqlclean as S, warehouse
from .q_cleaning import consolidated
from .q_contracts import master
from .registry import ORACLE, register
from .sqlkit import on_master, on_views

PAGE = landed.CRAWLER_PAGE
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


# ------------------------------------------------------------------ landing writers
def land_event_pages(spark, d, path):
    """Events as crawler pages of 1,000 rows in ``event_id`` order, plus one
    stray copy of page 0 two pages past the end."""
    ev = read_table(spark, d, "events", *EVENT_COLS)
    idx = dense_index(ev, [F.col("event_id").asc(), *[F.col(c).asc_nulls_first() for c in EVENT_COLS[1:]]], "_i")
    paged = idx.withColumn("offset", (F.floor(F.col("_i") / PAGE) * PAGE).cast("long")).drop("_i")
    last = paged.agg(F.max("offset").alias("_last"))
    stray = (paged.filter(F.col("offset") == 0).crossJoin(F.broadcast(last))
             .withColumn("offset", (F.col("_last") + 2 * PAGE).cast("long")).drop("_last"))
    page_source.land_pages(paged.unionByName(stray), path, order=["event_id"], **landed.JSON_TIME_OPTIONS)


def event_schema(spark, d) -> StructType:
    return read_table(spark, d, "events", *EVENT_COLS).schema


def land_raw_contracts_csv(spark, d, path):
    raw = warehouse.layer(spark, d, "raw_contracts")
    (raw.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def land_json_arrays(spark, d, path):
    """Orders as one-line JSON arrays of at most ~5,000 records each."""
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    buckets = max(1, math.ceil(o.count() / 5000))
    (o.groupBy(F.pmod(F.xxhash64("o_orderkey"), F.lit(buckets)).alias("_b"))
     .agg(F.to_json(F.collect_list(F.struct(*o.columns))).alias("value"))
     .select("value").write.mode("overwrite").text(path))


def land_glob_tree(spark, d, path):
    o = read_table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    w = lambda df, p: df.write.mode("overwrite").option("header", True).csv(p)
    w(o.filter(F.col("o_orderkey") % 2 == 0), f"{path}/a")
    w(o.filter(F.col("o_orderkey") % 2 == 1), f"{path}/b/c")
    tiny = spark.createDataFrame([(-1, "F", "x")], "o_orderkey long, o_orderstatus string, o_orderpriority string")
    w(tiny.coalesce(1), f"{path}/b/tiny")
    o.limit(10).write.mode("overwrite").json(f"{path}/other")


SNAPSHOT_ORDER = [("20240101", 0), ("20250101", 1), ("20240301", 2)]


def land_snapshots(spark, d, path):
    o = read_table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    for ds in ["secop_i", "secop_ii"]:
        for date, k in SNAPSHOT_ORDER:
            (o.filter(F.col("o_orderkey") % 3 == k).write.mode("overwrite").option("header", True)
             .csv(f"{path}/{ds}_{date}"))


def land_manifest(spark, d, path):
    c = read_table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    c.write.mode("overwrite").option("header", True).csv(f"{path}/data/first")
    c.filter(F.col("c_custkey") % 2 == 0).write.mode("overwrite").option("header", True).csv(f"{path}/data/second")
    spark.createDataFrame(
        [([{"download_url": f"{path}/data/first"}, {"download_url": f"{path}/data/second"}],)],
        "datasets array<struct<download_url:string>>").write.mode("overwrite").json(f"{path}/manifest")


# ------------------------------------------------------------------ SRC-01 / SRC-02
_PAGES_SQL = f"""
with e as (select {', '.join(EVENT_COLS)}, ((row_number() over (order by event_id) - 1) // {PAGE}) * {PAGE} as page_offset
  from events)
select * from e"""


def paged_events(spark, d):
    root = warehouse.land(spark, d, "event_pages", land_event_pages)
    return (landed.read_pages(spark, root, event_schema(spark, d), PAGE)
            .withColumnRenamed("offset", "page_offset"))


@register("src_01_ingesta_paginada", _PAGES_SQL)
def q_src_01(spark, d):
    return paged_events(spark, d)


@register("stm_01_ingesta_incremental", _PAGES_SQL)
def q_stm_01(spark, d):
    root = warehouse.land(spark, d, "event_pages", land_event_pages)
    table = ingest.ingest_pages(spark, root, event_schema(spark, d), f"{root}-stream", landed.JSON_TIME_OPTIONS)
    stop, _ = page_source.pages_to_keep(page_source.read_manifest(spark, root), PAGE)
    return table.where((F.col("offset") <= stop) & (F.col("offset") % PAGE == 0)).withColumnRenamed("offset", "page_offset")


# ------------------------------------------------------------------ SRC-03 / SRC-07
def _na_sql(col: str) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in landed.PANDAS_NA_TOKENS)
    return f'case when "{col}" in ({toks}) then null else "{col}" end as "{col}"'


_RAW_COLS = ["ID Contrato", "Nombre Entidad", "Nit Entidad", "Departamento", "Valor del Contrato", "Fecha de Firma"]


@register("src_07_csv_pandas", on_views("select " + ", ".join(_na_sql(c) for c in _RAW_COLS) + " from raw_contracts",
                                        "raw_contracts"))
def q_src_07(spark, d):
    root = warehouse.land(spark, d, "raw_contracts_csv", land_raw_contracts_csv)
    return landed.read_csv_text(spark, root)


@register("src_03_csv_ausente", on_views("select " + ", ".join(_na_sql(c) for c in _RAW_COLS) + " from raw_contracts",
                                         "raw_contracts"))
def q_src_03(spark, d):
    """A drop file that is there, and a missing one that adds no row."""
    root = warehouse.land(spark, d, "raw_contracts_csv", land_raw_contracts_csv)
    schema = landed.read_csv_text(spark, root).schema
    there = landed.read_csv_or_empty(spark, root, schema)
    return there.unionByName(landed.read_csv_or_empty(spark, f"{root}-missing", schema))


# ------------------------------------------------------------------ SRC-06
@register("src_06_json_arreglo", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def q_src_06(spark, d):
    root = warehouse.land(spark, d, "orders_json_arrays", land_json_arrays)
    schema = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").schema
    return landed.read_json_dump(spark, root, schema)


# ------------------------------------------------------------------ SRC-08
@register("src_08_directorio_glob", "select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, o_orderpriority "
                                    "from orders union all select '-1', 'F', 'x'")
def q_src_08(spark, d):
    root = warehouse.land(spark, d, "glob_tree", land_glob_tree)
    return landed.scan_directory(spark, root, "*.csv", recursive=True).drop("source_file")


# ------------------------------------------------------------------ SRC-09
@register("src_09_snapshot_reciente", " union all ".join(
    f"select '{ds}' as dataset, cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, "
    f"cast(o_totalprice as varchar) as o_totalprice from orders where o_orderkey % 3 = 2"
    for ds in ["secop_i", "secop_ii"]))
def q_src_09(spark, d):
    root = warehouse.land(spark, d, "snapshots", land_snapshots)
    files = spark.read.option("header", True).option("recursiveFileLookup", True).csv(root)
    snaps = landed.latest_snapshots(files, ["secop_i", "secop_ii"])
    return snaps.select("dataset", "o_orderkey", "o_orderstatus", "o_totalprice")


# ------------------------------------------------------------------ SRC-04 / SRC-05
@register("src_04_manifiesto", "select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment from customer")
def q_src_04(spark, d):
    root = warehouse.land(spark, d, "manifest", land_manifest)
    return landed.read_from_manifest(spark, f"{root}/manifest")


@register("src_05_registro_extraccion", on_views(f"""
select 'eventos' as dataset, count(*) as rows from ({_PAGES_SQL}) p
union all select 'contratos_csv', count(*) from raw_contracts
union all select 'catalogo', count(*) from customer""", "raw_contracts"))
def q_src_05(spark, d):
    registry = [
        {"dataset": "eventos", "kind": "soda"},
        {"dataset": "contratos_csv", "kind": "csv"},
        {"dataset": "catalogo", "kind": "catalog"},
        {"dataset": "hoja_excel", "kind": "excel"},
    ]
    readers = {
        "soda": lambda s, e: paged_events(s, d),
        "csv": lambda s, e: landed.read_csv_text(s, warehouse.land(s, d, "raw_contracts_csv", land_raw_contracts_csv)),
        "catalog": lambda s, e: landed.read_from_manifest(s, f"{warehouse.land(s, d, 'manifest', land_manifest)}/manifest"),
    }
    return landed.extract_all(spark, registry, readers)


# ------------------------------------------------------------------ sinks
@register("snk_01_snapshot_diario", on_master("""
, r as (select coalesce(departamento, 'Sin info') as depto, count(*) as num_contratos from master group by 1)
select depto, num_contratos, '2024-01-01' as snapshot_date from r where num_contratos > 2400
union all select depto, num_contratos, '2024-01-02' from r"""))
def q_snk_01(spark, d):
    def write(s, dd, path):
        r = marts.resumen_departamento(master(s, dd)).select("depto", "num_contratos")
        sinks.write_snapshot(r, path, "2024-01-01")
        sinks.write_snapshot(r, path, "2024-01-02")
        sinks.write_snapshot(r.filter(F.col("num_contratos") > 2400), path, "2024-01-01")  # same-day rerun
    root = warehouse.land(spark, d, "dept_snapshots", write, fresh=True)
    return spark.read.parquet(root).select("depto", "num_contratos", F.col("snapshot_date").cast("string"))


@register("snk_02_limpio_y_exportado", "select nullif(id_contrato, '') as id_contrato, "
          "nullif(nombre_entidad, '') as nombre_entidad, nullif(nit_entidad, '') as nit_entidad, "
          "nullif(departamento, '') as departamento, valor_del_contrato, fecha_de_firma from ("
          + ORACLE["job_01_limpieza_contratos"] + ") j")
def q_snk_02(spark, d):
    def write(s, dd, path):
        sinks.write_clean_and_export(jobs.clean_contracts(warehouse.layer(s, dd, "raw_contracts")),
                                     f"{path}/clean", f"{path}/export")
    root = warehouse.land(spark, d, "clean_export", write, fresh=True)
    schema = spark.read.parquet(f"{root}/clean").schema
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(f"{root}/export")


def _publish_consolidated(s, dd, path):
    """Two dates; the second has fewer rows and is the latest."""
    whole = consolidated(s, dd)
    sinks.write_dated_and_latest(whole, path, "20240101")
    sinks.write_dated_and_latest(whole.where("origen != 'SECOP_I'"), path, "20240102")


@register("snk_04_consolidado_fechado", ORACLE["job_04_consolidacion"])
def q_snk_04(spark, d):
    """The dated copy, after a later one was published."""
    return sinks.read_consolidated(spark, warehouse.land(spark, d, "consolidated_copies", _publish_consolidated, fresh=True), "20240101")


@register("snk_04_consolidado_latest", "select * from (" + ORACLE["job_04_consolidacion"] + ") c where origen != 'SECOP_I'")
def q_snk_04_latest(spark, d):
    return sinks.read_consolidated(spark, warehouse.land(spark, d, "consolidated_copies", _publish_consolidated, fresh=True))


@register("snk_08_exportar_csv", ORACLE["mrt_02_resumen_departamento"])
def q_snk_08(spark, d):
    mart = marts.resumen_departamento(master(spark, d))

    def write(s, dd, path):
        sinks.export_csv(marts.resumen_departamento(master(s, dd)), path)
    root = warehouse.land(spark, d, "mart_csv", write, fresh=True)
    return spark.read.option("header", True).schema(mart.schema).csv(root)


# ------------------------------------------------------------------ SRC-02 (education pager)
def land_event_pages_5000(spark, d, path):
    ev = read_table(spark, d, "events", *EVENT_COLS)
    idx = dense_index(ev, [F.col("event_id").asc(), *[F.col(c).asc_nulls_first() for c in EVENT_COLS[1:]]], "_i")
    paged = idx.withColumn("offset", (F.floor(F.col("_i") / landed.EDUCATION_PAGE) * landed.EDUCATION_PAGE)
                           .cast("long")).drop("_i")
    page_source.land_pages(paged, path, order=["event_id"], **landed.JSON_TIME_OPTIONS)


@register("src_02_ingesta_paginada_educacion", f"""
with e as (select {', '.join(EVENT_COLS)},
  ((row_number() over (order by event_id) - 1) // {landed.EDUCATION_PAGE}) * {landed.EDUCATION_PAGE} as page_offset
  from events)
select * from e""")
def q_src_02(spark, d):
    root = warehouse.land(spark, d, "event_pages_5000", land_event_pages_5000)
    return (landed.read_pages(spark, root, event_schema(spark, d), landed.EDUCATION_PAGE)
            .withColumnRenamed("offset", "page_offset"))


# ------------------------------------------------------------------ SNK-03 / SNK-06 / SNK-07 / SRC-10 / SRC-11
def _db_location(spark, d):
    return warehouse.land(spark, d, "warehouse_dbs", lambda s, dd, p: None)


@register("snk_03_parquet", ORACLE["job_03_limpieza_variante_spark"])
def q_snk_03(spark, d):
    def write(s, dd, path):
        sinks.write_parquet(jobs.clean_contracts_spark_variant(warehouse.layer(s, dd, "raw_spider")), path)
    return spark.read.parquet(warehouse.land(spark, d, "spark_variant_parquet", write, fresh=True))


@register("snk_06_carga_tabla", ORACLE["src_07_csv_pandas"])
def q_snk_06(spark, d):
    sinks.init_schemas(spark, ["raw"], location=_db_location(spark, d))
    root = warehouse.land(spark, d, "raw_contracts_csv", land_raw_contracts_csv)
    name = sinks.load_as_table(landed.read_csv_text(spark, root), "contratos_crudos", "raw")
    return spark.table(name)


#: Given tables that the catalogue listing loads, one database each.
_CATALOGUED = {"raw": ["customer", "orders"], "staging": ["supplier"], "clean": ["part"]}


@register("snk_09_catalogo", " union all ".join(
    f"select '{db}' as esquema, c.table_name as tabla, c.column_name as columna, cast(c.ordinal_position as integer) as posicion, "
    f"(select count(*) from {t}) as registros from information_schema.columns c where c.table_name = '{t}'"
    for db, ts in _CATALOGUED.items() for t in ts))
def q_snk_09(spark, d):
    """Tables of the layers, their columns, and the rows of each."""
    sinks.init_schemas(spark, location=_db_location(spark, d))
    for db, names in _CATALOGUED.items():
        for name in names:
            sinks.load_as_table(read_table(spark, d, name), name, db)
    out = None
    for r in sinks.list_tables(spark, list(_CATALOGUED)).collect():  # catalogue entries
        if r["table_name"] in _CATALOGUED[r["table_schema"]]:
            name = f"{r['table_schema']}.{r['table_name']}"
            rows = spark.table(name).agg(F.count(F.lit(1)).alias("registros"))
            part = sinks.list_columns(spark, name).crossJoin(F.broadcast(rows)).select(
                F.lit(r["table_schema"]).alias("esquema"), F.lit(r["table_name"]).alias("tabla"),
                F.col("column_name").alias("columna"), F.col("ordinal_position").alias("posicion"), "registros")
            out = part if out is None else out.unionByName(part)
    return out


@register("src_10_tabla_con_limite", on_master("""
, r as (select coalesce(departamento, 'Sin info') as depto, count(*) as num_contratos,
  sum(valor_contrato) as valor_total from master group by 1)
select * from r order by depto, num_contratos, valor_total limit 5"""))
def q_src_10(spark, d):
    sinks.init_schemas(spark, ["marts"], location=_db_location(spark, d))
    r = marts.resumen_departamento(master(spark, d)).select("depto", "num_contratos", "valor_total")
    sinks.rebuild_table(r, "marts.resumen_departamento_limite")  # SNK-07
    return landed.read_table(spark, "resumen_departamento_limite", "marts", limit=5)


def land_catalog_csv(spark, d, path):
    m = master(spark, d)
    cat = (m.groupBy(F.col("nombre_entidad").alias("organizacion"))
           .agg(F.count(F.lit(1)).alias("cantidad_datasets"),
                F.max("fecha_inicio").cast("string").alias("ultima_actualizacion"),
                F.min("sector").alias("sector")))
    cat.write.mode("overwrite").option("header", True).csv(path)


@register("src_11_catalogo_manual", on_master("""
select nombre_entidad as organizacion, cast(count(*) as varchar) as cantidad_datasets,
  cast(max(fecha_inicio) as varchar) as ultima_actualizacion, min(sector) as sector
from master group by 1"""))
def q_src_11(spark, d):
    sinks.init_schemas(spark, ["raw"], location=_db_location(spark, d))
    root = warehouse.land(spark, d, "catalog_csv", land_catalog_csv)
    return landed.load_catalog_csv(spark, root, "raw.catalogo")


# ------------------------------------------------------------------ JOB-05
def land_raw_sources_csv(spark, d, path):
    from ..sources import fixtures
    for name, df in fixtures.raw_sources(spark, d).items():
        (df.write.mode("overwrite").option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/{name}"))


def land_raw_education_csv(spark, d, path):
    (warehouse.layer(spark, d, "raw_education").write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


_PIPELINE_SOURCES = {
    "secop_i": ["numero_de_contrato", "nombre_entidad", "nit_de_la_entidad", "departamento_entidad",
                "modalidad_de_contratacion", "tipo_de_contrato", "cuantia_proceso", "fecha_de_firma_del_contrato",
                "proponentes_seleccionados", "anno_firma_contrato"],
    "secop_ii": ["id_contrato", "nombre_entidad", "nit_entidad", "departamento", "modalidad_de_contratacion",
                 "tipo_de_contrato", "valor_del_contrato", "fecha_de_firma", "proveedor_adjudicado",
                 "proceso_de_compra", "sector"],
    "secop_integrado": ["numero_del_contrato", "nombre_de_la_entidad", "nit_de_la_entidad", "departamento_entidad",
                        "modalidad_de_contrataci_n", "tipo_de_contrato", "valor_contrato",
                        "fecha_de_firma_del_contrato", "nom_raz_social_contratista"],
}
_PIPELINE_EDUCATION = ["Departamento", "Código Institución", "Nombre Sede", "Matrícula Total", "Num Docentes", "Zona"]


def _clean_ctes() -> list[str]:
    """The cleaning rules over the landed contract text (missing-value tokens
    null): ``n_`` read, ``d_`` by rule, ``c_`` kept and distinct."""
    def rule(c: str) -> str:
        if "valor" in c:
            return S.clean_money(c)
        if "fecha" in c:
            return S.clean_date(c)
        e = S.clean_nit(c) if "nit" in c else c
        e = S.canonical_department(e) if "departamento" in c else e
        return S.normalize_text(e) if c in jobs.CONTRACT_TEXT_COLUMNS else e

    ctes = []
    for ds, cols in _PIPELINE_SOURCES.items():
        keep = {"secop_i": "true", "secop_ii": "coalesce(id_contrato, '') != '' and valor_del_contrato > 0",
                "secop_integrado": "valor_contrato > 0"}[ds]
        ctes.append(f"n_{ds} as (select {', '.join(_na_sql(c) for c in cols)} from {ds})")
        ctes.append(f"d_{ds} as (select {', '.join(f'{rule(c)} as {c}' for c in cols)} from n_{ds})")
        ctes.append(f"c_{ds} as (select distinct * from d_{ds} where {keep})")
    return ctes


def _pipeline_sql() -> str:
    """Row counts of every phase: the gate over the cleaned rows, the marts
    over the cleaned SECOP II rows."""
    ctes = _clean_ctes()
    text = {c: S.blank_text(f'"{c}"') for c in _PIPELINE_EDUCATION}
    text["Departamento"] = S.blank_text(S.education_department('"Departamento"'))
    text |= {"Num Docentes": S.to_number(text["Num Docentes"]), "Matrícula Total": S.to_number(text["Matrícula Total"])}
    some = " or ".join(f'"{c}" is not null' for c in _PIPELINE_EDUCATION)
    ctes.append(f"n_edu as (select {', '.join(_na_sql(c) for c in _PIPELINE_EDUCATION)} from raw_education)")
    ctes.append("d_edu as (select distinct " + ", ".join(f'{e} as "{c}"' for c, e in text.items()) + " from n_edu)")
    ctes.append(f"c_edu as (select * from d_edu where {some})")
    gate = ("{v} > 0 and coalesce({e}, '') != '' and coalesce({n}, '') != '' and coalesce({d}, '') != ''").format
    name, dept = S.normalize_text, lambda c: S.canonical_department(S.normalize_text(c), "")
    g = {"secop_i": ("SECOP_I", gate(v=S.clean_money("cuantia_proceso"), e=name("nombre_entidad"), n=S.clean_nit("nit_de_la_entidad"), d=dept("departamento_entidad"))),
         "secop_ii": ("SECOP_II", gate(v="valor_del_contrato", e=name("nombre_entidad"), n=S.clean_nit("nit_entidad"), d=dept("departamento"))),
         "secop_integrado": ("SECOP_INTEGRADO", gate(v="valor_contrato", e=name("nombre_de_la_entidad"), n=S.clean_nit("nit_de_la_entidad"), d=dept("departamento_entidad")))}
    ctes.append("m as (select nullif(departamento, '') as departamento, nullif(nombre_entidad, '') as nombre_entidad, "
                "nullif(sector, '') as sector, nullif(proceso_de_compra, '') as proceso from c_secop_ii)")
    rows = []
    for ds in _PIPELINE_SOURCES:
        origin, passes = g[ds]
        rows += [("extract", ds, f"from {ds}"), ("transform", ds, f"from c_{ds}"), ("load", f"clean.{ds}", f"from c_{ds}"),
                 ("consolidate", origin, f"from c_{ds} where {passes}")]
    e = "men_matricula_secundaria"
    rows += [("extract", e, "from raw_education"), ("transform", e, "from c_edu"), ("load", f"clean.{e}", "from c_edu"),
             ("marts", "marts.contratacion", "from m"),
             ("marts", "marts.resumen_departamento", "from (select distinct coalesce(departamento, 'Sin info') from m)"),
             ("marts", "marts.resumen_entidad", "from (select distinct nombre_entidad, coalesce(departamento, 'Sin info') from m limit 100)"),
             ("marts", "marts.resumen_sector", "from (select distinct sector from m)"),
             ("marts", "marts.resumen_tipo_proceso", "from (select distinct coalesce(proceso, 'Sin info') from m)")]
    head = on_views("select 1", *_PIPELINE_SOURCES, "raw_education")
    return (head[: head.rindex("\nselect 1")] + ",\n" + ",\n".join(ctes) + "\n" + "\nunion all ".join(
        f"select '{p}' as phase, '{i}' as item, cast(count(*) as bigint) as rows {f}" for p, i, f in rows))


def _mart_sql() -> str:
    """The master mart from the cleaned SECOP II text, by value."""
    head = on_views("select 1", *_PIPELINE_SOURCES, "raw_education")
    names = marts.SECOP_II_TO_MASTER
    cols = []
    for c in _PIPELINE_SOURCES["secop_ii"]:
        dst = names.get(c, c)
        if dst == "valor_contrato":
            cols.append(f"cast({c} as decimal(20,2)) as {dst}")
        elif dst == "fecha_firma":
            cols.append(f"cast({c} as date) as {dst}")
        else:
            cols.append(_na_sql(c).replace(f'as "{c}"', f"as {dst}"))
    return head[: head.rindex("\nselect 1")] + ",\n" + ",\n".join(_clean_ctes()) + f"\nselect {', '.join(cols)} from c_secop_ii"


@register("prj_07_mart_desde_texto", _mart_sql())
def q_prj_07(spark, d):
    """Landed SECOP II text, cleaned and as the load leaves it (dates are
    text, blanks null), to the documented master columns and types."""
    from . import pipeline
    src = warehouse.land(spark, d, "raw_sources_csv", land_raw_sources_csv)
    clean = jobs.clean_contracts(landed.read_csv_text(spark, f"{src}/secop_ii"))
    return marts.master(pipeline.as_loaded(clean), with_load_time=False)


@register("job_05_pipeline_completo", _pipeline_sql())
def q_job_05(spark, d):
    from . import pipeline
    src = warehouse.land(spark, d, "raw_sources_csv", land_raw_sources_csv)
    landing = {ds: f"{src}/{ds}" for ds in _PIPELINE_SOURCES}
    education = {"men_matricula_secundaria": warehouse.land(spark, d, "raw_education_csv", land_raw_education_csv)}

    def run_all(s, dd, path):
        pipeline.run(s, "all", landing, path, education=education).write.mode("overwrite").parquet(f"{path}/_report")
    root = warehouse.land(spark, d, "pipeline_run", run_all, fresh=True)
    return spark.read.parquet(f"{root}/_report")
