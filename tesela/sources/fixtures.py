"""Contract- and education-shaped inputs derived from the driver tables.

The source system reads procurement and education extracts that are not
available here. These builders derive tables of the same shape from the
TPC-H-like driver tables, so every query's work grows with those tables.
The oracle SQL for each builder lives in ``fixture_sql``; the two are
written independently (DataFrame API here, SQL text there).

Join plan of ``contracts`` at scale: ``nation`` (25 rows by definition) is
broadcast. The fact grows wider with each join, so the joins that shuffle
it come while it is narrow: ``part`` first, then ``orders`` with their
``customer``; ``supplier`` (key and name) is counted and broadcast at the
end, or joined before the others if it is too large for that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


#: Suppliers (key and name) that are broadcast, some tens of MB.
BROADCAST_SUPPLIERS = 500_000


def _dec_price(c: str):
    return F.col(c).cast("decimal(12,2)")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master-mart-shaped contracts: one row per lineitem."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                        "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = F.broadcast(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    supp = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    objeto = (F.when(F.col("p_size") % 3 == 0, "Apoyo a la educacion")
              .when(F.col("p_size") % 3 == 1, "Servicios de Salud")
              .otherwise(F.col("p_name")))
    part = (read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
            .select("p_partkey", "p_brand", "p_type", objeto.alias("objeto_contrato")))

    cn = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    oc = orders.join(cn, orders.o_custkey == cn.c_custkey)
    few = supp.count() <= BROADCAST_SUPPLIERS
    by_supplier = F.col("l_suppkey") == F.col("s_suppkey")
    x = li if few else li.join(supp, by_supplier)
    x = (x.join(part, F.col("l_partkey") == F.col("p_partkey"))
         .join(oc, F.col("l_orderkey") == F.col("o_orderkey")))
    if few:
        x = x.join(F.broadcast(supp), by_supplier)

    scale = (F.when(F.col("l_linenumber") <= 2, F.lit(100))
             .when(F.col("l_orderkey") % 400 == 0, F.lit(100000))
             .otherwise(F.lit(10000)))
    valor = (_dec_price("l_extendedprice") * scale).cast("decimal(20,2)")
    pagado = (valor * (F.lit(1) - F.col("l_discount")).cast("decimal(4,2)")).cast("decimal(20,2)")
    entity_kind = (F.when(F.col("c_custkey") % 4 == 0, "Hospital ")
                   .when(F.col("c_custkey") % 4 == 1, "Universidad ")
                   .otherwise("Alcaldia "))
    sector = (F.when(F.col("c_mktsegment") == "BUILDING", "Educación Nacional")
              .when(F.col("c_mktsegment") == "HOUSEHOLD", "Salud y Protección Social")
              .when(F.col("c_mktsegment") == "AUTOMOBILE", "Transporte")
              .when(F.col("c_mktsegment") == "FURNITURE", "defensa"))
    origen = (F.when(F.col("l_returnflag") == "A", "SECOP_I")
              .when(F.col("l_returnflag") == "N", "SECOP_II")
              .otherwise("SECOP_INTEGRADO"))
    return x.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("id_contrato"),
        F.concat(F.lit("REF-"), F.col("o_orderkey").cast("string")).alias("referencia"),
        F.concat(entity_kind, F.col("c_name")).alias("nombre_entidad"),
        (F.lit(800000000) + F.col("c_custkey")).cast("bigint").alias("nit_entidad"),
        F.nullif(F.col("n_name"), F.lit("NATION_24")).alias("departamento"),
        F.concat(F.col("n_name"), F.lit("-"), (F.col("c_custkey") % 7).cast("string")).alias("ciudad"),
        F.col("p_brand").alias("proceso_de_compra"),
        F.col("p_type").alias("tipo_contrato"),
        F.col("o_orderpriority").alias("modalidad"),
        F.col("o_orderstatus").alias("estado_contrato"),
        F.col("o_orderdate").cast("date").alias("fecha_firma"),
        F.col("l_shipdate").cast("date").alias("fecha_inicio"),
        valor.alias("valor_contrato"),
        pagado.alias("valor_pagado"),
        F.when(F.col("l_suppkey") % 25 == 0, "No Definido").otherwise(F.col("s_name")).alias("proveedor"),
        sector.alias("sector"),
        F.col("objeto_contrato"),
        F.col("l_linenumber").alias("numero_proponentes"),
        origen.alias("origen"),
    )


def _ymd(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd")


def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty landed contracts (source column names, all text); every 20th
    order appears twice."""
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    base = orders.join(cust, orders.o_custkey == cust.c_custkey)
    k = F.col("o_orderkey")
    y = F.year("o_orderdate").cast("string")
    m = F.month("o_orderdate").cast("string")
    d = F.dayofmonth("o_orderdate").cast("string")
    date_text = (F.when(k % 4 == 0, F.concat(_ymd("o_orderdate"), F.lit(" 10:30:00")))
                 .when(k % 4 == 1, F.concat(F.lpad(d, 2, "0"), F.lit("/"), F.lpad(m, 2, "0"), F.lit("/"), y))
                 .when(k % 4 == 2, F.concat(y, F.lit("/"), m, F.lit("/"), d))
                 .otherwise(F.concat(_ymd("o_orderdate"), F.lit("T00:00:00.000"))))
    dept = (F.when(F.col("o_custkey") % 6 == 0, "BOGOTA")
            .when(F.col("o_custkey") % 6 == 1, " valle del cauca ")
            .when(F.col("o_custkey") % 6 == 2, "Bogota D.C.")
            .when(F.col("o_custkey") % 6 == 3, F.lit(None).cast("string"))
            .when(F.col("o_custkey") % 6 == 4, "ATLANTICO")
            .otherwise("san andres"))
    out = base.select(
        F.when(k % 50 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("CO1."), k.cast("string"))).alias("ID Contrato"),
        F.concat(F.lit("  "), F.lower("c_name"),
                 F.when(k % 3 == 0, F.lit(" s.a.s ")).otherwise(F.lit("  d.c."))).alias("Nombre Entidad"),
        F.when(k % 40 == 0, F.lit("n/a")).otherwise(
            F.concat(F.lit("NIT "), (F.lit(800000000) + F.col("c_custkey")).cast("string"), F.lit("-"),
                     (F.col("c_custkey") % 10).cast("string"))).alias("Nit Entidad"),
        dept.alias("Departamento"),
        F.when(k % 30 == 0, F.lit("sin valor")).otherwise(
            F.concat(F.lit("$ "), F.floor("o_totalprice").cast("bigint").cast("string"))).alias("Valor del Contrato"),
        date_text.alias("Fecha de Firma"),
        k.alias("_k"),
    )
    doubled = out.filter(F.col("_k") % 20 == 0)
    return out.unionByName(doubled).drop("_k")


def _order_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    nation = F.broadcast(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    return orders.join(cust, orders.o_custkey == cust.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def _dirty_department(c_nat, n_name):
    return (F.when(c_nat % 5 == 0, F.lit("bogota"))
            .when(c_nat % 5 == 1, F.lower(n_name))
            .when(c_nat % 5 == 2, F.lit(" ATLANTICO "))
            .when(c_nat % 5 == 3, F.lit(None).cast("string"))
            .otherwise(n_name))


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three landed contract sources with their own column names (text).

    Orders are split by ``o_orderkey % 3`` into SECOP I, SECOP II and
    SECOP Integrado shaped extracts, with blanks, null-likes and
    money/date spellings the consolidation has to handle.
    """
    base = _order_people(spark, sf_dir)
    k = F.col("o_orderkey")
    nit = F.when(k % 41 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("NIT "), (F.lit(800000000) + F.col("c_custkey")).cast("string"), F.lit("-"),
                 (F.col("c_custkey") % 10).cast("string")))
    entity = (F.when(k % 37 == 0, F.lit("nan"))
              .when(k % 43 == 0, F.lit(" "))
              .otherwise(F.concat(F.lit(" "), F.lower("c_name"), F.lit("  alcaldia"))))
    dept = _dirty_department(F.col("c_nationkey"), F.col("n_name"))
    money = (F.when(k % 29 == 0, F.lit("0"))
             .when(k % 31 == 0, F.lit("sin dato"))
             .otherwise(F.concat(F.lit("$ "), F.floor("o_totalprice").cast("bigint").cast("string"))))
    fecha = F.date_format("o_orderdate", "yyyy-MM-dd")
    supplier = F.when(F.col("o_custkey") % 11 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("proveedor "), (F.col("o_custkey") % 13).cast("string")))
    tipo = F.lower("o_orderstatus")
    modal = F.col("o_orderpriority")

    s1 = base.filter(k % 3 == 0).select(
        F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("C1-"), k.cast("string"))).alias("numero_de_contrato"),
        entity.alias("nombre_entidad"), nit.alias("nit_de_la_entidad"), dept.alias("departamento_entidad"),
        modal.alias("modalidad_de_contratacion"), tipo.alias("tipo_de_contrato"), money.alias("cuantia_proceso"),
        fecha.alias("fecha_de_firma_del_contrato"), supplier.alias("proponentes_seleccionados"),
        F.year("o_orderdate").cast("string").alias("anno_firma_contrato"),
    )
    s2 = base.filter(k % 3 == 1).select(
        F.concat(F.lit("CO1.PCCNTR."), k.cast("string")).alias("id_contrato"),
        entity.alias("nombre_entidad"), nit.alias("nit_entidad"), dept.alias("departamento"),
        modal.alias("modalidad_de_contratacion"), tipo.alias("tipo_de_contrato"), money.alias("valor_del_contrato"),
        fecha.alias("fecha_de_firma"), supplier.alias("proveedor_adjudicado"),
        F.concat(F.lit("P-"), (k % 97).cast("string")).alias("proceso_de_compra"),
        F.lit("Educación Nacional").alias("sector"),
    )
    s3 = base.filter(k % 3 == 2).select(
        F.concat(F.lit("INT-"), k.cast("string")).alias("numero_del_contrato"),
        entity.alias("nombre_de_la_entidad"), nit.alias("nit_de_la_entidad"), dept.alias("departamento_entidad"),
        modal.alias("modalidad_de_contrataci_n"), tipo.alias("tipo_de_contrato"), money.alias("valor_contrato"),
        fecha.alias("fecha_de_firma_del_contrato"), supplier.alias("nom_raz_social_contratista"),
    )
    return {"secop_i": s1, "secop_ii": s2, "secop_integrado": s3}


def _li_orders_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_returnflag")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = F.broadcast(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    oc = orders.join(cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")),
                     F.col("o_custkey") == F.col("c_custkey"))
    return li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))


def edu_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _li_orders_people(spark, sf_dir)
    return x.select(
        F.col("n_name").alias("departamento"),
        F.year("o_orderdate").cast("int").alias("anno"),
        F.col("c_mktsegment").alias("nivel"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("matricula"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("int")).otherwise(F.lit(0)).alias("desertores"),
    )


def edu_enrolment(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _li_orders_people(spark, sf_dir)
    level = (F.when(F.col("o_orderpriority") == "1-URGENT", "preescolar")
             .when(F.col("o_orderpriority") == "2-HIGH", "primaria")
             .otherwise("secundaria"))
    return x.select(
        F.col("n_name").alias("departamento"),
        F.year("o_orderdate").cast("int").alias("anno"),
        level.alias("nivel_educativo"),
        F.col("c_name").alias("institucion"),
        F.col("l_quantity").cast("int").alias("cantidad"),
    )


def edu_exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _li_orders_people(spark, sf_dir)
    return x.select(
        F.col("n_name").alias("departamento"),
        F.year("o_orderdate").cast("int").alias("anno"),
        (F.col("l_quantity") * 10).cast("int").alias("puntaje_global"),
    )


def _cust_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = F.broadcast(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    return cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def edu_employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _cust_nation(spark, sf_dir)
    unemployed = F.col("c_custkey") % 10 == 0
    return x.select(
        F.col("n_name").alias("departamento"),
        F.col("c_mktsegment").alias("nivel_educativo"),
        F.when(unemployed, 0).otherwise(1).alias("ocupada"),
        F.when(unemployed, 1).otherwise(0).alias("desempleo"),
        F.col("c_acctbal").alias("ingreso"),
    )


def edu_establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _cust_nation(spark, sf_dir)
    return x.select(
        F.col("n_name").alias("departamento"),
        F.concat(F.col("n_name"), F.lit("-"), (F.col("c_custkey") % 7).cast("string")).alias("municipio"),
        F.col("c_mktsegment").alias("tipo_establecimiento"),
    )


BUILDERS = {
    "contracts": contracts,
    "raw_contracts": raw_contracts,
    "edu_dropout": edu_dropout,
    "edu_enrolment": edu_enrolment,
    "edu_exam": edu_exam,
    "edu_employment": edu_employment,
    "edu_establishments": edu_establishments,
}


def raw_education(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed education extract (source-style names, all text): one row
    per customer, every ninth twice; departments in the spellings the
    education map has to handle."""
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = F.broadcast(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    x = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    dept = (F.when(k % 7 == 0, F.lit("ATLANTICO"))
            .when(k % 7 == 1, F.lit(" san andrés "))
            .when(k % 7 == 2, F.lit("Cordoba"))
            .when(k % 7 == 3, F.lit("VICHADA"))
            .when(k % 7 == 4, F.lit(None).cast("string"))
            .otherwise(F.col("n_name")))
    sede = (F.when(k % 11 == 0, F.lit("nan"))
            .when(k % 13 == 0, F.lit("None"))
            .otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))))
    total = F.when(k % 17 == 0, F.lit("sin dato")).otherwise(
        F.concat(F.lit(" "), F.floor("c_acctbal").cast("bigint").cast("string")))
    zona = F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), F.lit("URBANA")).otherwise(F.lit("RURAL"))
    out = x.select(
        dept.alias("Departamento"),
        k.cast("string").alias("Código Institución"),
        sede.alias("Nombre Sede"),
        total.alias("Matrícula Total"),
        (k % 40).cast("string").alias("Num Docentes"),
        zona.alias("Zona"),
        k.alias("_k"),
    )
    return out.unionByName(out.filter(F.col("_k") % 9 == 0)).drop("_k")


def raw_spider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawler's JSON records as columns (text): names with spaces and
    hyphens, money with symbols, some dates day-first; every tenth order
    twice."""
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                        "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    x = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    valor = (F.when(k % 13 == 0, F.lit(""))
             .when(k % 19 == 0, F.concat(F.lit("-"), F.floor("o_totalprice").cast("bigint").cast("string")))
             .otherwise(F.concat(F.lit("$ "), F.col("o_totalprice").cast("decimal(12,2)").cast("string"))))
    inicio = F.when(k % 7 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    out = x.select(
        valor.alias("Valor Contrato"),
        inicio.alias("Fecha-Inicio"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Fecha Firma"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("Nombre Entidad"),
        F.concat(F.lit("Depto "), F.col("c_nationkey").cast("string")).alias("Departamento"),
        F.col("o_orderpriority").alias("Objeto Contrato"),
        F.concat(F.lit(" Prov "), (F.col("o_custkey") % 13).cast("string")).alias("Proveedor"),
        F.year("o_orderdate").cast("string").alias("Año"),
        k.alias("_k"),
    )
    return out.unionByName(out.filter(F.col("_k") % 10 == 0)).drop("_k")


BUILDERS.update({"raw_education": raw_education, "raw_spider": raw_spider})
