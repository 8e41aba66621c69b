"""Composite jobs (JOB-01 ... JOB-05).

Each cleaning job is one projection built on the driver from the column
names (rules attach by substring of the name), then a filter and a
``dropDuplicates``; no per-cell Python and no action inside the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import vocab
from ..operators import filters
from ..operators.indexing import dense_index
from ..session import compiled_rules

# FIXED VALUES: columns the contract cleaning title-cases, in order.
CONTRACT_TEXT_COLUMNS = [
    "nombre_entidad", "departamento", "ciudad", "proveedor_adjudicado", "proveedor", "proceso_de_compra",
    "tipo_de_contrato", "modalidad_de_contratacion", "estado_contrato", "sector", "rama", "modalidad",
]
# FIXED VALUES: name fragments that mark numeric education columns.
EDUCATION_NUMERIC_MARKERS = ["matricula", "cantidad", "num", "total", "valor"]
# FIXED VALUES: the Spark-variant cleaning's column lists.
SPARK_VARIANT_DATES = ["fecha_inicio", "fecha_firma", "fecha_fin", "fecha_adjudicacion"]
SPARK_VARIANT_TEXT = ["nombre_entidad", "departamento", "municipio", "objeto_contrato", "proveedor"]


def contract_rules(columns: list[str]) -> dict[str, list[str]]:
    """Which rules apply to which columns (substring dispatch, PRJ-08).

    Kept as in the source, traps included: ``valor_unitario`` contains
    ``nit``; ``modalidad_de_contrato`` contains ``id`` and ``contrato``.
    """
    money = [c for c in columns if "valor" in c and c != "valor_contrato"]
    if "valor_contrato" in columns:
        money.append("valor_contrato")
    return {
        "money": money,
        "date": [c for c in columns if "fecha" in c],
        "nit": [c for c in columns if "nit" in c],
        "department": [c for c in columns if "departamento" in c],
        "text": [c for c in CONTRACT_TEXT_COLUMNS if c in columns],
    }


def _stage(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One projection per rule layer: each rule reads its input several
    times, so nesting them in one expression would multiply the tree (and
    the generated code); stacked projections of non-trivial expressions are
    kept apart by the optimizer and each compiles once."""
    return df.select(*[(rules[c] if c in rules else F.col(c)).alias(c) for c in df.columns])


def _as_typed_text(col: Column, dtype: str) -> Column:
    return col if dtype == "string" else col.cast("string")


def clean_contracts(raw: DataFrame, money_mode: str = "strip_all") -> DataFrame:
    """JOB-01: names -> money -> dates -> tax ids -> departments -> text,
    then blank ids dropped, full-row duplicates dropped, value > 0 kept.

    A money column that is already numeric is not re-parsed (the source
    rule deletes decimal points and would inflate it).
    """
    compiled_rules(raw.sparkSession)
    df = C.normalize_column_names(raw)
    rules = contract_rules(df.columns)
    types = dict(df.dtypes)
    exprs = []
    for c in df.columns:
        e: Column = F.col(c)
        t = types[c]
        if c in rules["money"] and t == "string":
            e, t = C.clean_money(e, money_mode), "double"
        if c in rules["date"]:
            e, t = C.clean_date(_as_typed_text(e, t)), "date"
        if c in rules["nit"]:
            e, t = C.clean_nit(e), "string"
        if c in rules["department"]:
            e, t = C.canonical_department(e), "string"
        exprs.append(e.alias(c))
    out = df.select(*exprs)
    for step in (C.collapsed_text, C.title_case):  # SCL-01
        out = _stage(out, {c: step(c) for c in rules["text"]})
    out = filters.drop_blank_ids(out)
    out = filters.dedupe(out)
    return filters.keep_positive(out)


def _text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def clean_education(raw: DataFrame) -> DataFrame:
    """JOB-02: names -> department map -> every text column trimmed
    with ``nan``/``None`` blanked -> numeric coercion -> distinct -> drop
    all-null rows."""
    compiled_rules(raw.sparkSession)
    df = C.normalize_column_names(raw)
    dep_cols = {c for c in df.columns if "depto" in c or "departamento" in c}
    text_cols = set(_text_columns(df))
    num_cols = {c for c in df.columns if any(m in c for m in EDUCATION_NUMERIC_MARKERS)}
    exprs = []
    for c in df.columns:
        e: Column = F.col(c)
        if c in dep_cols:
            e = C.education_department(e)
        if c in text_cols:
            e = C.blank_text(e)
        if c in num_cols:
            e = C.to_number(e)
        exprs.append(e.alias(c))
    out = df.select(*exprs)
    out = filters.dedupe(out)
    return filters.drop_all_null(out)


def clean_contracts_spark_variant(raw: DataFrame) -> DataFrame:
    """JOB-03: names (accents kept) -> money keeps digits and ``.`` ->
    ``yyyy-MM-dd`` dates -> lower/trim text -> distinct."""
    compiled_rules(raw.sparkSession)
    df = C.normalize_column_names(raw, C.normalize_name_spark_variant)
    exprs = []
    for c in df.columns:
        e: Column = F.col(c)
        if c == "valor_contrato":
            e = C.clean_money(e, "decimal")
        elif c in SPARK_VARIANT_DATES:
            e = C.iso_date(e)
        elif c in SPARK_VARIANT_TEXT:
            e = C.lower_trim(e)
        exprs.append(e.alias(c))
    return filters.dedupe(df.select(*exprs))


# ------------------------------------------------------------------ consolidation
# FIXED VALUES: per-source column names -> common names.
SECOP_I_RENAMES = {
    "nombre_entidad": "nombre_entidad",
    "nit_de_la_entidad": "nit_entidad",
    "departamento_entidad": "departamento",
    "modalidad_de_contratacion": "modalidad",
    "tipo_de_contrato": "tipo_contrato",
    "cuantia_proceso": "valor_contrato",
    "fecha_de_firma_del_contrato": "fecha_firma",
    "proponentes_seleccionados": "proveedor",
    "anno_firma_contrato": "anno",
}
SECOP_II_RENAMES = {
    "nombre_entidad": "nombre_entidad",
    "nit_entidad": "nit_entidad",
    "departamento": "departamento",
    "modalidad_de_contratacion": "modalidad",
    "tipo_de_contrato": "tipo_contrato",
    "valor_del_contrato": "valor_contrato",
    "fecha_de_firma": "fecha_firma",
    "proveedor_adjudicado": "proveedor",
    "proceso_de_compra": "proceso",
    "sector": "sector",
    "id_contrato": "uid",
}
INTEGRADO_RENAMES = {
    "nombre_de_la_entidad": "nombre_entidad",
    "nit_de_la_entidad": "nit_entidad",
    "departamento_entidad": "departamento",
    "modalidad_de_contrataci_n": "modalidad",
    "tipo_de_contrato": "tipo_contrato",
    "valor_contrato": "valor_contrato",
    "fecha_de_firma_del_contrato": "fecha_firma",
    "nom_raz_social_contratista": "proveedor",
    "numero_del_contrato": "uid",
}
SOURCE_RENAMES = {
    "secop_i": (SECOP_I_RENAMES, vocab.ORIGIN_SECOP_I),
    "secop_ii": (SECOP_II_RENAMES, vocab.ORIGIN_SECOP_II),
    "secop_integrado": (INTEGRADO_RENAMES, vocab.ORIGIN_INTEGRADO),
}
# FIXED VALUES: the consolidated table's columns, those that are title-cased,
# and those whose blanks read ``No Definido``.
COMMON_COLUMNS = ["uid", "nombre_entidad", "nit_entidad", "departamento", "modalidad", "tipo_contrato",
                  "valor_contrato", "fecha_firma", "proveedor", "origen"]
CONSOLIDATED_TEXT = ["nombre_entidad", "departamento", "modalidad", "tipo_contrato", "proveedor"]
CONSOLIDATED_NOT_DEFINED = ["nit_entidad", "departamento", "proveedor", "modalidad", "tipo_contrato",
                            "fecha_firma", "nombre_entidad"]


def rename_source(df: DataFrame, renames: Mapping[str, str], origin: str) -> DataFrame:
    """PRJ-03/04/05: rename the present columns in one projection and tag
    the origin."""
    sel = [F.col(c).alias(renames.get(c, c)) for c in df.columns]
    return df.select(*sel, F.lit(origin).alias("origen"))


def synthesize_uid(df: DataFrame, origin_prefix: str = "SECOP_I_") -> DataFrame:
    """PRJ-03 uid for SECOP I: ``numero_de_contrato _ nit`` with null parts
    printed as ``nan``; without a contract number, ``SECOP_I_<row index>``
    over an explicit total order of the row."""
    if "uid" in df.columns:
        return df
    if "numero_de_contrato" in df.columns:
        nit = F.col("nit_entidad") if "nit_entidad" in df.columns else F.lit(None)
        uid = F.concat(F.coalesce(F.col("numero_de_contrato").cast("string"), F.lit("nan")), F.lit("_"),
                       F.coalesce(nit.cast("string"), F.lit("nan")))
        return df.withColumn("uid", uid)
    indexed = dense_index(df, [F.col(c).asc_nulls_first() for c in df.columns], "_row")
    return indexed.withColumn("uid", F.concat(F.lit(origin_prefix), F.col("_row").cast("string"))).drop("_row")


def align(df: DataFrame, columns: list[str] = COMMON_COLUMNS) -> DataFrame:
    """PRJ-06: the common columns, missing ones as ``""``."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit("")).alias(c) for c in columns])


def consolidate_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """JOB-04 before the gate: rename, align, union, clean the text,
    department, tax id and value columns, fill ``No Definido``."""
    parts = []
    for key, df in sources.items():
        compiled_rules(df.sparkSession)
        renames, origin = SOURCE_RENAMES[key]
        r = rename_source(df, renames, origin)
        if key == "secop_i":
            r = synthesize_uid(r)
        a = align(r)
        # value per source before the union: text is parsed with the money
        # rule, an already numeric (cleaned) value is kept as is; every
        # other column is text, so sources of mixed types union cleanly
        vtype = dict(a.dtypes)["valor_contrato"]
        value = (C.clean_money("valor_contrato") if vtype == "string"
                 else F.coalesce(F.col("valor_contrato").cast("double"), F.lit(0.0)))
        parts.append(a.select(*[(value if c == "valor_contrato" else F.col(c).cast("string")).alias(c)
                                for c in a.columns]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    for step in (C.collapsed_text, C.title_case):  # SCL-01
        u = _stage(u, {c: step(c) for c in CONSOLIDATED_TEXT})
    u = _stage(u, {"departamento": C.canonical_department("departamento", blank=""),
                  "nit_entidad": C.clean_nit("nit_entidad", empty="")})
    return _stage(u, {c: C.not_defined(c) for c in CONSOLIDATED_NOT_DEFINED})


def consolidate(sources: Mapping[str, DataFrame]) -> DataFrame:
    """JOB-04: consolidated table behind the four-rule quality gate.

    The rows that reach the gate are observed (``gate_input``): on the plain
    plan the optimizer pushes the gate below the cleaning projections and
    inlines the rules into the filter, where they run again for every input
    row; below a count of its rows it cannot go.
    """
    cleaned = consolidate_sources(sources)
    return filters.quality_gate(cleaned.observe("gate_input", F.count(F.lit(1)).alias("rows")))
