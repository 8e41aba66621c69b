"""Scalar cleaning rules as ``Column -> Column`` functions.

The source system applies these cell by cell in Python. Here each one is a
native expression, so a cleaning job is a single ``select`` that runs inside
whole-stage codegen, with no Python worker in the data path.

Spark 4 runs in ANSI mode: every cast of untrusted text goes through
``try_cast`` / ``try_to_date`` / ``try_divide``.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

ColumnOrName = Column | str

# Java regex: (?U) makes \s, \d, \w Unicode-aware like Python's str methods.
# The characters Python's str.strip() removes (str.isspace), by rule.
_PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
_WS_RUN = r"(?U)\s+"
_NON_LETTER = r"([^\p{L}])"
_NON_LETTER_SPACE = r"([^\p{L}]) "
_LETTER_AFTER_MARK = r"[^\p{L} ]\p{L}"
_TIME_TAIL = r"(?U)\s+\d{1,2}:\d{2}.*$"
_MONEY_STRIP = r"(?U)[$.,\s]"
# What Python's float() accepts once the money rule has run, minus the
# spellings that are deliberately mapped to 0 (``1_000``, ``inf``, ``nan``).
_FLOAT_TEXT = r"^[+-]?[0-9]+([eE][+-]?[0-9]+)?$"
_NUMERIC_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnOrName) -> Column:
    return _c(c).cast("string")


# ---------------------------------------------------------------- column names
def normalize_name(name: str) -> str:
    """PRJ-01: lower, space -> ``_``, drop everything outside ``[a-z0-9_]``.

    Accented letters are dropped (``año`` -> ``ao``), as in the source rule.
    """
    out = name.lower().replace(" ", "_")
    return re.sub(r"[^a-z0-9_]", "", out)


def normalize_name_spark_variant(name: str) -> str:
    """PRJ-02: lower, space and ``-`` -> ``_``; accents kept."""
    return name.lower().replace(" ", "_").replace("-", "_")


def normalize_column_names(df, rule=normalize_name):
    """Rename all columns in one projection; raise on collisions."""
    names = [rule(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both normalise to {new!r}")
        seen[new] = old
    return df.toDF(*names)


# ---------------------------------------------------------------- text
def strip_ws(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: Unicode whitespace on both ends, as a
    character-set trim (no regular expression)."""
    return F.btrim(as_text(c), F.lit(_PY_WHITESPACE))


def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title()``: a letter run starts upper, continues lower.

    ``initcap`` only capitalises after spaces (``D.C.`` -> ``D.c.``), which
    is the same thing unless a letter follows another non-letter. Those
    values take the exact route: a space is put after every non-letter,
    ``initcap`` runs, and the one space after each non-letter is taken out
    again (a left-to-right scan always meets a non-letter together with its
    inserted space, so exactly the inserted spaces go). Native expressions
    only, no lambda per run.
    """
    s = as_text(c)
    exact = F.regexp_replace(F.initcap(F.regexp_replace(s, _NON_LETTER, "$1 ")), _NON_LETTER_SPACE, "$1")
    return F.when(s.rlike(_LETTER_AFTER_MARK), exact).otherwise(F.initcap(s))


def collapsed_text(c: ColumnOrName) -> Column:
    """SCL-01 up to the title case: null-like -> ``""``, strip, collapse
    whitespace."""
    s = strip_ws(c)
    null_like = s.isNull() | F.lower(s).isin(*vocab.NULL_LIKE_TEXT)
    return F.when(null_like, F.lit("")).otherwise(F.regexp_replace(s, _WS_RUN, " "))


def normalize_text(c: ColumnOrName) -> Column:
    """SCL-01: null-like -> ``""``, strip, title case, collapse whitespace.

    Whitespace is collapsed before title-casing: both treat it as a
    non-letter, so the result is the same, and single spaces let more
    values take ``initcap`` directly. Over many rows the two steps go into
    projections of their own: the title case reads its input several times."""
    return title_case(collapsed_text(c))


def lower_trim(c: ColumnOrName) -> Column:
    """SCL-11 (Spark variant of the cleaning job): ``trim(lower(c))``."""
    return F.trim(F.lower(as_text(c)))


def blank_text(c: ColumnOrName) -> Column:
    """SCL-08: strip; literal ``nan`` / ``None`` and nulls become ``""``."""
    s = strip_ws(c)
    return F.when(s.isNull() | s.isin("nan", "None"), F.lit("")).otherwise(s)


def not_defined(c: ColumnOrName) -> Column:
    """SCL-12: blank or null -> ``No Definido``."""
    v = as_text(c)
    return F.when(F.coalesce(v, F.lit("")) == "", F.lit(vocab.NOT_DEFINED)).otherwise(v)


def no_info(c: ColumnOrName, label: str = vocab.NO_INFO) -> Column:
    """SCL-13: null -> ``Sin info`` (or ``Sin información``)."""
    return F.coalesce(_c(c), F.lit(label))


# ---------------------------------------------------------------- dates
def clean_date(c: ColumnOrName) -> Column:
    """SCL-02: drop a trailing clock time, then try the fixed formats in order.

    ISO timestamps with ``T`` match no format and give null (source rule).
    """
    s = F.regexp_replace(strip_ws(c), _TIME_TAIL, "")
    return F.coalesce(*[F.try_to_date(s, p) for p in vocab.DATE_PATTERNS])


def iso_date(c: ColumnOrName) -> Column:
    """SCL-10: ``yyyy-MM-dd`` or null."""
    return F.try_to_date(as_text(c), "yyyy-MM-dd")


def blank_to_date(c: ColumnOrName) -> Column:
    """SCL-14: ``NULLIF(x::text, '')::date``."""
    return F.try_to_date(F.nullif(as_text(c), F.lit("")))


def year_of(c: ColumnOrName) -> Column:
    """SCL-15, as INT."""
    return F.year(_c(c)).cast("int")


def month_of(c: ColumnOrName) -> Column:
    return F.month(_c(c)).cast("int")


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """SCL-16: date - date as an integer number of days."""
    return F.datediff(_c(end), _c(start))


# ---------------------------------------------------------------- numbers
def clean_money(c: ColumnOrName, mode: str = "strip_all") -> Column:
    """SCL-03 / SCL-09: money text to DOUBLE.

    ``strip_all`` is the source rule: delete ``$ . ,`` and whitespace, then
    parse; anything unparsable is 0. It deletes the decimal point too, so
    ``50000000.0`` becomes ``500000000``; apply it to source text only.
    ``decimal`` keeps digits and ``.`` and gives null when unparsable.
    """
    if mode == "strip_all":
        t = F.regexp_replace(strip_ws(c), _MONEY_STRIP, "")
        # "" if it does not match: one reading of t, not a test and a cast
        return F.coalesce(F.regexp_extract(t, _FLOAT_TEXT, 0).try_cast("double"), F.lit(0.0))
    if mode == "decimal":
        return F.regexp_replace(as_text(c), r"[^0-9.]", "").try_cast("double")
    raise ValueError(f"unknown money mode {mode!r}")


def to_number(c: ColumnOrName) -> Column:
    """SCL-07: numeric text to DOUBLE, anything else null."""
    s = strip_ws(c)
    return F.when(s.rlike(_NUMERIC_TEXT), s.try_cast("double"))


def clean_nit(c: ColumnOrName, empty: str | None = None) -> Column:
    """SCL-04: keep digits and ``-``; empty -> null (or ``empty``)."""
    v = F.regexp_replace(as_text(c), r"[^0-9-]", "")
    blank = F.lit(empty) if empty is not None else F.lit(None).cast("string")
    return F.when(v.isNull() | (v == ""), blank).otherwise(v)


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """SCL-17: DAX ``DIVIDE`` / SQL ``x / NULLIF(y, 0)``."""
    return F.try_divide(_c(num), _c(den))


def pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """``ROUND(num * 100.0 / den, digits)`` as DOUBLE; null when den is 0."""
    return F.round(F.try_divide(_c(num).cast("double") * F.lit(100.0), _c(den).cast("double")), digits)


def mean_of_sum(total: ColumnOrName, n: ColumnOrName) -> Column:
    """Average from an exact decimal sum: ``CAST(sum AS DOUBLE) / n``."""
    return F.try_divide(_c(total).cast("double"), _c(n).cast("double"))


# ---------------------------------------------------------------- departments
def _map_literal(mapping: dict[str, str]) -> Column:
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def canonical_department(c: ColumnOrName, blank: str | None = None) -> Column:
    """SCL-05: fixed map on ``lower(strip)``, else the title-cased value.

    Blank or null gives null (cleaning) or ``blank`` (consolidation).
    """
    v = as_text(c)
    key = F.lower(strip_ws(v))
    mapped = F.element_at(_map_literal(vocab.CONTRACT_DEPARTMENTS), key)
    empty = F.lit(blank) if blank is not None else F.lit(None).cast("string")
    return F.when(v.isNull() | (v == ""), empty).otherwise(F.coalesce(mapped, title_case(v)))


def education_department(c: ColumnOrName) -> Column:
    """SCL-06: fixed map on ``strip(lower)``, else the lower-cased value."""
    key = strip_ws(F.lower(as_text(c)))
    table = dict(vocab.EDUCATION_DEPARTMENTS)
    table.update(vocab.EDUCATION_DEPARTMENT_ALIASES)
    return F.coalesce(F.element_at(_map_literal(table), key), key)


# ---------------------------------------------------------------- buckets
def value_band(c: ColumnOrName) -> Column:
    """SCL-18: eight value bands, lower bound inclusive."""
    v = _c(c)
    expr = None
    for upper, label in vocab.VALUE_BANDS:
        expr = F.when(v < upper, label) if expr is None else expr.when(v < upper, label)
    return expr.otherwise(vocab.TOP_VALUE_BAND)


def sector_from_object(c: ColumnOrName) -> Column:
    """SCL-19: from the contract object, lowered; the patterns are unaccented."""
    v = F.lower(_c(c))
    return (F.when(v.like("%educacion%"), "Educación")
            .when(v.like("%salud%"), "Salud")
            .otherwise("Otros"))


def sector_category5(c: ColumnOrName) -> Column:
    """SCL-20: five classes, case-sensitive LIKE (``defensa`` stays lower)."""
    v = _c(c)
    return (F.when(v.like("%Educaci%"), "Educación")
            .when(v.like("%Salud%") | v.like("%Social%"), "Salud")
            .when(v.like("%Transporte%"), "Transporte")
            .when(v.like("%defensa%") | v.like("%seguridad%"), "Defensa")
            .otherwise("Otros"))


def sector_category3(c: ColumnOrName) -> Column:
    """SCL-21: three classes on the lowered sector."""
    v = F.lower(_c(c))
    return (F.when(v.like("%educaci%"), "Educación")
            .when(v.like("%salud%") | v.like("%social%"), "Salud")
            .otherwise("Otros"))


def is_education_or_health(c: ColumnOrName) -> Column:
    v = F.lower(_c(c))
    return v.like("%educaci%") | v.like("%salud%") | v.like("%social%")


def sector_from_names(tipo: ColumnOrName, entidad: ColumnOrName) -> Column:
    """SCL-22: DAX ``CONTAINSSTRING`` (case-insensitive); Salud tested first."""
    t, e = F.lower(_c(tipo)), F.lower(_c(entidad))

    def has(col: Column, word: str) -> Column:
        return F.coalesce(col.contains(word.lower()), F.lit(False))

    salud = has(t, "Salud") | has(t, "Hospital") | has(e, "Salud") | has(e, "Hospital")
    educ = (has(t, "Educacion") | has(t, "Educación") | has(e, "Educacion")
            | has(e, "Universidad") | has(e, "Colegio"))
    return F.when(salud, "Salud").when(educ, "Educación").otherwise("Otros")


def freshness_class(last: ColumnOrName, as_of: ColumnOrName) -> Column:
    """SCL-23: Actualizado / Reciente / Anual / Desactualizado (30/90/365 d)."""
    d, ref = _c(last), _c(as_of)
    return (F.when(d >= F.date_sub(ref, 30), "Actualizado")
            .when(d >= F.date_sub(ref, 90), "Reciente")
            .when(d >= F.date_sub(ref, 365), "Anual")
            .otherwise("Desactualizado"))


def coverage_class(n: ColumnOrName) -> Column:
    """SCL-24: Baja / media / Buena coverage at 100 and 500 rows."""
    v = _c(n)
    return (F.when(v < 100, "Baja cobertura")
            .when(v < 500, "Cobertura media")
            .otherwise("Buena cobertura"))


def strip_accents_py(s: str) -> str:
    """Plain-Python helper for tests and parameter handling only."""
    return "".join(ch for ch in unicodedata.normalize("NFD", s) if unicodedata.category(ch) != "Mn")
