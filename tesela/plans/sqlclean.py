"""The cleaning rules written as DuckDB SQL, for the oracle of the cleaning
jobs. Independent text from ``functions.cleaning``; the fixed maps come
from the same vocabulary module."""

from __future__ import annotations

from ..functions import vocab
from .sqlkit import strip, title


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def normalize_text(x: str) -> str:
    s = strip(x)
    return (f"(case when {s} is null or lower({s}) in ('nan', 'none', 'null', '') then '' "
            f"else regexp_replace({title(s)}, '\\s+', ' ', 'g') end)")


def _map_case(key: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"when {q(k)} then {q(v)}" for k, v in mapping.items())
    return f"(case {key} {whens} end)"


def canonical_department(x: str, blank: str | None = None) -> str:
    empty = "null" if blank is None else q(blank)
    mapped = _map_case(f"lower({strip(x)})", vocab.CONTRACT_DEPARTMENTS)
    return f"(case when {x} is null or {x} = '' then {empty} else coalesce({mapped}, {title(x)}) end)"


def education_department(x: str) -> str:
    key = strip(f"lower({x})")
    table = dict(vocab.EDUCATION_DEPARTMENTS)
    table.update(vocab.EDUCATION_DEPARTMENT_ALIASES)
    return f"coalesce({_map_case(key, table)}, {key})"


def clean_nit(x: str, empty: str | None = None) -> str:
    v = f"regexp_replace({strip(x)}, '[^0-9-]', '', 'g')"
    blank = "null" if empty is None else q(empty)
    return f"(case when {v} is null or {v} = '' then {blank} else {v} end)"


def clean_money(x: str) -> str:
    t = f"regexp_replace({strip(x)}, '[$.,\\s]', '', 'g')"
    return (f"coalesce(case when regexp_full_match({t}, '[+-]?[0-9]+([eE][+-]?[0-9]+)?') "
            f"then try_cast({t} as double) end, 0.0)")


def clean_date(x: str) -> str:
    s = f"regexp_replace({strip(x)}, '\\s+\\d{{1,2}}:\\d{{2}}.*$', '')"
    fmts = ["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%Y/%m/%d", "%Y-%m-%d %H:%M:%S"]
    return "cast(coalesce(" + ", ".join(f"try_strptime({s}, '{f}')" for f in fmts) + ") as date)"


def blank_text(x: str) -> str:
    s = strip(x)
    return f"(case when {s} is null or {s} in ('nan', 'None') then '' else {s} end)"


def to_number(x: str) -> str:
    s = strip(x)
    return (f"(case when regexp_full_match({s}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"then try_cast({s} as double) end)")


def not_defined(x: str) -> str:
    return f"(case when coalesce({x}, '') = '' then 'No Definido' else {x} end)"
