"""SQL snippets for the DuckDB oracle, mirroring the exact-arithmetic
conventions of ``operators.aggregates``."""

from __future__ import annotations

from ..sources.fixture_sql import with_views

MASTER_CTE = "master as (select * from contracts where valor_contrato is not null and valor_contrato > 0)"


def avgd(c: str = "valor_contrato") -> str:
    """``CAST(SUM(x) AS DOUBLE) / COUNT(x)``."""
    return f"(cast(sum({c}) as double) / count({c}))"


def avg2(c: str = "valor_contrato") -> str:
    """Half-up average to 2 decimals in integer cents."""
    return (f"cast(cast(((2 * cast(sum({c}) * 100 as hugeint) + count({c})) // (2 * count({c}))) as decimal(38,0))"
            f" * 0.01 as decimal(20,2))")


def pct(num: str, den: str) -> str:
    """Half-up ``ROUND(num * 100.0 / den, 2)`` in integers, as DOUBLE."""
    a = f"cast(({num}) * 100 as hugeint)"
    b = f"cast(({den}) * 100 as hugeint)"
    return f"(cast((20000 * {a} + {b}) // (2 * {b}) as double) / 100.0)"


def sig(x: str, digits: int = 10) -> str:
    return f"cast(printf('%.{digits}e', {x}) as double)"


def title(x: str) -> str:
    """Python ``str.title()`` in DuckDB."""
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda t: upper(t[1]) || lower(t[2:])), '')")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def on_master(sql: str, *extra_views: str) -> str:
    """Prefix ``sql`` with the contract view and the master CTE."""
    text = with_views("select 1", "contracts", *extra_views)
    head = text[: text.rindex("\nselect 1")]
    return f"{head},\n{MASTER_CTE}\n{sql}"


def on_views(sql: str, *views: str) -> str:
    return with_views(sql, *views)
