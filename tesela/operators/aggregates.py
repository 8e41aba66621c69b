"""Aggregate building blocks shared by marts, indicators and measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ColumnOrName = Column | str


def money_sum(c: str = "valor_contrato") -> Column:
    """Exact sum of a DECIMAL money column (stays DECIMAL)."""
    return F.sum(F.col(c))


def avg_money_2(c: str = "valor_contrato") -> Column:
    """``CAST(AVG(money) AS DECIMAL(20,2))`` computed exactly.

    Averages in integer cents and rounds half up once:
    ``(2 * sum_cents + n) div (2 * n)``. A decimal ``avg`` would round twice
    (to scale 6, then to 2); a double ``avg`` depends on summation order.
    For positive money only, which the master mart guarantees.
    """
    return avg_2_of(F.sum(F.col(c)), F.count(F.col(c)))


def avg_2_of(total: Column, count: Column) -> Column:
    """:func:`avg_money_2` from a sum and a count."""
    cents = (total * 100).cast("decimal(38,0)")
    n = count.cast("decimal(38,0)")
    num = cents * 2 + n
    den = n * 2
    # exact integer division: (num - num mod den) / den has no remainder
    q = F.try_divide(num - F.pmod(num, den), den).cast("decimal(38,0)")
    return (q * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(20,2)")


def avg_as_double(c: str = "valor_contrato") -> Column:
    """``SUM(x) / COUNT(x)`` as DOUBLE from an exact decimal sum."""
    return F.try_divide(F.sum(F.col(c)).cast("double"), F.count(F.col(c)).cast("double"))


def distinct_count_with_blank(c: str) -> Column:
    """DAX ``DISTINCTCOUNT``: a blank (null) counts as one more value."""
    return (F.count_distinct(F.col(c))
            + F.max(F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0)))).cast("bigint")


def settled(agg: DataFrame) -> DataFrame:
    """Aggregated rows, computed once and kept in the checkpoint folder, so
    totals, cuts and ranks over them do not scan the fact again."""
    ensure_checkpoint_dir(agg.sparkSession)
    return agg.checkpoint(eager=True)


def with_total(agg: DataFrame, measure: str, total_alias: str) -> DataFrame:
    """Attach the grand total of ``measure`` over the aggregated rows.

    The total is a one-row aggregate joined by broadcast (a proven
    one-row bound), not a global window, so the aggregated rows stay
    distributed. They are settled first: the fact is scanned once.
    """
    agg = settled(agg)
    total = agg.agg(F.sum(F.col(measure)).alias(total_alias))
    return agg.crossJoin(F.broadcast(total))


def distinct_values(df: DataFrame, c: str, alias: str) -> DataFrame:
    """``distinct_count_with_blank`` of one column as a one-row table, in two
    levels: several such counts in one aggregate would copy every row."""
    return df.select(c).distinct().agg(F.nullif(F.count(F.lit(1)), F.lit(0)).alias(alias))


def top_n_with_ties(df: DataFrame, n: int, by: str, descending: bool = True) -> DataFrame:
    """RNK-01, DAX ``TOPN``: the first ``n`` rows by ``by`` plus every tie at
    the cut.

    Equivalent to ``rank() <= n`` without a global window: a distributed
    top-n (``TakeOrderedAndProject``) finds the n-th value, and a one-row
    broadcast filter keeps everything at least as good. ``df`` is read twice,
    so pass ``settled`` rows.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()
    cut = df.select(by).orderBy(order).limit(n)
    bound = cut.agg((F.min(by) if descending else F.max(by)).alias("_cut"))
    cond = (F.col(by) >= F.col("_cut")) if descending else (F.col(by) <= F.col("_cut"))
    return df.crossJoin(F.broadcast(bound)).filter(cond).drop("_cut")


def order_limit(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """RNK-02, ``ORDER BY ... LIMIT n`` with the caller's total order.

    Planned as ``TakeOrderedAndProject``: each task keeps its own top n,
    one task merges ``n x tasks`` rows.
    """
    return df.orderBy(*order).limit(n)


def _exact_int(c: Column) -> Column:
    return (c * 100).cast("decimal(38,0)")


def pct_half_up(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``ROUND(num * 100.0 / den, 2)`` computed exactly, as DOUBLE.

    ``num`` and ``den`` are counts or 2-decimal money (both non-negative).
    The percentage in hundredths is ``floor((20000 a + b) / 2b)`` over the
    integers ``a = 100 num``, ``b = 100 den``: one half-up rounding of the
    exact ratio, the way a NUMERIC engine rounds, independent of float
    rounding of intermediate doubles.
    """
    a, b = _exact_int(_col(num)), _exact_int(_col(den))
    top = a * 20000 + b
    bot = b * 2
    q = F.try_divide(top - F.pmod(top, bot), bot).cast("decimal(38,0)")
    return F.when(b > 0, q.cast("double") / F.lit(100.0))


def sig(c: ColumnOrName, digits: int = 10) -> Column:
    """Round a floating result to ``digits + 1`` significant digits, for
    results whose last bits depend on summation order (stddev)."""
    return F.format_string(f"%.{digits}e", _col(c)).cast("double")


def _col(c):
    return F.col(c) if isinstance(c, str) else c
