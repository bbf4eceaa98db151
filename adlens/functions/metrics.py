"""Advertising ratios as Column expressions.

Every ratio is guarded before it divides (D11), so the ANSI divide-by-zero
error can never fire whatever plan shape Catalyst picks.  Ratios are taken
in DOUBLE (D10): the two operands are cast first, so the result does not
depend on the decimal scale rules of the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.schema import MONEY_2DP, MONEY_SUM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, digits: int = 2) -> Column:
    """Round a DOUBLE half-up at ``digits`` places, as decimal arithmetic would.

    A quotient such as 19.025 is stored as 19.02499999...; rounding the
    binary value gives 19.02, rounding the number the data describe gives
    19.03.  Passing through DECIMAL(38,10) first recovers the decimal value
    (to 10 places), so the result is the same in any engine and on any
    executor.  A value beyond DECIMAL(38,10) (10^28 or more) gives null
    rather than failing the job.
    """
    return F.round(_c(x).try_cast("decimal(38,10)"), digits).cast("double")


def safe_ratio(num, den, scale: float | None = None, digits: int = 2,
               otherwise: float = 0.0) -> Column:
    """``round(num * scale / den, digits)`` when ``den > 0``, else ``otherwise``.

    A null denominator falls to ``otherwise`` (``null > 0`` is not true); a
    null numerator over a positive denominator stays null, as in SQL.
    """
    num, den = _c(num), _c(den)
    top = num.cast("double")
    if scale is not None:
        top = top * F.lit(float(scale))
    value = round_half_up(top / den.cast("double"), digits)
    return F.when(den > 0, value).otherwise(F.lit(float(otherwise)))


def acos(cost, sales) -> Column:
    """Advertising cost of sale, percent (M1)."""
    return safe_ratio(cost, sales, 100.0)


def roas(sales, cost) -> Column:
    """Return on ad spend (M2)."""
    return safe_ratio(sales, cost)


def conversion_rate(orders, clicks) -> Column:
    """Orders per hundred clicks (M3)."""
    return safe_ratio(orders, clicks, 100.0)


def cpc(cost, clicks) -> Column:
    """Cost per click (M4), guarded first."""
    return safe_ratio(cost, clicks)


def ctr(clicks, impressions) -> Column:
    """Click-through rate, percent (M5)."""
    return safe_ratio(clicks, impressions, 100.0)


def change_pct(current, previous, zero_base_as_one: bool = False) -> Column:
    """Day-over-day change in percent (M6-M8).

    With ``zero_base_as_one`` a previous value of 0 divides by 1 (the
    impressions rule); otherwise a previous 0 gives 0 (cost and sales).  No
    previous value gives 0 in both cases (D23).
    """
    current, previous = _c(current), _c(previous)
    diff = (current.cast("double") - previous.cast("double")) * F.lit(100.0)
    if zero_base_as_one:
        base = F.when(previous != 0, previous.cast("double")).otherwise(F.lit(1.0))
        return F.when(previous.isNotNull(), round_half_up(diff / base)).otherwise(F.lit(0.0))
    return F.when(previous.isNotNull() & (previous != 0),
                  round_half_up(diff / previous.cast("double"))).otherwise(F.lit(0.0))


# Money carries 4 decimal places: sums run over whole integer units of 1/10000.
MONEY_UNITS = 10_000


def money_sum(x) -> Column:
    """Exact sum of money (4 decimal places) as DECIMAL(38,4).

    The sum runs over integer ten-thousandths in a BIGINT: exactly the same
    result as a DECIMAL sum, but the aggregation buffer is a primitive long
    instead of an arbitrary-precision decimal, about twice as fast on the
    hottest path (every raw row of every report).  Overflow would need a
    total above 900 trillion and raises under ANSI mode.
    """
    units = (_c(x).cast(MONEY_SUM) * F.lit(MONEY_UNITS)).cast("bigint")
    return (F.sum(units).cast("decimal(38,0)") / F.lit(MONEY_UNITS)).cast(MONEY_SUM)


def money_2dp(x) -> Column:
    """Round money half-up to cents (M9, D12), exact on DECIMAL."""
    return F.round(_c(x).cast(MONEY_SUM), 2).cast(MONEY_2DP)


def count_sum(x) -> Column:
    return F.sum(_c(x)).cast("bigint")


def zero_if_null(x) -> Column:
    """Null -> 0.0 before comparing."""
    return F.coalesce(_c(x).cast("double"), F.lit(0.0))


def num_text(x) -> Column:
    """Text of a value already rounded to 2 places, the way Python prints a float.

    ``12.5 -> '12.5'``, ``100.0 -> '100.0'``, ``0.07 -> '0.07'``; also for
    values of 10 million and more, which a plain cast would print in
    exponent form.
    """
    fixed = F.format_string("%.2f", _c(x).cast("double"))
    return F.regexp_replace(fixed, r"(\.\d)0$", "$1")
