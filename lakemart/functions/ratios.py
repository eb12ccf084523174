"""Null-safe ratios.  ANSI mode raises on x/0, so every ratio goes through
``try_divide`` (NULL on a zero or NULL denominator)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_div(num, den) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))






def pct_of_counts(num, den) -> Column:
    """round(100 * num / den, 2) for integer counts, rounded HALF_UP exactly
    with integer arithmetic, as DOUBLE; NULL when den is 0 or NULL.

    Rounding a floating quotient is engine-dependent at ties (1.005); the
    integer form is not: floor((20000*num + den) / (2*den)) / 100.
    """
    n, d = _c(num).cast("long"), _c(den).cast("long")
    hundredths = F.floor((n * 20000 + d) / (d * 2))
    return F.when(d != 0, hundredths.cast("double") / F.lit(100.0))


def money_sum(col) -> Column:
    """Exact decimal sum presented as DOUBLE."""
    return F.sum(_c(col)).cast("double")


def units(col, scale: int = 6) -> Column:
    """A decimal of at most ``scale`` places as the exact integer count of
    10^-scale units, DECIMAL(38,0)."""
    return (_c(col).cast(f"decimal(38,{scale})") * F.lit(10 ** scale).cast(f"decimal({scale + 1},0)")) \
        .cast("decimal(38,0)")


def round_ratio(num, den, digits: int = 2) -> Column:
    """round(num / den, digits), HALF_UP (away from zero) on the exact ratio of
    two exact integers (DECIMAL(38,0)), as DOUBLE; NULL when den is 0/NULL.

    Rounding a floating quotient differs between engines at ties (an exact
    -0.575 becomes -0.57 or -0.58); integer arithmetic does not:
    q = (2*|num|*10^d + |den|) div (2*|den|), the division done as
    (x - pmod(x, y)) / y, which is exact.
    """
    n, d = _c(num).cast("decimal(38,0)"), _c(den).cast("decimal(38,0)")
    x = (F.abs(n) * F.lit(2 * 10 ** digits).cast("decimal(10,0)") + F.abs(d)).cast("decimal(38,0)")
    y = (F.abs(d) * F.lit(2).cast("decimal(1,0)")).cast("decimal(38,0)")
    q = ((x - F.pmod(x, y)) / y).cast("decimal(38,0)")
    sign = F.signum(n) * F.signum(d)
    return F.when(d != 0, sign * q.cast("double") / F.lit(float(10 ** digits)))


def growth_pct(cur, prev) -> Column:
    """round(100 * (cur - prev) / prev, 2) exactly, for money sums (<= 6 places)."""
    return round_ratio(units(_c(cur) - _c(prev)) * F.lit(100).cast("decimal(3,0)"), units(prev))


def money_per(total, count) -> Column:
    """round(total / count, 2) exactly, for a money sum and a count."""
    return round_ratio(units(total), _c(count).cast("decimal(20,0)") * F.lit(10 ** 6).cast("decimal(7,0)"))
