"""Exact rounding helpers.

Ratios are computed on integers (counts, or money in cents) and rounded
half away from zero with integer division, so the result is the exact
rational rounded once -- the way a ``NUMERIC`` database rounds -- and does
not depend on floating-point evaluation order. The final value is a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(money: Column) -> Column:
    """A scale-2 decimal (or a sum of them) as an exact integer count of cents."""
    return (money * 100).cast("decimal(38,0)")


def half_up_ratio(num: Column, den: Column, digits: int = 2, scale: int = 1) -> Column:
    """``round(num / den * scale, digits)``, half away from zero, as a double.

    ``num`` and ``den`` must be integral (long, or decimal with scale 0).
    ``den = 0`` or null gives null, like ``nullif(den, 0)``.
    """
    p = 10 ** digits
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    q = F.call_function("div", F.abs(n) * F.lit(2 * p * scale) + F.abs(d), F.abs(d) * 2)
    val = q.cast("double") / F.lit(float(p)) * F.signum(n) * F.signum(d)
    return F.when(d != 0, val)


def money_double(x: Column) -> Column:
    """A decimal money value rounded to 2 places (half up), as a double."""
    return F.round(x, 2).cast("double")


def avg_money(total: Column, count: Column) -> Column:
    """``round(avg(amount), 2)`` from an exact decimal sum and a row count."""
    return half_up_ratio(cents(total), count * 100, digits=2)
