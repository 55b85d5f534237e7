"""Exact rounding of ratios and averages.

`ROUND(100.0 * a / b, 2)` and `ROUND(AVG(x), 2)` are computed in integers:
round-half-up of p/q at s decimals is floor((2*p*10^s + q) / (2*q)) for
p >= 0, q > 0. No intermediate decimal or double rounding is involved, so the
result is the exact HALF_UP value whatever engine computes it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def round_half_up_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """num/den rounded half-up to `scale` decimals, as double; NULL when den is 0/NULL.

    `num` and `den` must be non-negative integers (counts, or money in cents).
    """
    p = num.cast(_WIDE)
    q = den.cast(_WIDE)
    two = F.lit(2).cast(_WIDE)
    a = two * p * F.lit(10 ** scale).cast(_WIDE) + q
    b = two * q
    # exact integer floor(a / b): subtract the remainder, then the division is exact
    units = ((a - F.pmod(a, b)) / b).cast("long")
    return F.when(q > 0, units.cast("double") / F.lit(float(10 ** scale)))


def percent_half_up(part: Column, total: Column, scale: int = 2) -> Column:
    """ROUND(100.0 * part / total, scale) for non-negative integer part/total."""
    return round_half_up_ratio(part.cast(_WIDE) * F.lit(100).cast(_WIDE), total, scale)


def narrow(c: Column, to: str) -> Column:
    """`c` as a narrower type; a value that does not fit is an error whatever the session's ANSI setting
    (a plain cast makes it NULL where ANSI is off)."""
    fits = c.try_cast(to)
    too_large = F.raise_error(F.concat(F.lit(f"value out of range for {to}: "), c.cast("string"))).cast(to)
    return F.when(c.isNotNull() & fits.isNull(), too_large).otherwise(fits)


def cents(money: Column) -> Column:
    """decimal(p,2) money as an exact integer number of cents."""
    return (money * F.lit(100)).cast(_WIDE)
