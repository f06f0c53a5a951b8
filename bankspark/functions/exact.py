"""Exact decimal rounding of quotients.

``round(a / b, d)`` on Spark decimals first rounds the quotient to the
division's result scale (as low as 6 once precision is lost) and then to
``d`` places; the two roundings can disagree with one exact rounding.  Here
the quotient is rounded once, half away from zero, with integer arithmetic
on decimal(38,0) values (remainder and exact integer division), so the
result is exact for any magnitude a 38-digit decimal can hold.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"


def _as_int(c: Column, scale: int) -> Column:
    """Unscaled integer value of a decimal (or integral) column with the given scale."""
    if scale == 0:
        return c.cast(_INT)
    return (c.cast(f"decimal(38,{scale})") * F.lit(Decimal(10) ** scale)).cast(_INT)


def floor_div(a: Column, b: Column) -> Column:
    """floor(a / b) for non-negative integral decimals a and positive b, exactly."""
    return ((a - a % b) / b).cast(_INT)


def div_round(num: Column, den: Column, digits: int = 2, num_scale: int = 0,
              den_scale: int = 0) -> Column:
    """round(num / den, digits), half away from zero, exact; NULL when den is 0 or NULL.

    ``num_scale`` / ``den_scale`` are the decimal scales of the inputs
    (0 for integral columns such as counts).
    """
    n = _as_int(num, num_scale)
    d = _as_int(den, den_scale)
    shift = den_scale - num_scale + digits
    if shift >= 0:
        n = n * F.lit(Decimal(10) ** shift).cast(_INT)
    else:
        d = d * F.lit(Decimal(10) ** (-shift)).cast(_INT)
    an, ad = F.abs(n), F.abs(d)
    q = floor_div(an * 2 + ad, ad * 2)
    sign = (F.signum(n) * F.signum(d)).cast("int")
    step = F.lit(Decimal(1).scaleb(-digits)) if digits > 0 else F.lit(Decimal(1))
    val = (q * sign).cast(_INT) * step
    return F.when(d != 0, val.cast(f"decimal(38,{max(digits, 0)})"))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double from exact decimal aggregates; NULL when den is 0.

    Converting exact sums to double and dividing once gives the same bits on
    every IEEE engine, unlike summing doubles in partition order.
    """
    return F.try_divide(num.cast("double"), den.cast("double"))
