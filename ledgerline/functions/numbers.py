"""Numeric column helpers (MTH-*, STR-4).

Money is compared in exact decimals: deviations are worked out in whole millionths, so
a half cent is a half cent and nothing saturates below 10 ** 26.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: decimal places that amounts are compared with
SCALE = 6


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(x) -> Column:
    """Amount in whole millionths, as an integer decimal."""
    return (as_col(x).cast(f"decimal(38,{SCALE})") * F.lit(10 ** SCALE)).cast("decimal(38,0)")


def round_half_away(x, digits: int = 2) -> Column:
    """Round half away from zero (NUMERIC cast): exact for decimals, by the shortest text of a double."""
    return F.round(as_col(x), digits)


def round_half_even(x, digits: int = 2) -> Column:
    """Round a double half to even in binary (MTH-8): scale, nearest integer, scale back."""
    k = float(10 ** digits)
    return F.rint(as_col(x).cast("double") * k) / k


def pct_deviation(a, b, digits: int = 2) -> Column:
    """``(a - b) / a * 100`` rounded half away from zero; null when ``a`` is 0 or null.

    Exact: the quotient of two integers is rounded by its remainder, not by a division
    that was rounded before.
    """
    return units_deviation(units(a), units(b), digits)


def units_deviation(ua: Column, ub: Column, digits: int = 2) -> Column:
    """``pct_deviation`` of two amounts in ``units``."""
    up = F.abs(ua - ub) * F.lit(10 ** (digits + 2))
    down = F.abs(ua)
    twice = (up * 2 + down).cast("decimal(38,0)")
    by = F.nullif((down * 2).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    whole = ((twice - F.pmod(twice, by)) / by).cast("decimal(38,0)")
    sign = F.when((ua >= ub) == (ua > 0), F.lit(1)).otherwise(F.lit(-1))
    return (whole * sign * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(38,{digits})")


def deviates(a, b, tol: float) -> Column:
    """Whether ``|a - b| / |a| * 100`` is more than ``tol`` (exact; null when ``a`` is null or 0)."""
    return units_deviate(units(a), units(b), tol)


def units_deviate(ua: Column, ub: Column, tol: float) -> Column:
    """``deviates`` of two amounts in ``units``."""
    return F.when(ua != 0, F.abs(ua - ub) * 100 > F.abs(ua) * F.lit(Decimal(str(tol))))


def plain_text(x) -> Column:
    """A double's shortest text with all its digits: 12.0, 0.0005, 1e-05, 1e+16.

    Plain between 1e-4 and 1e16, with an exponent beyond, as the reference writes floats.
    """
    d = as_col(x).cast("double")
    s = d.cast("string")
    digits = F.regexp_replace(s.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    digits = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    power = F.substring_index(s, "E", -1)
    tail = F.concat(F.when(power.startswith("-"), F.lit("-")).otherwise(F.lit("+")),
                    F.lpad(F.replace(power, F.lit("-"), F.lit("")), 2, "0"))
    exponent = F.concat(F.regexp_replace(F.substring_index(s, "E", 1), r"\.0$", ""), F.lit("e"), tail)
    a = F.abs(d)
    return F.when((a == 0) | a.between(1e-4, 9999999999999998.0), digits).when(s.contains("E"), exponent).otherwise(s)


def decimal_comma(x) -> Column:
    """Number as text with a decimal comma (STR-4)."""
    return F.translate(plain_text(x), ".", ",")
