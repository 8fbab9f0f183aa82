"""Money sums and rounding that do not depend on the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_away(c: Column | str, digits: int) -> Column:
    """Scale, round half away from zero, unscale: what a C ``round`` gives on doubles."""
    x = _col(c).cast("double")
    scale = float(10**digits)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale


def cents(c: Column | str) -> Column:
    """Money as whole cents. BIGINT sums are exact in any order and stay in generated code."""
    x = _col(c)
    return (F.signum(x) * F.floor(F.abs(x) * 100.0 + 0.5)).cast("bigint")


def dollars(c: Column | str) -> Column:
    return _col(c).cast("double") / 100.0


def fraction(numerator: Column | str, denominator: Column | str) -> Column:
    """Ratio as DOUBLE, NULL when the denominator is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
