"""Ranges of values of about equal size, for work that needs an order but not one task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut_points(value: Column | str, ranges: int) -> Column:
    """Aggregate: values that cut those seen into ``ranges`` parts, from a sketch."""
    return F.percentile_approx(value, F.array(*[F.lit(i / ranges) for i in range(1, ranges)]), 100 * ranges)


def range_of(value: Column, cuts: Column) -> Column:
    """Number of the value's range, from 0; larger values have no smaller one."""
    return F.size(F.filter(cuts, lambda cut: cut < value))
