"""Grouped churn measures.

``tally`` reduces records to mergeable integer totals; the report functions turn totals
into rates and money. Integer totals add up to the same result in any order, so a report
can be built from finer groups without going back to the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import cents, dollars, fraction, round_away


def _flagged(flag: str, value: int = 1) -> Column:
    return F.col(flag) == value


def tally(
    df: DataFrame,
    keys: Sequence[str],
    flag: str = spec.LABEL,
    charge: str = "monthly_charges",
    months: str | None = None,
    services: str | None = None,
) -> DataFrame:
    """Totals per group.

    ``n`` rows, ``churned``, ``charged`` rows with a charge, ``mrr`` and ``lost`` in cents,
    ``lost_n`` churned rows with a charge; with ``months`` and ``services`` their sums
    (all, churned, kept), row counts and range.
    """
    gone, kept = _flagged(flag), _flagged(flag, 0)
    money = cents(charge)
    totals = [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(flag).cast("bigint")).alias("churned"),
        F.count(flag).alias("flagged"),
        F.count(charge).alias("charged"),
        F.sum(money).alias("mrr"),
        F.sum(F.when(gone, money).otherwise(0)).alias("lost"),
        F.count(F.when(gone, F.col(charge))).alias("lost_n"),
    ]
    for name, column in (("months", months), ("services", services)):
        if column is None:
            continue
        value = F.col(column).cast("bigint")
        totals += [
            F.sum(value).alias(f"{name}_sum"),
            F.count(column).alias(f"{name}_n"),
            F.sum(F.when(gone, value)).alias(f"{name}_churned_sum"),
            F.count(F.when(gone, value)).alias(f"{name}_churned_n"),
            F.sum(F.when(kept, value)).alias(f"{name}_kept_sum"),
            F.count(F.when(kept, value)).alias(f"{name}_kept_n"),
            F.min(column).alias(f"{name}_min"),
            F.max(column).alias(f"{name}_max"),
        ]
    return df.groupBy(*keys).agg(*totals)


def customers(alias: str = "customers") -> Column:
    return F.col("n").alias(alias)


def churned(alias: str = "churned") -> Column:
    return F.col("churned").alias(alias)


def retained(alias: str = "retained") -> Column:
    return (F.col("n") - F.col("churned")).alias(alias)


def churn_rate() -> Column:
    return fraction("churned", "flagged")


def churn_pct(digits: int = 1, alias: str = "churn_rate_pct") -> Column:
    return round_away(churn_rate() * 100, digits).alias(alias)


def money(total: str, alias: str, times: int = 1) -> Column:
    return round_away(dollars(F.col(total) * times), 2).alias(alias)


def mean_charge(alias: str = "avg_monthly_charges", total: str = "mrr", count: str = "charged") -> Column:
    return round_away(F.try_divide(dollars(total), F.col(count).cast("double")), 2).alias(alias)


def mean(name: str, digits: int, alias: str) -> Column:
    return round_away(fraction(f"{name}_sum", f"{name}_n"), digits).alias(alias)


def by_dimension(
    df: DataFrame, dimensions: Sequence[str], flag: str = spec.LABEL, charge: str = "monthly_charges"
) -> DataFrame:
    """Totals per value of each dimension as (dimension, dimension_value, totals).

    One scan: records are first reduced to the value combinations of all dimensions, and
    only those rows are unpivoted and added up.
    """
    combos = tally(df, dimensions, flag, charge)
    totals = [c for c in combos.columns if c not in dimensions]
    sides = combos.select(
        *totals,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("dimension_value"))
                    for d in dimensions
                ]
            )
        ),
    )
    return sides.groupBy("dimension", "dimension_value").agg(*[F.sum(c).alias(c) for c in totals])


def position(c: Column, labels: Sequence[str]) -> Column:
    """1-based place of a label in its display order."""
    out = F
    for i, label in enumerate(labels, 1):
        out = out.when(c == label, F.lit(i))
    return out
