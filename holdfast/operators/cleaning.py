"""From raw records to typed, consistent ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import code_map, snake_case

# Headers that come without capitals carry no word breaks.
_FLAT_NAMES = {snake_case(c).replace("_", ""): snake_case(c) for c in spec.RAW_COLUMNS}


def clean_name(name: str, aliases: Mapping[str, str] = _FLAT_NAMES) -> str:
    snake = snake_case(name)
    return aliases.get(snake, snake)


def standardise_columns(df: DataFrame, aliases: Mapping[str, str] = _FLAT_NAMES) -> DataFrame:
    """Snake-case column names; positions and values stay."""
    return df.toDF(*[clean_name(c, aliases) for c in df.columns])


def to_number(c: Column) -> Column:
    """Number from text; blanks, words and NaN give NULL."""
    x = F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(x), x)


def fix_types(
    df: DataFrame,
    total: str = "total_charges",
    fallback: str = "monthly_charges",
    senior: str = "senior_citizen",
    outcome: str = "churn",
    flag: str = spec.LABEL,
    months: str = "tenure",
) -> DataFrame:
    """Numeric total with the monthly charge where it is blank, Yes/No senior label, 0/1 outcome flag."""
    return df.withColumns(
        {
            total: F.coalesce(to_number(F.col(total)), F.col(fallback)),
            senior: code_map(F.col(senior), {0: "No", 1: "Yes"}),
            flag: code_map(F.col(outcome), {"Yes": 1, "No": 0}),
            months: F.col(months).cast("int"),
        }
    )


def collapse_placeholders(df: DataFrame, placeholders: Mapping[str, Mapping[str, str]] = spec.PLACEHOLDERS) -> DataFrame:
    """Replace placeholder values, all columns in one projection."""
    return df.withColumns({c: _collapsed(c, values) for c, values in placeholders.items()})


def _collapsed(name: str, values: Mapping[str, str]) -> Column:
    out = F.col(name)
    for found, wanted in values.items():
        out = F.when(F.col(name) == found, wanted).otherwise(out)
    return out


def clean(raw: DataFrame) -> DataFrame:
    """Raw table to the 22 typed columns."""
    return collapse_placeholders(fix_types(standardise_columns(raw)))


def category_audit(raw: DataFrame, placeholders: Mapping[str, Mapping[str, str]] = spec.PLACEHOLDERS) -> DataFrame:
    """Rows per value of each collapsed column, before and after.

    The raw combinations are counted first, so only their few rows are unpivoted.
    """
    columns = list(placeholders)
    combos = standardise_columns(raw).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("before"), _collapsed(c, v).alias("after"))
                for c, v in placeholders.items()
            ]
        )
    )
    sides = combos.select("n", pairs).select(
        "column_name",
        F.inline(
            F.array(
                F.struct(F.col("before").alias("value"), F.col("n").alias("rows_before"), F.lit(0).cast("bigint").alias("rows_after")),
                F.struct(F.col("after").alias("value"), F.lit(0).cast("bigint").alias("rows_before"), F.col("n").alias("rows_after")),
            )
        ),
    )
    return sides.groupBy("column_name", "value").agg(
        F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after")
    )
