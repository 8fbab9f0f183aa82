"""Aggregates behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import cents, dollars, fraction
from holdfast.operators import rollup as r

# Dimensions shown as outcome rates.
RATE_DIMENSIONS = ["tenure_segment", "contract", "senior_citizen", "dependents", "payment_method"]


def rate_by_dimension(df: DataFrame, dimensions: Sequence[str] = RATE_DIMENSIONS) -> DataFrame:
    """Mean and count of the outcome per value of each dimension."""
    return (
        r.by_dimension(df, dimensions)
        .select("dimension", "dimension_value", r.churn_rate().alias("churn_rate"), F.col("flagged").alias("customers"))
        .orderBy("dimension", F.desc("churn_rate"), "dimension_value")
    )


def overview_cards(df: DataFrame) -> DataFrame:
    ratio = lambda name, alias: fraction(f"{name}_sum", f"{name}_n").alias(alias)
    return r.tally(df, [], months="tenure", services="num_services").select(
        r.customers("total_customers"),
        r.churned("churned"),
        r.churn_rate().alias("churn_rate"),
        dollars("mrr").alias("mrr"),
        dollars("lost").alias("lost_mrr"),
        dollars(F.col("lost") * 12).alias("lost_mrr_annual"),
        fraction("lost", "mrr").alias("lost_share"),
        ratio("months_churned", "avg_tenure_churned"),
        ratio("months_kept", "avg_tenure_retained"),
        ratio("services_churned", "avg_services_churned"),
        ratio("services_kept", "avg_services_retained"),
    )


def revenue_by_segment(df: DataFrame) -> DataFrame:
    return (
        r.tally(df, ["tenure_segment"])
        .select(
            "tenure_segment",
            r.position(F.col("tenure_segment"), spec.TENURE_LABELS).alias("segment_order"),
            dollars("mrr").alias("total_mrr"),
            dollars("lost").alias("lost_mrr"),
            r.customers(),
            r.churned(),
        )
        .orderBy("segment_order")
    )


def revenue_by_contract(df: DataFrame) -> DataFrame:
    return (
        r.tally(df, ["contract"])
        .select(
            "contract",
            dollars("mrr").alias("total_mrr"),
            dollars("lost").alias("lost_mrr"),
            dollars(F.col("mrr") - F.col("lost")).alias("retained_mrr"),
        )
        .orderBy("contract")
    )


def lost_mrr_share(df: DataFrame) -> DataFrame:
    """Share of each contract in the lost revenue; the window runs over the few grouped rows."""
    return (
        r.tally(df, ["contract"])
        .select("contract", dollars("lost").alias("lost_mrr"), fraction("lost", F.sum("lost").over(Window.partitionBy())).alias("lost_share"))
        .orderBy("contract")
    )


def ingest_summary(clean: DataFrame, raw: DataFrame) -> DataFrame:
    """Totals of the cleaned table, its NULL cells over all columns, and the blank totals of the raw one."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in clean.columns), F.lit(0).cast("bigint"))
    blanks = raw.agg(F.count_if(F.trim("TotalCharges") == "").alias("n")).scalar()
    totals = clean.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(spec.LABEL).alias("churned"),
        F.sum(1 - F.col(spec.LABEL)).alias("retained"),
        F.sum(cents("monthly_charges")).alias("_mrr"),
        F.count("monthly_charges").alias("_charged"),
        F.sum("tenure").alias("_months"),
        F.count("tenure").alias("_months_n"),
        nulls.alias("missing_cells"),
    )
    return totals.select(
        "total_customers",
        "churned",
        "retained",
        F.try_divide(dollars("_mrr"), F.col("_charged").cast("double")).alias("avg_monthly_charges"),
        fraction("_months", "_months_n").alias("avg_tenure"),
        "missing_cells",
        blanks.alias("blank_totals"),
    )


def segment_directory(
    spark: SparkSession,
    segments: DataFrame,
    names: Sequence[str] = spec.SEGMENTS,
    notes: Mapping[str, str] = spec.SEGMENT_NOTES,
) -> DataFrame:
    """Every known segment with its size, 0 where no customer is in it."""
    known = spark.createDataFrame(
        [(i, name, notes[name]) for i, name in enumerate(names, 1)], "place int, customer_segment string, note string"
    )
    sizes = segments.groupBy("customer_segment").agg(F.sum("customers").alias("customers"))
    return known.join(sizes, "customer_segment", "left").select(
        "place", "customer_segment", F.coalesce("customers", F.lit(0)).alias("customers"), "note"
    )


# Shown columns and their headings.
SEGMENT_HEADINGS = {
    "customer_segment": "Segment",
    "customers": "Customers",
    "actual_churn_rate_pct": "Churn %",
    "avg_monthly_charges": "Avg MRR $",
    "total_segment_mrr": "Segment MRR $",
    "revenue_lost": "Revenue Lost $",
    "avg_services": "Avg Services",
}
CONTRACT_HEADINGS = {
    "contract": "Contract",
    "total_customers": "Customers",
    "churned": "Churned",
    "churn_rate_pct": "Churn %",
    "avg_monthly_charges": "Avg Monthly $",
    "revenue_at_risk": "Rev at Risk $",
    "avg_tenure_months": "Avg Tenure (mo)",
}


def display_table(report: DataFrame, headings: Mapping[str, str] = SEGMENT_HEADINGS) -> DataFrame:
    """Known columns that the report has, under their headings."""
    return report.select(*[F.col(c).alias(h) for c, h in headings.items() if c in report.columns])


def segment_table(report: DataFrame) -> DataFrame:
    return display_table(report).orderBy(F.desc("Revenue Lost $"), "Segment")
