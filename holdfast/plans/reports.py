"""SQL reports on the engineered table, each from one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import dollars, fraction, round_away, signed_text
from holdfast.operators import features as feats
from holdfast.operators import rollup as r


def churn_kpis(df: DataFrame) -> DataFrame:
    return r.tally(df, [], months="tenure").select(
        r.customers("total_customers"),
        r.churned("total_churned"),
        r.retained("total_retained"),
        r.churn_pct(2),
        r.money("mrr", "total_mrr"),
        r.mean_charge(),
        r.money("lost", "monthly_revenue_lost"),
        _lost_share(),
        r.mean("months_churned", 1, "avg_tenure_churned_months"),
        r.mean("months_kept", 1, "avg_tenure_retained_months"),
    )


def _lost_share():
    return round_away(F.try_divide(dollars("lost"), dollars("mrr")) * 100, 2).alias("revenue_at_risk_pct")


def churn_by_contract(df: DataFrame) -> DataFrame:
    return (
        r.tally(df, ["contract", "contract_risk_score"], months="tenure")
        .select(
            "contract",
            "contract_risk_score",
            r.customers("total_customers"),
            r.churned(),
            r.retained(),
            r.churn_pct(),
            r.mean_charge(),
            r.money("mrr", "total_mrr"),
            r.money("lost", "revenue_at_risk"),
            r.mean("months", 1, "avg_tenure_months"),
            r.mean("months_churned", 1, "avg_tenure_churned"),
        )
        .orderBy(F.desc("contract_risk_score"), "contract")
    )


def churn_by_tenure(df: DataFrame) -> DataFrame:
    return (
        r.tally(df, ["tenure_segment"], months="tenure")
        .select(
            "tenure_segment",
            r.position(F.col("tenure_segment"), spec.TENURE_LABELS).alias("segment_order"),
            r.customers("total_customers"),
            r.churned(),
            r.retained(),
            r.churn_pct(),
            F.col("months_min").alias("min_tenure_months"),
            F.col("months_max").alias("max_tenure_months"),
            r.mean("months", 1, "avg_tenure_months"),
            r.mean_charge(),
            r.money("mrr", "segment_mrr"),
            r.money("lost", "segment_revenue_at_risk"),
        )
        .orderBy("segment_order")
    )


def revenue_at_risk(df: DataFrame, k: int = 20) -> DataFrame:
    keys = ["tenure_segment", "contract", "monthly_charges_tier"]
    return (
        r.tally(df, keys)
        .filter(F.col("churned") > 0)
        .select(
            *keys,
            r.customers(),
            r.churned(),
            r.churn_pct(),
            r.money("lost", "revenue_lost_monthly"),
            r.mean_charge("avg_churned_charge", "lost", "lost_n"),
            r.money("lost", "revenue_lost_annual", times=12),
        )
        .orderBy(F.desc("revenue_lost_monthly"), *keys)
        .limit(k)
    )


def service_usage(df: DataFrame) -> DataFrame:
    """Adoption and churn with and without each service.

    Records are first counted per combination of the flags, so the unpivot sees a few
    thousand rows at most instead of ten per record.
    """
    flags = feats.service_flags(df, keep=[spec.LABEL])
    combos = flags.groupBy(*flags.columns).agg(F.count(F.lit(1)).alias("n"))
    long = feats.services_long(combos, keep=[spec.LABEL, "n"])
    on, known = F.col("subscribed") == 1, F.col(spec.LABEL).isNotNull()
    gone = F.col(spec.LABEL) * F.col("n")
    sums = long.groupBy("service").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(on, F.col("n")).otherwise(0)).alias("subscribers"),
        F.sum(F.when(on & known, F.col("n"))).alias("with_n"),
        F.sum(F.when(on, gone)).alias("with_churned"),
        F.sum(F.when(~on & known, F.col("n"))).alias("without_n"),
        F.sum(F.when(~on, gone)).alias("without_churned"),
    )
    with_pct = fraction("with_churned", "with_n") * 100
    without_pct = fraction("without_churned", "without_n") * 100
    return sums.select(
        "service",
        "subscribers",
        round_away(fraction("subscribers", "n") * 100, 1).alias("adoption_rate_pct"),
        round_away(with_pct, 1).alias("churn_rate_with_service"),
        round_away(without_pct, 1).alias("churn_rate_without_service"),
        round_away(with_pct - without_pct, 1).alias("churn_lift_pct"),
    ).orderBy("churn_lift_pct", "service")


def customer_segments(df: DataFrame) -> DataFrame:
    keys = ["customer_segment", "value_tier", "risk_tier"]
    return (
        r.tally(feats.segments(df), keys, months="tenure", services="num_services")
        .select(
            *keys,
            r.customers(),
            r.churn_pct(alias="actual_churn_rate_pct"),
            r.churned("actually_churned"),
            r.mean_charge(),
            r.money("mrr", "total_segment_mrr"),
            r.money("lost", "revenue_lost"),
            r.mean("services", 1, "avg_services"),
            r.mean("months", 1, "avg_tenure_months"),
        )
        .orderBy(F.desc("total_segment_mrr"), *keys)
    )


# Dimensions of the retention report.
RETENTION_DIMENSIONS = ["payment_method", "paperless_billing", "senior_citizen", "gender", "dependents"]


def retention_analysis(df: DataFrame, dimensions=RETENTION_DIMENSIONS) -> DataFrame:
    return (
        r.by_dimension(df, dimensions)
        .select("dimension", "dimension_value", r.customers(), r.churned(), r.churn_pct(), r.mean_charge())
        .orderBy(F.desc("churn_rate_pct"), "dimension", "dimension_value")
    )


def service_effect_split(usage: DataFrame) -> DataFrame:
    """Services that lower or raise churn, with signed label text."""
    lift = F.col("churn_lift_pct")
    return (
        usage.filter(lift != 0)
        .select(
            F.when(lift < 0, "protective").otherwise("risky").alias("effect"),
            "service",
            "churn_lift_pct",
            F.concat_ws(": ", "service", signed_text(lift)).alias("label"),
        )
        .orderBy("churn_lift_pct", "service")
    )


def headline_insights(df: DataFrame, monthly: str = "Month-to-month", newest: str = "New") -> DataFrame:
    """Headline figures of the reports as (insight, value, label) rows, from two scans."""
    marked = df.withColumns({"_monthly": F.col("contract") == monthly, "_newest": F.col("tenure_segment") == newest})
    parts = r.tally(marked, ["_monthly", "_newest"], months="tenure")
    names = ["churned", "flagged", "mrr", "lost", "months_churned_sum", "months_churned_n", "months_kept_sum", "months_kept_n"]
    part = lambda flag, name: F.sum(F.when(F.col(flag), F.col(name))).alias(f"{flag}_{name}")
    totals = parts.agg(
        *[F.sum(c).alias(c) for c in names],
        *[part(flag, name) for flag in ("_monthly", "_newest") for name in ("churned", "flagged")],
    )
    mean = lambda group: round_away(fraction(f"months_{group}_sum", f"months_{group}_n"), 1)
    part_pct = lambda flag: round_away(fraction(f"{flag}_churned", f"{flag}_flagged") * 100, 1)
    lost = round_away(dollars("lost"), 2)
    figures = [
        ("churn_rate_pct", r.churn_pct(2), None),
        ("monthly_revenue_lost", lost, None),
        ("annual_revenue_lost", round_away(lost * 12, 2), None),
        ("revenue_at_risk_pct", _lost_share(), None),
        ("avg_tenure_churned_months", mean("churned"), None),
        ("avg_tenure_retained_months", mean("kept"), None),
        ("tenure_gap_months", round_away(mean("kept") - mean("churned"), 1), None),
        ("month_to_month_churn_pct", part_pct("_monthly"), monthly),
        ("new_customer_churn_pct", part_pct("_newest"), newest),
    ]
    rows = [
        F.struct(F.lit(name).alias("insight"), value.alias("value"), F.lit(label).cast("string").alias("label"))
        for name, value, label in figures
    ]
    protective = service_usage(df).filter(F.col("churn_lift_pct") < 0).orderBy("churn_lift_pct", "service").limit(1)
    return (
        totals.select(F.inline(F.array(*rows)))
        .filter(F.col("value").isNotNull())
        .unionByName(
            protective.select(
                F.lit("most_protective_service").alias("insight"),
                F.col("churn_lift_pct").alias("value"),
                F.col("service").alias("label"),
            )
        )
    )


def top_revenue_loss(report: DataFrame, k: int = 10, head: int = 3) -> DataFrame:
    """First k rows of the revenue report with their label, and the total of the first few."""
    order = [F.desc("revenue_lost_monthly"), "tenure_segment", "contract", "monthly_charges_tier"]
    top = report.orderBy(*order).limit(k)
    ranked = top.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    head_cents = F.sum(F.when(F.col("place") <= head, F.round(F.col("revenue_lost_monthly") * 100).cast("bigint")))
    return ranked.select(
        "place",
        F.concat_ws(" / ", "tenure_segment", "contract").alias("segment"),
        "monthly_charges_tier",
        "churn_rate_pct",
        "revenue_lost_monthly",
        dollars(head_cents.over(Window.partitionBy())).alias("head_total"),
    )
