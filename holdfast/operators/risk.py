"""Rule-based customer risk."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import first_match


def risk_terms() -> dict[str, Column]:
    """Points each feature adds to the risk score, by feature."""
    months, charge = F.col("tenure"), F.col("monthly_charges")
    # Points and bounds of the score.
    return {
        "contract": (F.col("contract_risk_score") - 1) * 15,
        "tenure": first_match([(months <= 6, F.lit(30)), (months <= 12, F.lit(20)), (months <= 24, F.lit(10))], F.lit(0)),
        "fiber": F.col("has_fiber") * 10,
        "charges": first_match([(charge > 89, F.lit(15)), (charge > 65, F.lit(8))], F.lit(0)),
        "support": F.col("support_score") * -5,
        "services": -F.least(F.col("num_services") * 3, F.lit(15)),
    }


def risk_score(terms: Mapping[str, Column] | None = None, low: int = 0, high: int = 100) -> Column:
    """Sum of the terms, kept within the bounds."""
    total = F.lit(0)
    for term in (terms or risk_terms()).values():
        total = total + term
    return F.least(F.lit(high), F.greatest(F.lit(low), total))


def value_tier() -> Column:
    charge = F.col("monthly_charges")
    return first_match(
        [((charge > 89) & (F.col("tenure") > 24), "High Value"), (charge > 65, "Mid Value")], "Low Value"
    )


def risk_category() -> Column:
    contract, months = F.col("contract_risk_score"), F.col("tenure")
    rules = [
        ((contract == 3) & (months <= 12), "Critical"),
        ((contract == 3) & (months <= 24), "High"),
        ((contract >= 2) & (months <= 12), "High"),
        (contract == 3, "Medium"),
    ]
    return first_match(rules, "Low")


def risk_action_code() -> Column:
    monthly = F.col("contract_risk_score") == 3
    months = F.col("tenure")
    rules = [
        (monthly & (months <= 6), "m2m_first_months"),
        (monthly & (months <= 12), "m2m_first_year"),
        (monthly & (F.col("has_fiber") == 1), "m2m_fiber"),
        (monthly & (F.col("monthly_charges") > 89), "m2m_high_bill"),
        (monthly, "m2m_other"),
        ((F.col("support_score") == 0) & (F.col("num_services") <= 2), "few_services"),
    ]
    return first_match(rules, "steady")


def action_text(code: Column, texts: Mapping[str, str]) -> Column:
    return first_match([(code == k, F.lit(v)) for k, v in texts.items()])


# Columns the risk table carries over.
RISK_BASE = [
    "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure",
    "tenure_segment", "contract", "contract_risk_score", "internet_service",
    "monthly_charges", "total_charges", "num_services", "support_score", "has_fiber",
    "payment_method", "churn_flag", "churn_label",
]


def customer_risk(staged: DataFrame, texts: Mapping[str, str] = spec.RISK_ACTIONS) -> DataFrame:
    """One row per customer: score, tiers, action and campaign label. A narrow projection;
    order it where it is shown, not here."""
    scored = staged.select(
        *RISK_BASE,
        risk_score().alias("risk_score"),
        value_tier().alias("value_tier"),
        risk_category().alias("risk_category"),
        action_text(risk_action_code(), texts).alias("recommended_action"),
    )
    return scored.withColumn("campaign_segment", F.concat_ws(" / ", "value_tier", "risk_category"))


def top_customers(risk: DataFrame, categories=("Critical", "High"), k: int = 5) -> DataFrame:
    return (
        risk.filter(F.col("risk_category").isin(*categories))
        .select("customer_id", "tenure", "contract", "risk_score", "risk_category", "recommended_action")
        .orderBy(F.desc("risk_score"), "customer_id")
        .limit(k)
    )
