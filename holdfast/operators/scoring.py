"""Risk tiers, recommendations and the score reply."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import band, first_match, round_away
from holdfast.operators.risk import action_text, risk_score


def risk_tier(probability: Column, tiers: Sequence = spec.PROBABILITY_TIERS) -> Column:
    return band(probability, tiers, descending=True)


def score_action_code(probability: Column) -> Column:
    monthly = F.col("contract") == "Month-to-month"
    months = F.col("tenure")
    fiber = F.col("internet_service") == "Fiber optic"
    # Order and bounds of the rules.
    rules = [
        (probability < 0.30, "low_risk"),
        (monthly & (months <= 6), "m2m_first_months"),
        (monthly & (months <= 12), "m2m_first_year"),
        (monthly & fiber & (F.col("monthly_charges") > 75), "m2m_fiber_high_bill"),
        (monthly, "m2m_other"),
        (F.col("support_score") == 0, "no_support"),
        (F.col("num_services") <= 2, "few_services"),
    ]
    return first_match(rules, "watch")


def recommendation(code: Column, probability: Column, texts: Mapping[str, str] = spec.SCORE_ACTIONS) -> Column:
    """Text of the action; ``{pct}`` becomes the probability in whole percent."""
    pct = F.bround(probability * 100, 0).cast("int").cast("string")
    return F.replace(action_text(code, texts), F.lit("{pct}"), pct)


def rule_probability(df: DataFrame, score: str = "probability", prediction: str = "prediction") -> DataFrame:
    """The rule-based risk score read as a probability, with its class."""
    p = risk_score() / 100.0
    return df.withColumn(score, p).withColumn(prediction, (p > 0.5).cast("int"))


def reply(
    scored: DataFrame,
    key: str = spec.KEY,
    probability: str = "probability",
    prediction: str = "prediction",
    version: str = spec.MODEL_VERSION,
    texts: Mapping[str, str] = spec.SCORE_ACTIONS,
    reference_pct: Column | None = None,
) -> DataFrame:
    """Output fields per record, under the caller's key and for any number of records.

    With ``reference_pct`` the distance of the score from that rate is added.
    """
    p = F.col(probability)
    code = score_action_code(p)
    columns = [
        F.col(prediction).cast("int").alias("churn_prediction"),
        round_away(p, 4).alias("churn_probability"),
        round_away(1 - p, 4).alias("retention_probability"),
        risk_tier(p).alias("risk_tier"),
        round_away(p * 100, 1).alias("risk_score_pct"),
        code.alias("action_code"),
        recommendation(code, p, texts).alias("recommendation"),
        F.lit(version).alias("model_version"),
    ]
    if reference_pct is not None:
        columns.append(round_away(p * 100 - reference_pct, 1).alias("delta_pct"))
    return scored.select(key, *columns)


def summary(replies: DataFrame) -> DataFrame:
    """Counts and mean of the replies; the mean is taken over the rounded probabilities,
    added up as whole ten-thousandths."""
    parts = F.sum(F.floor(F.col("churn_probability") * 10000 + 0.5))
    return replies.agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.sum("churn_prediction").alias("predicted_churn"),
        F.sum(1 - F.col("churn_prediction")).alias("predicted_retain"),
        round_away(parts / 10000.0 / F.count(F.lit(1)), 4).alias("avg_churn_prob"),
        F.count_if(F.col("risk_tier") == "Critical").alias("critical_count"),
        F.count_if(F.col("risk_tier") == "High").alias("high_count"),
    )


def highest(df: DataFrame, score: str = "probability", key: str = spec.KEY) -> DataFrame:
    """Key and score of the highest-scored record, the smallest key among equals."""
    first = F.min(F.struct((-F.col(score)).alias("s"), F.col(key).alias("k")))
    return df.agg(first.alias("top")).select(F.col("top.k").alias(key), (-F.col("top.s")).alias(score))
