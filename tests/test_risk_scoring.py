import pytest
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.operators import features as feats
from holdfast.operators import quality, risk, scoring
from holdfast.plans.marts import stg_customers
from tests.fixtures import clean_rows, requests, values


def staged(spark, *changes):
    return stg_customers(feats.engineer(clean_rows(spark, *changes), [35, 65, 89]))


def term(spark, name, *changes):
    df = staged(spark, *changes)
    return values(df.select("customer_id", risk.risk_terms()[name].alias("t")), "t")


def test_score_terms(spark):
    assert term(spark, "tenure", *[{"tenure": m} for m in (6, 7, 12, 13, 24, 25)]) == [30, 20, 20, 10, 10, 0]
    assert term(spark, "charges", *[{"monthly_charges": c} for c in (89.01, 89.0, 65.01, 65.0)]) == [15, 8, 8, 0]
    assert term(spark, "contract", *[{"contract": c} for c in spec.CONTRACTS]) == [30, 15, 0]
    assert term(spark, "services", {c: "Yes" for c in spec.ADDON_SERVICES}, {}) == [-15, -6]
    assert term(spark, "fiber", {}, {"internet_service": "DSL"}) == [10, 0]
    assert term(spark, "support", {c: "Yes" for c in spec.SUPPORT_SERVICES}) == [-15]


def test_score_bounds(spark):
    none = {"multiple_lines": "No", "online_backup": "No"}
    best = {c: "Yes" for c in spec.ADDON_SERVICES} | {"contract": "Two year", "tenure": 70, "internet_service": "DSL", "monthly_charges": 20.0}
    df = risk.customer_risk(staged(spark, {"tenure": 1, "monthly_charges": 100.0, **none}, best))
    assert values(df, "risk_score") == [85, 0]


@pytest.mark.parametrize("contract,months,want", [
    ("Month-to-month", 12, "Critical"), ("Month-to-month", 24, "High"), ("One year", 12, "High"),
    ("Month-to-month", 25, "Medium"), ("One year", 13, "Low"), ("Two year", 1, "Low"),
])
def test_risk_category(spark, contract, months, want):
    assert values(risk.customer_risk(staged(spark, {"contract": contract, "tenure": months})), "risk_category") == [want]


def test_value_tier(spark):
    cases = [(89.01, 25), (89.01, 24), (65.01, 1), (65.0, 72)]
    df = risk.customer_risk(staged(spark, *[{"monthly_charges": c, "tenure": t} for c, t in cases]))
    assert values(df, "value_tier") == ["High Value", "Mid Value", "Mid Value", "Low Value"]


def test_risk_actions(spark):
    quiet = {"multiple_lines": "No", "online_backup": "No"}
    cases = [
        ({"tenure": 6}, "m2m_first_months"), ({"tenure": 12}, "m2m_first_year"), ({"tenure": 13}, "m2m_fiber"),
        ({"tenure": 13, "internet_service": "DSL", "monthly_charges": 89.01}, "m2m_high_bill"),
        ({"tenure": 13, "internet_service": "DSL"}, "m2m_other"),
        ({"contract": "Two year", **quiet}, "few_services"),
        ({"contract": "Two year", "tech_support": "Yes"}, "steady"),
    ]
    df = staged(spark, *[c for c, _ in cases]).select("customer_id", risk.risk_action_code().alias("code"))
    assert values(df, "code") == [w for _, w in cases]
    assert set(spec.RISK_ACTIONS) == {w for _, w in cases}


def test_probability_tiers(spark):
    df = spark.createDataFrame([(p,) for p in (0.7, 0.6999, 0.5, 0.4999, 0.3, 0.2999, None)], "p double")
    got = [r[0] for r in df.select(scoring.risk_tier(F.col("p"))).collect()]
    assert got == ["Critical", "High", "High", "Medium", "Medium", "Low", None]


def test_recommendation_order(spark):
    cases = [
        ({"p": 0.29}, "low_risk"), ({"tenure": 6}, "m2m_first_months"), ({"tenure": 12}, "m2m_first_year"),
        ({"tenure": 13, "monthly_charges": 75.01}, "m2m_fiber_high_bill"), ({"tenure": 13, "monthly_charges": 75.0}, "m2m_other"),
        ({"contract": "One year"}, "no_support"), ({"contract": "One year", "support_score": 1, "num_services": 2}, "few_services"),
        ({"contract": "One year", "support_score": 1, "num_services": 3}, "watch"),
    ]
    df = requests(spark, *[{k: v for k, v in c.items() if k != "p"} for c, _ in cases])
    p = F.when(F.col("customer_id") == "A0", 0.29).otherwise(0.725)
    out = df.withColumn("p", p).withColumn("code", scoring.score_action_code(F.col("p")))
    assert values(out, "code") == [w for _, w in cases]
    assert values(out.withColumn("t", scoring.recommendation(F.col("code"), F.col("p"))), "t")[-1] == "No other rule applies, score 72%"
    assert set(spec.SCORE_ACTIONS) == {w for _, w in cases}


def test_reply_fields_and_summary(spark):
    df = requests(spark, {}, {}, {}).withColumn("probability", F.element_at(F.array(F.lit(0.73456), F.lit(0.5), F.lit(0.1)), F.substring("customer_id", 2, 1).cast("int") + 1))
    df = df.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    out = scoring.reply(df, reference_pct=F.lit(26.5))
    assert values(out, "churn_probability") == [0.7346, 0.5, 0.1]
    assert values(out, "retention_probability") == [0.2654, 0.5, 0.9]
    assert values(out, "risk_score_pct") == [73.5, 50.0, 10.0]
    assert values(out, "delta_pct") == [47.0, 23.5, -16.5]
    assert values(out, "risk_tier") == ["Critical", "High", "Low"]
    assert tuple(scoring.summary(out).first()) == (3, 1, 2, 0.4449, 1, 1)
    assert tuple(scoring.highest(df).first()) == ("A0", 0.73456)


def test_validation_lists_every_error(spark):
    bad = spark.createDataFrame([("Z", 999, "Weekly")], "customer_id string, tenure int, contract string")
    row = quality.validate(bad).select("errors", "is_valid").first()
    found = {e["field"]: e["rule"] for e in row["errors"]}
    assert not row["is_valid"] and len(found) == 25
    assert found["tenure"] == "range" and found["contract"] == "one_of" and found["gender"] == "missing"


def test_validation_bounds_and_text_fields(spark):
    cases = [{}, {"tenure": 73}, {"monthly_charges": -1.0}, {"num_services": 8}, {"total_charges": float("nan")}, {"avg_monthly_spend": 79.996}]
    out = quality.validate(requests(spark, *cases)).withColumn("e", quality.error_text())
    assert values(out, "e") == ["", "tenure:range", "monthly_charges:range", "num_services:range", "total_charges:range", ""]
    assert values(out, "avg_monthly_spend")[-1] == 80.0
    text = requests(spark, {}, {}, {}).withColumn("tenure", F.element_at(F.array(F.lit("12"), F.lit("twelve"), F.lit("12.5")), F.substring("customer_id", 2, 1).cast("int") + 1))
    out = quality.validate(text).withColumn("e", quality.error_text())
    assert values(out, "e") == ["", "tenure:type", "tenure:type"]
    assert values(out, "tenure") == [12, None, None]


def test_empty_batch_is_refused(spark):
    with pytest.raises(ValueError):
        quality.require_rows(requests(spark))
    assert quality.require_rows(requests(spark, {})).count() == 1


def test_each_data_rule_finds_its_rows(spark):
    df = spark.createDataFrame(
        [("a", "One year", 0), ("a", "Weekly", 1), (None, "Two year", 2), ("b", None, None)],
        "customer_id string, contract string, churn_flag int",
    )
    rules = [("customer_id", "unique", None), ("customer_id", "not_null", None), ("contract", "accepted_values", spec.CONTRACTS),
             ("churn_flag", "accepted_values", [0, 1]), ("churn_flag", "not_null", None)]
    found = {(r.column_name, r.rule): r.failures for r in quality.check_table(df, "t", rules).collect()}
    assert found == {("customer_id", "unique"): 1, ("customer_id", "not_null"): 1, ("contract", "accepted_values"): 1,
                     ("churn_flag", "accepted_values"): 1, ("churn_flag", "not_null"): 1}
    with pytest.raises(ValueError, match="5 data checks"):
        quality.require_checks(quality.check_table(df, "t", rules))


def test_manifest_names_what_is_short(spark):
    outputs = quality.output_manifest({"full": (spark.range(3), 1), "empty": (spark.range(0), 1)})
    assert {r["output"]: r["ok"] for r in outputs.collect()} == {"full": True, "empty": False}
    with pytest.raises(ValueError, match="empty"):
        quality.require_outputs(outputs)
