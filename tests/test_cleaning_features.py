import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.operators import cleaning
from holdfast.operators import features as feats
from tests.fixtures import clean_rows, values


def raw(spark, *changes):
    base = dict(zip(spec.RAW_COLUMNS, (
        "A", "Male", 0, "No", "No", 5, "Yes", "No", "DSL", "No", "No", "No", "No", "No", "No", "One year", "Yes",
        "Mailed check", 50.0, "250.00", "No"), strict=True))
    rows = [{**base, "customerID": f"A{i}", **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(r[c] for c in spec.RAW_COLUMNS) for r in rows], spec.RAW_SCHEMA)


def test_bad_totals_take_the_monthly_charge(spark):
    out = cleaning.clean(raw(spark, *[{"TotalCharges": t} for t in (" ", "abc", "NaN", " 12.5 ", None)]))
    assert values(out, "total_charges") == [50.0, 50.0, 50.0, 12.5, 50.0]


def test_unknown_codes_become_null(spark):
    out = cleaning.clean(raw(spark, {"SeniorCitizen": 2, "Churn": "Maybe"}, {"SeniorCitizen": 1, "Churn": "Yes"}))
    assert values(out, "senior_citizen") == [None, "Yes"]
    assert values(out, "churn_flag") == [None, 1]
    assert values(out, "churn") == ["Maybe", "Yes"]


def test_placeholders_collapse_only_in_their_columns(spark):
    out = cleaning.clean(raw(spark, {"TechSupport": "No internet service", "MultipleLines": "No phone service", "Partner": "No internet service"}))
    assert out.select("tech_support", "multiple_lines", "partner").first() == ("No", "No", "No internet service")


@pytest.mark.parametrize("header", ["customerID", "customerid", "CustomerID"])
def test_header_variants(spark, header):
    assert cleaning.clean_name(header) == "customer_id"
    assert cleaning.clean_name("streamingtv") == cleaning.clean_name("StreamingTV") == "streaming_tv"
    assert spark.createDataFrame([("x",)], [header]).transform(cleaning.standardise_columns).columns == ["customer_id"]


def test_category_audit_counts(spark):
    audit = cleaning.category_audit(raw(spark, {"TechSupport": "No internet service"}, {"TechSupport": "No"}, {"TechSupport": "Yes"}))
    found = {(r.column_name, r.value): (r.rows_before, r.rows_after) for r in audit.collect()}
    assert found[("tech_support", "No internet service")] == (1, 0)
    assert found[("tech_support", "No")] == (1, 2)
    assert found[("tech_support", "Yes")] == (1, 1)


def test_tenure_bands(spark):
    months = [0, 6, 7, 12, 13, 24, 25, 48, 49, 72]
    df = feats.engineer(clean_rows(spark, *[{"tenure": m} for m in months]), [1, 2, 3])
    want = ["New", "New", "Growing", "Growing", "Established", "Established", "Loyal", "Loyal", "Champion", "Champion"]
    assert values(df.orderBy("tenure"), "tenure_segment", order="tenure") == want


def test_charge_tier_edges(spark):
    df = feats.engineer(clean_rows(spark, *[{"monthly_charges": c} for c in (10.0, 20.0, 30.0, 30.01, None)]), [10, 20, 30])
    assert values(df, "monthly_charges_tier") == ["Low", "Mid", "High", "Premium", None]


def test_quartiles_interpolate_and_arrive_without_a_join(spark):
    df = clean_rows(spark, *[{"monthly_charges": float(c)} for c in (10, 20, 30, 40, 40, 40, 100)])
    assert tuple(feats.charge_thresholds(df).first()) == (25.0, 40.0, 40.0)
    engineered = feats.engineer(df)
    assert values(engineered, "monthly_charges_tier") == ["Low", "Low", "Mid", "Mid", "Mid", "Mid", "Premium"]
    assert "Join" not in engineered._jdf.queryExecution().executedPlan().toString()


def test_sketch_quantiles_stay_close(spark):
    df = spark.range(1, 10001).select(F.col("id").cast("double").alias("v"))
    exact = feats.value_quantiles(df, "v", [0.25, 0.5]).first()[0]
    close = feats.value_quantiles(df, "v", [0.25, 0.5], accuracy=1000).first()[0]
    assert exact == [2500.75, 5000.5]
    assert all(abs(a - b) <= 20 for a, b in zip(exact, close, strict=True))


def test_services_support_and_spend(spark):
    everything = {c: "Yes" for c in spec.ALL_SERVICES}
    df = clean_rows(spark, everything, {"tenure": 0, "total_charges": 71.5}, {"internet_service": None, "online_security": None})
    out = feats.engineer(df, [1, 2, 3])
    assert values(out, "num_services") == [7, 2, 2]
    assert values(out, "support_score") == [3, 0, 0]
    assert values(out, "has_fiber") == [1, 1, 0]
    assert values(out, "avg_monthly_spend") == [71.5, 71.5, 71.5]
    live = feats.online_features(df)
    assert values(live, "num_services") == [8, 3, 3]
    assert values(live, "avg_monthly_spend") == [71.5, 71.5, 71.5]


def test_contract_codes(spark):
    df = clean_rows(spark, *[{"contract": c} for c in [*spec.CONTRACTS, "Weekly"]])
    assert values(feats.engineer(df, [1, 2, 3]), "contract_risk_score") == [3, 2, 1, None]
    codes = spark.createDataFrame(list(spec.CONTRACT_RISK.items()), "contract string, contract_risk_score int")
    assert values(feats.contract_risk_lookup(df, codes), "contract_risk_score") == [3, 2, 1, None]


def test_segment_edges(spark):
    cases = [(65.01, 25), (65.0, 25), (65.01, 24)]
    df = feats.segments(clean_rows(spark, *[{"monthly_charges": c, "tenure": t} for c, t in cases]))
    assert values(df, "value_tier") == ["High Value", "Low Value", "Low Value"]
    months = [("Month-to-month", 12), ("Month-to-month", 13), ("Month-to-month", 24), ("Month-to-month", 25), ("One year", 1)]
    df = feats.segments(clean_rows(spark, *[{"contract": c, "tenure": t} for c, t in months]))
    assert values(df, "risk_tier") == ["High Risk", "Medium Risk", "Medium Risk", "Low Risk", "Low Risk"]


def test_two_segments_cannot_occur(telco):
    found = {r[0] for r in feats.segments(telco).select("customer_segment").distinct().collect()}
    assert not found & {"At Risk", "Needs Attention"}


@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_quantiles_are_exact(spark, ranges):
    """Against numpy: groups of ties, of one value, of hardly repeated values, with nulls and copies."""
    rng = np.random.default_rng(3)
    groups = {
        "ties": rng.integers(0, 5, 500).astype(float), "one": np.array([2.5]), "spread": rng.normal(size=700) * 10.0 ** rng.integers(-9, 9, 700),
        "hot": np.concatenate([np.zeros(900), rng.normal(size=300)]), "two": np.array([1.0, 4.0]),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("ties", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    points = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.quantiles for r in feats.value_quantiles(df, "v", points, by=["g"], ranges=ranges).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert np.allclose(got[g], np.quantile(values, points), rtol=1e-12, atol=1e-15)
    whole = feats.value_quantiles(df, "v", points, ranges=ranges).first().quantiles
    assert np.allclose(whole, np.quantile(np.concatenate(list(groups.values())), points), rtol=1e-12)
    assert feats.value_quantiles(df.limit(0), "v", points, ranges=ranges).first().quantiles is None
    plan = feats.value_quantiles(df, "v", points, ranges=ranges)._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan  # no map of all values in one task
