from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdfast.functions import cents, fraction, round_away, signed_text, snake_case, title_words


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_round_away(spark):
    cases = [(2.5, 0, 3.0), (-2.5, 0, -3.0), (1.005, 2, 1.0), (0.25, 1, 0.3), (-0.25, 1, -0.3), (19.995, 2, 20.0)]
    for x, digits, want in cases:
        assert one(spark, round_away(F.lit(x), digits)) == want
    assert one(spark, round_away(F.lit(None).cast("double"), 1)) is None


def test_cents_and_fraction(spark):
    assert one(spark, cents(F.lit(119.99))) == 11999
    assert one(spark, cents(F.lit(0.29))) == 29
    assert one(spark, cents(F.lit(-1.15))) == -115
    assert one(spark, fraction(F.lit(1), F.lit(0))) is None


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**10, 10**10), min_size=1, max_size=200))
def test_cents_read_back_money(spark, amounts):
    df = spark.createDataFrame([(a, a / 100.0) for a in amounts], "a bigint, d double")
    assert df.filter(cents("d") != F.col("a")).count() == 0


def test_snake_case():
    cases = {
        "customerID": "customer_id", "StreamingTV": "streaming_tv", "tenure": "tenure", "TotalCharges": "total_charges",
        "HTTPServer": "http_server", "seniorcitizen": "seniorcitizen", " Churn ": "churn", "plan2Go": "plan2_go",
    }
    assert {k: snake_case(k) for k in cases} == cases


def test_title_and_signed_text(spark):
    assert one(spark, title_words(F.lit("payment_method bank (auto) month-to-month"))) == "Payment_Method Bank (Auto) Month-To-Month"
    assert one(spark, signed_text(F.lit(-16.7))) == "-16.7%"
    assert one(spark, signed_text(F.lit(27.4))) == "+27.4%"
