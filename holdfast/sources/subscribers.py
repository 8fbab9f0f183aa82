"""Raw subscriber table derived from the order tables: one order is one subscription.

Rules are those of FIXTURES.md section 2. Columns come out in their raw spelling and with
blanks and placeholder values, so the cleaning operators have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import code_map, first_match

# Bits of the service mask and the part types behind them.
SERVICE_BITS = {
    "SMALL": 1, "LARGE": 2, "ECONOMY": 4, "MEDIUM": 8, "PROMO": 16, "STANDARD": 32,
}
MULTIPLE_LINES_BIT = 64
PAPERLESS_BIT = 128
ADDON_BITS = {
    "OnlineSecurity": 1, "OnlineBackup": 2, "DeviceProtection": 4,
    "TechSupport": 8, "StreamingTV": 16, "StreamingMovies": 32,
}


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def customer_key(order: str = "o_orderkey") -> Column:
    """Key of the customer that an order stands for."""
    return F.format_string("C%08d", order)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def service_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bit mask per order. The shuffle to the order key carries (key, mask) pairs only,
    or-ed before and after it; a part that holds many lines is left to the skew join."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        (
            F.when(F.col("l_linenumber") == 6, MULTIPLE_LINES_BIT).otherwise(0)
            + F.when(F.col("l_returnflag") == "R", PAPERLESS_BIT).otherwise(0)
        ).alias("line_bits"),
    )
    parts = _table(spark, sf_dir, "part").select(
        "p_partkey",
        first_match(
            [(F.col("p_type").startswith(prefix), F.lit(bit)) for prefix, bit in SERVICE_BITS.items()], F.lit(0)
        ).alias("part_bits"),
    )
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.bit_or(F.col("line_bits").bitwiseOR(F.col("part_bits"))).alias("mask"))
    )


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21 raw columns."""
    month = lambda: F.year("o_orderdate") * 12 + F.month("o_orderdate")
    all_orders = _table(spark, sf_dir, "orders")
    last_month = all_orders.agg(F.max(month())).scalar()

    orders = all_orders.select(
        F.col("o_orderkey").alias("k"),
        "o_custkey",
        "o_orderpriority",
        (1800 + F.floor("o_totalprice") % 10200).alias("cents"),
        F.least(F.lit(72), F.greatest(F.lit(0), last_month - month() - 1)).alias("tenure"),
    )
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(service_masks(spark, sf_dir), F.col("k") == F.col("l_orderkey"), "left")
        .withColumn("mask", F.coalesce("mask", F.lit(0)))
    )
    bit = lambda value: F.col("mask").bitwiseAND(F.lit(value)) != 0
    online = F.col("n_regionkey") != 0
    fiber = F.col("n_regionkey").isin(3, 4)

    priority_points = {
        "1-URGENT": 30, "2-HIGH": 30, "3-MEDIUM": 30, "4-NOT SPECIFIED": 10, "5-LOW": 0,
    }
    points = (
        code_map(F.col("o_orderpriority"), priority_points)
        + first_match(
            [(F.col("tenure") <= 6, F.lit(30)), (F.col("tenure") <= 12, F.lit(20)), (F.col("tenure") <= 24, F.lit(10))],
            F.lit(0),
        )
        + F.when(fiber, 12).otherwise(0)
        - F.when(online & bit(ADDON_BITS["OnlineSecurity"]), 6).otherwise(0)
        - F.when(online & bit(ADDON_BITS["TechSupport"]), 6).otherwise(0)
    )
    noise = (F.col("k") * 7919 + 104729) % 10007 % 60
    total = F.col("cents") * F.col("tenure") + F.col("k") % 500

    addons = [
        F.when(~online, "No internet service").otherwise(_yes_no(bit(value))).alias(name)
        for name, value in ADDON_BITS.items()
    ]
    return joined.select(
        customer_key("k").alias("customerID"),
        F.when(F.col("o_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.when(F.col("o_custkey") % 6 == 0, 1).otherwise(0).alias("SeniorCitizen"),
        _yes_no(F.col("c_nationkey") % 2 == 0).alias("Partner"),
        _yes_no(F.col("c_acctbal") > 6700).alias("Dependents"),
        "tenure",
        _yes_no(F.col("k") % 10 != 0).alias("PhoneService"),
        F.when(F.col("k") % 10 == 0, "No phone service")
        .otherwise(_yes_no(bit(MULTIPLE_LINES_BIT)))
        .alias("MultipleLines"),
        F.when(~online, "No").when(fiber, "Fiber optic").otherwise("DSL").alias("InternetService"),
        *addons,
        code_map(
            F.substring("o_orderpriority", 1, 1),
            {"1": "Month-to-month", "2": "Month-to-month", "3": "Month-to-month", "4": "One year", "5": "Two year"},
        ).alias("Contract"),
        _yes_no(bit(PAPERLESS_BIT)).alias("PaperlessBilling"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Mailed check")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "Bank transfer (automatic)")
        .when(F.col("c_mktsegment") == "FURNITURE", "Credit card (automatic)")
        .otherwise("Electronic check")
        .alias("PaymentMethod"),
        (F.col("cents") / 100.0).alias("MonthlyCharges"),
        F.when(F.col("tenure") == 0, " ")
        .otherwise(
            F.concat(
                F.floor(total / 100).cast("string"), F.lit("."), F.lpad((total % 100).cast("string"), 2, "0")
            )
        )
        .alias("TotalCharges"),
        _yes_no(points + noise > 70).alias("Churn"),
    )
