"""Physical plans: scans, shuffles and the absence of Python where it is not needed."""

import re

import pytest
from pyspark.sql import functions as F

from holdfast.operators import stratify
from holdfast.plans import registry, reports
from holdfast.sources.subscribers import subscribers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Scans of the main plan, without its scalar subqueries."""
    return len(re.findall(r"FileScan parquet", plan(df)))


@pytest.mark.parametrize("name", ["churn_kpis", "churn_by_contract", "churn_by_tenure", "service_usage", "retention_analysis", "customer_segments", "rate_by_dimension"])
def test_reports_scan_once(spark, sf_dir, name):
    assert scans(registry.QUERIES[name](spark, sf_dir)) == 1


def test_reports_read_only_their_columns(spark, sf_dir):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(registry.QUERIES["churn_kpis"](spark, sf_dir))).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"tenure", "monthly_charges", "churn_flag"}


def test_filters_reach_the_scan(spark, sf_dir):
    df = registry.telco(spark, sf_dir).filter("contract = 'One year'").select("tenure")
    assert "EqualTo(contract,One year)" in plan(df)


def test_wide_groups_are_reduced_before_the_unpivot(spark, sf_dir):
    for name in ("retention_analysis", "service_usage"):
        text = plan(registry.QUERIES[name](spark, sf_dir))
        assert text.index("Generate") < text.rindex("HashAggregate")  # the first aggregate is below the unpivot


def test_top_k_does_not_sort_the_table(spark, sf_dir, telco):
    for df in (reports.revenue_at_risk(telco), registry.QUERIES["top_risk_customers"](spark, sf_dir), stratify.sample_ids(telco, 10)):
        assert "TakeOrderedAndProject" in plan(df) and "rangepartitioning" not in plan(df)


def test_split_is_a_projection(spark, sf_dir):
    main = plan(stratify.split(registry.clean_table(spark, sf_dir).select("customer_id", "churn_flag"))).split("Subquery", 1)[0]
    assert "Exchange" not in main and "Join" not in main


def test_no_python_outside_shap(spark, sf_dir):
    skipped = {"forest_drivers", "forest_waterfall", "forest_dependence", "forest_distribution", "cv_check", "explained_check", "train_forest", "cv_scores", "feature_importance", "score_batch", "shap_values", "shap_check", "stream_score", "stream_rule_score"}
    for name, query in registry.QUERIES.items():
        if name not in skipped:
            text = plan(query(spark, sf_dir))
            assert "Python" not in text and "InPandas" not in text, name


def test_no_cartesian_product(spark, sf_dir):
    for name in ("subscribers", "engineered_features", "customer_risk", "score_output", "scaled_features", "driver_ranking"):
        text = plan(registry.QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_hot_keys_keep_the_result(spark, sf_dir, tmp_path):
    """A third of the lines on one part and of the orders on one customer, joined with sort-merge and split."""
    for name in ("customer", "nation", "part"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey"))).repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 1, 1).otherwise(F.col("o_custkey"))).repartition(8).write.parquet(f"{tmp_path}/orders.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    rows = lambda: sorted(tuple(r) for r in subscribers(spark, str(tmp_path)).collect())
    plain = rows()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = subscribers(spark, str(tmp_path))
        split = sorted(tuple(r) for r in df.collect())
        assert "skew=true" in plan(df)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert split == plain and len(plain) == orders.count()
