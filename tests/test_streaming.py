from pyspark.sql import functions as F

from holdfast import spec
from holdfast.operators import scoring
from holdfast.streaming.scoring import read_batches, score_stream
from tests.fixtures import requests


def scorer(df):
    return scoring.rule_probability(df.withColumn("has_fiber", (F.col("internet_service") == "Fiber optic").cast("int")))


def test_rejects_are_kept_and_restarts_add_only_new_files(spark, tmp_path):
    source, good, bad, state = (str(tmp_path / n) for n in ("in", "good", "bad", "state"))
    run = lambda: score_stream(spark, source, spec.REQUEST_SCHEMA, scorer, good, bad, state).awaitTermination()
    requests(spark, {}, {"tenure": 999, "contract": "Weekly"}).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert [r.customer_id for r in read_batches(spark, good).collect()] == ["A0"]
    rejected = read_batches(spark, bad).collect()
    assert [(r.customer_id, r.errors) for r in rejected] == [("A1", "tenure:range;contract:one_of")]
    requests(spark, {}, {}).withColumn("customer_id", F.concat(F.lit("B"), "customer_id")).coalesce(1).write.mode("append").parquet(source)
    run()
    assert sorted(r.customer_id for r in read_batches(spark, good).collect()) == ["A0", "BA0", "BA1"]
    assert read_batches(spark, bad).count() == 1


def test_batch_number_makes_a_rerun_overwrite(spark, tmp_path):
    source, good, bad = (str(tmp_path / n) for n in ("in", "good", "bad"))
    requests(spark, {}, {}).write.parquet(source)
    for attempt in ("one", "two"):  # a lost checkpoint replays batch 0
        score_stream(spark, source, spec.REQUEST_SCHEMA, scorer, good, bad, str(tmp_path / attempt)).awaitTermination()
    assert read_batches(spark, good).count() == 2
