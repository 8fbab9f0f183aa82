import hashlib
import random

import pytest
from pyspark.sql import functions as F

from holdfast.operators import evaluation as ev
from holdfast.operators import stratify


def scores(spark, rows):
    return spark.createDataFrame(rows, "churn_flag int, score double")


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_auc_equals_all_pairs(spark, digits):
    rng = random.Random(digits)
    rows = [(rng.randint(0, 1), round(rng.random(), digits)) for _ in range(400)]
    assert ev.roc_auc(scores(spark, rows)).first()["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_with_crowded_buckets_and_outside_domain(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), 0.5 + rng.random() / 1e6) for _ in range(200)] + [(1, 7.0), (0, -3.0), (0, 9.0)]
    assert ev.roc_auc(scores(spark, rows)).first()["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert ev.roc_auc(scores(spark, [(1, 0.2), (1, 0.4)])).first()["roc_auc"] is None


def test_auc_per_group(spark):
    rows = [(g, y, s) for g in (0, 1) for y, s in [(0, 0.1), (1, 0.9 if g else 0.05), (0, 0.3)]]
    df = spark.createDataFrame(rows, "fold int, churn_flag int, score double")
    assert {r.fold: r.roc_auc for r in ev.roc_auc(df, by=["fold"]).collect()} == {0: 0.0, 1: 1.0}


def brute_curve(rows, drop):
    levels = sorted({s for _, s in rows}, reverse=True)
    points = [(s, sum(y == 1 and v >= s for y, v in rows), sum(y == 0 and v >= s for y, v in rows)) for s in levels]
    if drop and len(points) > 2:
        middle = [
            b for a, b, c in zip(points, points[1:], points[2:])
            if (c[1] - b[1], c[2] - b[2]) != (b[1] - a[1], b[2] - a[2])
        ]
        points = [points[0], *middle, points[-1]]
    p, n = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    return {(s, tp / p, fp / n) for s, tp, fp in points} | {(None, 0.0, 0.0)}


@pytest.mark.parametrize("drop", [True, False])
@pytest.mark.parametrize("digits", [1, 5])
def test_roc_curve_equals_counting(spark, drop, digits):
    rng = random.Random(digits)
    rows = [(rng.randint(0, 1), round(rng.random(), digits)) for _ in range(150)]
    got = {tuple(r) for r in ev.roc_curve(scores(spark, rows), drop_straight=drop).collect()}
    assert got == brute_curve(rows, drop)


def matrix(spark, tn, fp, fn, tp):
    return spark.createDataFrame([(tn, fp, fn, tp)], "true_negatives bigint, false_positives bigint, false_negatives bigint, true_positives bigint")


def test_published_confusion_matrix(spark):
    lines = {r["class_name"]: r for r in ev.classification_report(matrix(spark, 815, 220, 100, 274)).collect()}
    assert round(lines["Churned"]["precision"], 4) == 0.5547
    assert round(lines["Churned"]["recall"], 4) == 0.7326
    assert round(lines["Churned"]["f1_score"], 4) == 0.6313
    assert round(lines["accuracy"]["f1_score"], 4) == 0.7729
    assert lines["weighted avg"]["support"] == 1409


def test_report_of_one_class_divides_by_nothing(spark):
    lines = {r["class_name"]: r for r in ev.classification_report(matrix(spark, 10, 0, 0, 0)).collect()}
    assert (lines["Churned"]["precision"], lines["Churned"]["recall"], lines["Churned"]["f1_score"]) == (0.0, 0.0, 0.0)


def test_metrics_record_and_gate(spark):
    rows = [(0, 0.1), (0, 0.2), (0, 0.7), (1, 0.5), (1, 0.8), (1, 0.9)]
    df = ev.with_prediction(scores(spark, rows))
    record = ev.metrics_record(df).first()
    assert (record.true_negatives, record.false_positives, record.false_negatives, record.true_positives) == (2, 1, 1, 2)
    assert record.roc_auc == round(brute_auc(rows), 4) and record.test_size == 6
    ev.require_quality(ev.metrics_record(df), 0.75)
    with pytest.raises(ValueError, match="below the minimum"):
        ev.require_quality(ev.metrics_record(df), 0.95)


def test_class_weights_balance(spark):
    df = scores(spark, [(0, 0.0)] * 6 + [(1, 0.0)] * 2)
    assert {r.churn_flag: r.weight for r in ev.class_weights(df).collect()} == {0: 8 / 12, 1: 2.0}


def brute_order(rows, seed):
    return sorted(rows, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest() + k)


@pytest.mark.parametrize("sizes", [{0: 300, 1: 77}, {0: 1, 1: 2}, {0: 9, 1: 0, None: 4}])
def test_split_and_folds_equal_sorting(spark, sizes):
    rows = [(f"C{label}{i}", label) for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id string, churn_flag int")
    parted = stratify.split(df)
    got = {r.customer_id: r.is_test for r in parted.collect()}
    dealt = {r.customer_id: r.fold for r in stratify.folds(df).collect()}
    assert len(got) == len(dealt) == len(rows)
    for label in sizes:
        keys = [k for k, y in rows if y == label]
        n_test = int(0.2 * len(keys) + 0.5)
        assert {k for k in keys if got[k]} == set(brute_order(keys, 42)[:n_test])
        for place, k in enumerate(brute_order(keys, 43)):
            assert dealt[k] == place * 5 // len(keys)


def test_published_test_size(spark):
    df = spark.range(7043).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") < 1869).cast("int").alias("churn_flag"))
    counts = {r.churn_flag: r["count"] for r in stratify.split(df).filter("is_test = 1").groupBy("churn_flag").count().collect()}
    assert counts == {0: 1035, 1: 374}


def test_sample_is_the_head_of_the_hash_order(spark):
    keys = [f"K{i}" for i in range(500)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "customer_id string, v int")
    got = {r.customer_id for r in stratify.sample(df, 40).collect()}
    assert got == set(brute_order(keys, 42)[:40])
    assert stratify.sample(df, 1000).count() == 500


def test_copies_of_a_key_stay_together_and_do_not_break_the_split(spark):
    rows = [("hot", 0)] * 200 + [(f"C{i}", 0) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id string, churn_flag int")
    parted = stratify.split(df)
    assert parted.count() == 600
    assert parted.filter("customer_id = 'hot'").select("is_test").distinct().count() == 1
    assert 120 <= parted.filter("is_test = 1").count() < 320
    assert stratify.sample(df, 50).count() == 50
