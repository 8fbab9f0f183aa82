from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.operators import attribution as attr
from holdfast.operators import evaluation as ev
from holdfast.operators import forest, scoring, treeshap
from holdfast.plans import registry
from holdfast.session import new_path
from holdfast.sources import sinks


@pytest.fixture(scope="module")
def small(spark, sf_dir, telco):
    """A small forest, its path and its leaf tables."""
    path = new_path(spark, "small-forest")
    model = forest.train(telco, forest.pipeline(num_trees=3, max_depth=4))
    sinks.save_model(spark, model, path, [35.0, 65.0, 89.0])
    leaves = treeshap.forest_leaves(spark, f"{path}/pipeline").persist()
    yield model, path, leaves
    leaves.unpersist()


def expected_output(tree, x, known):
    """Path-dependent expectation of one tree when only the features in ``known`` are given."""
    total = 0.0
    for leaves in tree:
        for row in range(len(leaves.value)):
            p = leaves.value[row]
            for f, low, high, z in zip(leaves.feature[row], leaves.low[row], leaves.high[row], leaves.share[row], strict=True):
                p *= float(low < x[f] <= high) if f in known else z
            total += p
    return total


def brute_shapley(tree, x):
    used = sorted({int(f) for leaves in tree for f in leaves.feature.ravel()})
    phi = np.zeros(len(x))
    for f in used:
        others = [g for g in used if g != f]
        for size in range(len(others) + 1):
            w = factorial(size) * factorial(len(used) - size - 1) / factorial(len(used))
            for s in combinations(others, size):
                phi[f] += w * (expected_output(tree, x, {*s, f}) - expected_output(tree, x, set(s)))
    return phi


def test_shap_equals_all_subsets(spark, telco, small):
    model, _, leaves = small
    trees = [treeshap.unpack(r.data) for r in leaves.orderBy("tree").collect()]
    assert len(trees) == 3
    x = np.array([r.x for r in forest.encode(model, telco).orderBy("customer_id").limit(3).collect()])
    got = treeshap.shap_batch(trees, x, len(trees))
    for row in range(len(x)):
        want = sum(brute_shapley(t, x[row]) for t in trees) / len(trees)
        assert np.allclose(got[row], want, atol=1e-12)


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_shap_adds_up_to_the_probability(spark, telco, small, block_bytes, tmp_path):
    model, _, leaves = small
    forest.encode(model, telco).write.parquet(str(tmp_path / "encoded"))
    arrays = treeshap.shap_arrays(spark.read.parquet(str(tmp_path / "encoded")), leaves, block_bytes=block_bytes)
    assert "Exchange" not in arrays._jdf.queryExecution().executedPlan().toString()
    row = treeshap.additivity(arrays, forest.predict(model, telco), treeshap.base_value(leaves)).first()
    assert row.rows_checked == telco.count() and row.rows_off == 0


def test_encoded_names_follow_the_vector(spark, telco, small):
    model, _, _ = small
    names = forest.encoded_names(model)
    levels = forest.levels(telco).orderBy("position").collect()
    assert names == [r.feature for r in levels] and len(names) == 52
    row = forest.encode(model, telco.filter("contract = 'One year'")).first()
    assert row.x[names.index("contract_One year")] == 1.0 and row.x[names.index("contract_Two year")] == 0.0


def test_unseen_level_encodes_as_zeros(telco, small):
    model, _, _ = small
    strange = telco.limit(5).withColumn("contract", F.lit("Weekly")).withColumn("gender", F.lit(None).cast("string"))
    names = forest.encoded_names(model)
    places = [i for i, n in enumerate(names) if n.startswith(("contract_M", "contract_O", "contract_T", "gender_"))]
    for row in forest.encode(model, strange).collect():
        assert [row.x[i] for i in places] == [0.0] * len(places)
    assert forest.predict(model, strange).filter("probability is null").isEmpty()


def test_saved_model_gives_the_same_scores(spark, telco, small):
    model, path, _ = small
    loaded, record = sinks.load_model(spark, path)
    assert record["charge_cuts"] == [35.0, 65.0, 89.0] and record["all_features"] == spec.FEATURES
    assert record["encoded_features"] == forest.encoded_names(model)
    a = forest.predict(model, telco).select("customer_id", "probability")
    b = forest.predict(loaded, telco).select("customer_id", "probability")
    assert sorted(a.collect()) == sorted(b.collect())


def test_model_info(spark, small):
    row = forest.model_info(spark, small[0]).first()
    assert (row.status, row.model_loaded, row.model_type, row.feature_count) == ("ok", True, "RandomForestClassificationModel", 25)
    assert forest.model_info(spark, None).first().model_loaded is False


def test_prediction_is_the_larger_probability(telco, small):
    scored = forest.predict(small[0], telco)
    assert scored.filter(F.col("prediction") != (F.col("probability") > 0.5).cast("int")).isEmpty()
    assert ev.roc_auc(scored.withColumnRenamed("probability", "score")).first().roc_auc > 0.75


def test_importances_add_up(spark, small):
    top = forest.importances(spark, small[0], k=60).collect()
    assert sum(r.importance for r in top) == pytest.approx(1.0)
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)


def test_high_and_low_risk_profiles(spark, sf_dir):
    from tests.fixtures import requests

    model, _ = registry.fitted_forest(spark, sf_dir)
    _, _, most = spec.REQUEST_RULES["monthly_charges"]
    _, _, longest = spec.REQUEST_RULES["tenure"]

    def customer(months, charge, contract, tier, supported):
        """A customer at the bounds of the rules, with all support services or none."""
        helped = dict.fromkeys(spec.SUPPORT_SERVICES, "Yes" if supported else "No")
        return {
            "tenure": months, "monthly_charges": charge, "total_charges": months * charge, "avg_monthly_spend": charge, "contract": contract,
            "contract_risk_score": spec.CONTRACT_RISK[contract], "support_score": 3 * supported, "num_services": 2 + 3 * supported,
            "tenure_segment": next(name for top, name in spec.TENURE_BANDS if top is None or months <= top),
            "monthly_charges_tier": tier, **helped,
        }

    high = customer(spec.TENURE_BANDS[0][0], most / 2.0, spec.CONTRACTS[0], spec.CHARGE_TIERS[-1], False)
    low = customer(longest, spec.LIVE_CHARGE_CUTS[0], spec.CONTRACTS[-1], spec.CHARGE_TIERS[0], True)
    p = {r.customer_id: r.probability for r in forest.predict(model, requests(spark, high, low)).collect()}
    assert p["A0"] > 0.4 > p["A1"]


def test_stream_equals_batch(spark, sf_dir):
    model, _ = registry.fitted_forest(spark, sf_dir)
    streamed = registry.QUERIES["stream_score"](spark, sf_dir)
    from holdfast.operators import features as feats
    from holdfast.operators import quality

    checked = quality.validate(feats.online_features(registry.clean_table(spark, sf_dir), services=spec.ADDON_SERVICES))
    batch = scoring.reply(forest.predict(model, checked.filter("is_valid").drop("errors", "is_valid")))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(streamed) == rows(batch) != []


def test_cross_validation_covers_every_fold(spark, telco):
    from holdfast.operators import stratify

    rows = stratify.folds(telco.select(spec.KEY, *spec.FEATURES, spec.LABEL), k=3)
    out = forest.cv_summary(forest.cross_validate(rows, forest.pipeline(2, 3))).collect()
    assert sorted(r.fold for r in out) == [0, 1, 2]
    assert out[0].mean_roc_auc == pytest.approx(np.mean([r.roc_auc for r in out]), abs=1e-4)
    assert out[0].sd_roc_auc == pytest.approx(np.std([r.roc_auc for r in out]), abs=1e-4)


def test_folds_share_one_encoded_table(spark, telco):
    """The rows are encoded, shuffled and sorted once; every fold's fit filters what is held."""
    from holdfast.operators import stratify

    rows = stratify.folds(telco.select(spec.KEY, *spec.FEATURES, spec.LABEL), k=3)
    with forest.prepared(rows, forest.pipeline(2, 3), keep=["fold"]) as ready:
        assert ready.rows.storageLevel.useMemory and ready.partitions == forest.LEAST_PARTITIONS
        part = ready.rows.filter(F.col("fold") != 1)
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert plan.index("InMemoryTableScan") < plan.index("Exchange")  # only below the held table
        assert len(ready.fit(F.col("fold") != 1).trees) == 2
    assert not ready.rows.storageLevel.useMemory


def test_partitions_follow_the_rows(telco, monkeypatch):
    monkeypatch.setattr(forest, "PARTITION_ROWS", 100)
    with forest.prepared(telco, forest.pipeline(2, 3)) as ready:
        assert ready.partitions == -(-telco.count() // 100) == ready.rows.rdd.getNumPartitions()


def test_walk_finds_the_probability(spark, telco, small):
    model, path, _ = small
    walked = forest.walk(forest.encode(model, telco), forest.node_table(spark, f"{path}/pipeline"), 3, 4)
    both = forest.predict(model, telco).join(walked, spec.KEY)
    assert both.count() == telco.count() and both.filter(F.abs(F.col("probability") - F.col("walked")) > 1e-12).isEmpty()


def long_rows(spark):
    rows = [("A", "x", 1.0, 0.3), ("B", "x", 2.0, -0.1), ("A", "y", 5.0, -0.2), ("B", "y", 6.0, -0.4), ("A", "z", 0.0, 0.05), ("B", "z", 0.0, -0.05)]
    return spark.createDataFrame(rows, "customer_id string, feature string, value double, contribution double")


def test_driver_ranking_and_direction(spark):
    got = [tuple(r) for r in attr.driver_ranking(long_rows(spark)).orderBy("place").collect()]
    assert got == [(1, "y", 0.3, "decreases"), (2, "x", 0.2, "increases"), (3, "z", 0.05, "decreases")]
    lines = [r.line for r in attr.report_lines(attr.driver_ranking(long_rows(spark), 2)).orderBy("line_no").collect()]
    assert lines[1:] == ["1. ↓ y (impact=0.3)", "2. ↑ x (impact=0.2)"]


def test_insight_document(spark):
    row = attr.insight_document(attr.driver_ranking(long_rows(spark)), sentences=2).first()
    assert [d.feature for d in row.top_churn_drivers] == ["y", "x", "z"]
    assert row.plain_english_summary == ["Y decreases churn, by 0.3 on average.", "X increases churn, by 0.2 on average."]


def test_waterfall_folds_the_rest(spark):
    one = spark.createDataFrame([("A",)], "customer_id string")
    base = spark.createDataFrame([(0.25,)], "base double")
    rows = [tuple(r) for r in attr.waterfall(long_rows(spark), one, base, k=2).collect()]
    assert rows == [(0, "base", None, 0.25), (1, "x", 1.0, 0.3), (2, "other", None, -0.15), (3, "score", None, 0.4)]
    full = [r.feature for r in attr.waterfall(long_rows(spark), one, base, k=3).collect()]
    assert full == ["base", "x", "y", "z", "score"]


def test_impact_text(spark):
    df = spark.createDataFrame([(x,) for x in (0.0593, 0.046, 1.0, 0.0001, 10.25)], "x double")
    assert [r[0] for r in df.select(attr.impact_text(F.col("x"))).collect()] == ["0.0593", "0.046", "1.0", "0.0001", "10.25"]


def test_dependence_by_value(spark):
    rows = {r.value: r.n for r in attr.dependence_by_value(long_rows(spark), "z").collect()}
    assert rows == {0.0: 2}


def test_distribution_exact_and_sketched(spark):
    exact = {r.feature: r for r in attr.distribution(long_rows(spark)).collect()}
    assert exact["x"].value_p50 == 1.5 and exact["x"].contribution_p0 == -0.1 and exact["x"].contribution_p100 == 0.3
    close = {r.feature: r for r in attr.distribution(long_rows(spark), accuracy=1000).collect()}
    assert close["x"].contribution_p100 == 0.3 and set(close) == {"x", "y", "z"}
    assert attr.distribution(long_rows(spark), k=1).count() == 1
