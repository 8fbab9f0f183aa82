"""Every query by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import wraps

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.operators import attribution as attr
from holdfast.operators import cleaning, forest, quality, risk, scoring, stratify, treeshap
from holdfast.operators import evaluation as ev
from holdfast.operators import features as feats
from holdfast.plans import dashboards as d
from holdfast.plans import marts as m
from holdfast.plans import reports as rep
from holdfast.plans import catalog
from holdfast.session import fingerprint, new_path, shared_dir, written_once, written_table
from holdfast.sources import readers, sinks
from holdfast.sources.sinks import load_model, save_model
from holdfast.sources.subscribers import customer_key, subscribers
from holdfast.streaming.scoring import read_batches, score_stream

Query = Callable[[SparkSession, str], DataFrame]


_plans: dict[tuple[str, str, str], DataFrame] = {}


def _planned_once(build: Query) -> Query:
    """Keep the plan of a frame that many queries start from; it holds no rows."""

    @wraps(build)
    def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, build.__name__, f"{shared_dir(spark)} {sf_dir} {fingerprint(spark, sf_dir)}")
        if key not in _plans:
            _plans[key] = build(spark, sf_dir)
        return _plans[key]

    return frame


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table, joined and written once per application, then scanned."""
    return written_table(spark, sf_dir, "clean", lambda: cleaning.clean(subscribers(spark, sf_dir)))


@_planned_once
def telco(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned table with the engineered columns; these stay expressions over the scan."""
    return feats.engineer(clean_table(spark, sf_dir))


@_planned_once
def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.stg_customers(telco(spark, sf_dir))


@_planned_once
def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.customer_risk(staged(spark, sf_dir))


def _on(source, build) -> Query:
    return lambda spark, sf_dir: build(source(spark, sf_dir))


def _catalog(spark: SparkSession, sf_dir: str) -> catalog.Catalog:
    """Source table, staging view and marts of an input folder, in a database of its own."""
    name = f"holdfast_{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"
    return catalog.Catalog(spark, name, m.models(lambda: telco(spark, sf_dir)), inputs=[sf_dir])


def _built_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a build and one right after it did with each model; nothing has changed in between."""
    models = _catalog(spark, sf_dir)
    models.drop()
    first, second = models.build(), models.build()
    rows = [(i, name, first[name], second[name]) for i, name in enumerate(models.order())]
    return spark.createDataFrame(rows, "place int, model string, first_build string, second_build string")


def _model_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _catalog(spark, sf_dir)
    models.build()
    names = [n for n in models.order() if n != "customers"]
    return m.model_row_counts(spark, [*names, "mart_not_built"], models.database)


def _contract_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = spark.createDataFrame(list(spec.CONTRACT_RISK.items()), "contract string, contract_risk_score int")
    return feats.contract_risk_lookup(clean_table(spark, sf_dir), codes)


def _segments(df: DataFrame) -> DataFrame:
    return feats.segments(df).select("customer_id", "value_tier", "risk_tier", "customer_segment")


# Rule score, split and sample -------------------------------------------------------------


@_planned_once
def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.rule_probability(telco(spark, sf_dir))


def _as_score(df: DataFrame) -> DataFrame:
    return df.select(spec.KEY, spec.LABEL, "prediction", F.col("probability").alias("score"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_table(spark, sf_dir).select(spec.KEY, spec.LABEL)


def _train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratify.split(_labelled(spark, sf_dir)).filter("is_test = 0").drop("is_test")


def _split_and_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = stratify.split(telco(spark, sf_dir))
    dealt = stratify.folds(marked, among=marked.filter("is_test = 0"))
    return dealt.withColumn("fold", F.when(F.col("is_test") == 0, F.col("fold")))


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered rows with their split mark and fold, written once: fitting and evaluation
    read them many times."""
    return written_table(spark, sf_dir, "split", lambda: _split_and_folds(spark, sf_dir))


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_table(spark, sf_dir).filter("is_test = 0")


def _rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record of the rule score on the test rows, with its mean over the folds of the others."""
    parts = scoring.rule_probability(split_table(spark, sf_dir))
    scores = parts.select(spec.LABEL, "prediction", "is_test", "fold", F.col("probability").alias("score"))
    cv = ev.roc_auc(scores.filter("is_test = 0"), by=["fold"]).agg(F.avg("roc_auc")).scalar()
    return ev.metrics_record(scores.filter("is_test = 1"), cv_roc_auc=cv)


def _contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attr.score_contributions(telco(spark, sf_dir), telco(spark, sf_dir))


def _drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attr.driver_ranking(_contributions(spark, sf_dir))


def _waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = scoring.highest(rule_scored(spark, sf_dir))
    return attr.waterfall(_contributions(spark, sf_dir), top, attr.base_value(telco(spark, sf_dir)), k=5)


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.levels(_training(spark, sf_dir))


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.scaled(telco(spark, sf_dir), _training(spark, sf_dir))


def _checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = telco(spark, sf_dir)
    stage = m.stg_customers(source)
    frames = {"customers": source, "stg_customers": stage, **{n: build(stage) for n, build in m.MARTS.items()}}
    return quality.check_models(frames)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = telco(spark, sf_dir)
    return quality.output_manifest(
        {
            "clean_table": (clean_table(spark, sf_dir), 1),
            "churn_kpis": (rep.churn_kpis(df), 1),
            "customer_segments": (rep.customer_segments(df), 1),
            "mart_customer_risk": (scored(spark, sf_dir), 1),
            "model_metrics": (_rule_metrics(spark, sf_dir), 1),
            "feature_levels": (_levels(spark, sf_dir), len(spec.FEATURES)),
            "driver_ranking": (_drivers(spark, sf_dir), 1),
        }
    )


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.validate(feats.online_features(clean_table(spark, sf_dir)))
    return checked.select(
        spec.KEY, "is_valid", F.size("errors").alias("error_count"), quality.error_text().alias("errors"), "avg_monthly_spend"
    )


def _churn_pct(spark: SparkSession, sf_dir: str):
    return clean_table(spark, sf_dir).agg(F.avg(spec.LABEL) * 100).scalar()


def _rule_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.reply(rule_scored(spark, sf_dir), reference_pct=_churn_pct(spark, sf_dir))


# Forest -----------------------------------------------------------------------------------

TREES, DEPTH = 300, 15
_loaded: dict[str, tuple[PipelineModel, dict]] = {}


def _forest_path(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        with forest.prepared(_training(spark, sf_dir), forest.pipeline(TREES, DEPTH)) as ready:
            model = ready.pipeline(ready.fit())
        cuts = [float(c) for c in feats.charge_thresholds(clean_table(spark, sf_dir)).first()]
        save_model(spark, model, path, cuts, ready.partitions)
        _loaded[path] = (model, {"charge_cuts": cuts})

    return written_once(spark, sf_dir, "forest", write)


def fitted_forest(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, dict]:
    """Forest and its feature record; trained and saved on first use."""
    path = _forest_path(spark, sf_dir)
    if path not in _loaded:
        _loaded[path] = load_model(spark, path)
    return _loaded[path]


def _train_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record of the forest on the test rows, with its mean over the folds of the others."""
    model, _ = fitted_forest(spark, sf_dir)
    tested = forest.predict(model, split_table(spark, sf_dir).filter("is_test = 1"))
    cv = _fold_scores(spark, sf_dir).agg(F.avg("roc_auc")).scalar()
    return ev.metrics_record(_as_score(tested), cv_roc_auc=cv)


def _held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every training row by the forest that has not seen its fold; fitted and written once."""

    def build() -> DataFrame:
        training = _training(spark, sf_dir)
        models = forest.fold_models(training, forest.pipeline(TREES, DEPTH))
        return forest.held_out_scores(training, models, keep=[spec.KEY])

    return written_table(spark, sf_dir, "held-out", build)


def _fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.roc_auc(_held_out(spark, sf_dir), by=["fold"])


def _cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.cv_summary(_fold_scores(spark, sf_dir))


def _importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.importances(spark, fitted_forest(spark, sf_dir)[0])


def _forest_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, record = fitted_forest(spark, sf_dir)
    return forest.predict(model, feats.engineer(clean_table(spark, sf_dir), record["charge_cuts"]))


def _score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.reply(_forest_scored(spark, sf_dir), reference_pct=_churn_pct(spark, sf_dir))


def _leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_forest_path(spark, sf_dir)}/pipeline"
    return written_table(spark, sf_dir, "leaves", lambda: treeshap.forest_leaves(spark, path))


def _shap_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHAP values of every customer, written once: one array a customer, which all reports read."""

    def build() -> DataFrame:
        model, _ = fitted_forest(spark, sf_dir)
        return treeshap.shap_arrays(treeshap.spread(forest.encode(model, telco(spark, sf_dir))), _leaves(spark, sf_dir))

    return written_table(spark, sf_dir, "shap", build)


def _shap_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treeshap.shap_long(_shap_arrays(spark, sf_dir), forest.encoded_names(fitted_forest(spark, sf_dir)[0]))


def _shap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = forest.predict(fitted_forest(spark, sf_dir)[0], telco(spark, sf_dir))
    return treeshap.additivity(_shap_arrays(spark, sf_dir), scored, treeshap.base_value(_leaves(spark, sf_dir)))


def _forest_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attr.driver_ranking(_shap_values(spark, sf_dir))


def _forest_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the mean of the forest to the score of its highest-scored customer."""
    top = scoring.highest(_forest_scored(spark, sf_dir))
    base = spark.range(1).select(F.lit(treeshap.base_value(_leaves(spark, sf_dir))).alias("base"))
    return attr.waterfall(_shap_values(spark, sf_dir), top, base)


def _forest_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attr.dependence(_shap_values(spark, sf_dir), telco(spark, sf_dir))


def _forest_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attr.distribution(_shap_values(spark, sf_dir))


# Facts about the forest's outputs that hold whatever trees it has -----------------------------


def _train_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the record counts, and whether it passes the gate."""
    record = _train_forest(spark, sf_dir)
    cells = sum((F.col(c) for c in ("false_positives", "false_negatives", "true_positives")), F.col("true_negatives"))
    passed = (F.col("roc_auc") >= spec.MIN_ROC_AUC) & F.col("accuracy").between(0, 1)
    filled = F.col("cv_roc_auc").between(0, 1)
    return record.select("test_size", cells.alias("counted"), F.coalesce(passed & filled, F.lit(False)).alias("passed"))


def _cv_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and positives scored in each fold, whether its AUC is that of its rows' mean ranks, and
    whether mean and deviation of all folds follow."""
    scores = _held_out(spark, sf_dir)
    in_order = Window.partitionBy("fold").orderBy("score")
    ranked = scores.select("fold", spec.LABEL, "score", F.rank().over(in_order).alias("r"))
    ties = ranked.withColumn("r", F.col("r") + (F.count("*").over(Window.partitionBy("fold", "score")) - 1) / 2)
    pos, neg = F.count_if(F.col(spec.LABEL) == 1), F.count_if(F.col(spec.LABEL) == 0)
    ranks = F.sum(F.when(F.col(spec.LABEL) == 1, F.col("r")))
    own = ties.groupBy("fold").agg(
        F.count("*").alias("row_count"), pos.alias("positives"), ((ranks - pos * (pos + 1) / 2) / (pos * neg)).alias("auc")
    )
    every = Window.partitionBy()
    near = lambda a, b: F.abs(a - b) < 0.0001
    joined = own.join(_cv_scores(spark, sf_dir), "fold")
    fits = near(F.col("auc"), F.col("roc_auc")) & near(F.avg("auc").over(every), F.col("mean_roc_auc"))
    fits = fits & near(F.stddev_pop("auc").over(every), F.col("sd_roc_auc")) & F.col("auc").between(0.5, 1)
    return joined.select("fold", "row_count", "positives", F.coalesce(fits, F.lit(False)).alias("fits"))


def _explained_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the reports on SHAP values agree with the arrays they come from: drivers out of
    place, whether the waterfall ends at the highest score, points and features shown, and features whose
    quantiles are not those of a plain aggregate over their values."""
    names = forest.encoded_names(fitted_forest(spark, sf_dir)[0])
    means = _shap_arrays(spark, sf_dir).agg(*[F.avg(F.abs(F.col("shap")[i])).alias(f"m{i}") for i in range(len(names))])
    ranked = F.sort_array(F.array(*[F.struct((-F.round(F.col(f"m{i}"), 4)).alias("s"), F.lit(n).alias("f")) for i, n in enumerate(names)]))
    expected = means.select(F.posexplode(ranked).alias("at", "e")).select((F.col("at") + 1).cast("long").alias("place"), F.col("e.f").alias("named"))
    drivers = _forest_drivers(spark, sf_dir).join(expected, "place", "left")
    end = _forest_waterfall(spark, sf_dir).filter("feature = 'score'").select("contribution").scalar()
    top = scoring.highest(_forest_scored(spark, sf_dir)).select("probability").scalar()
    points = _forest_dependence(spark, sf_dir).agg(F.count("*")).scalar()
    points_at = F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)])
    plain = _shap_values(spark, sf_dir).groupBy("feature").agg(F.percentile("contribution", points_at).alias("q"))
    spread = _forest_distribution(spark, sf_dir).join(plain, "feature")
    far = [F.abs(F.col(f"contribution_p{p}") - F.col("q")[i]) > 0.000001 for i, p in enumerate((0, 25, 50, 75, 100))]
    away = far[0] | far[1] | far[2] | far[3] | far[4]
    shown = spread.agg(F.struct(F.count("*").alias("n"), F.count_if(F.coalesce(away, F.lit(True))).alias("off"))).scalar()
    return drivers.agg(
        F.count("*").alias("drivers"), F.count_if(~F.col("feature").eqNullSafe(F.col("named"))).alias("misplaced")
    ).select("drivers", "misplaced", (F.abs(end - top) < 0.00001).alias("ends_at_score"), points.alias("points"), shown["n"].alias("features"), shown["off"].alias("spread_off"))


def _importance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = fitted_forest(spark, sf_dir)
    every = forest.importances(spark, model, k=len(forest.encoded_names(model)))
    return every.agg(
        F.count_distinct("feature").alias("features"),
        F.count_if(F.col("importance") < 0).alias("negative"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


def _score_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies, those whose fields do not fit the probability beside them, and those whose
    probability is not that of a walk through the saved nodes."""
    model, record = fitted_forest(spark, sf_dir)
    rows = feats.engineer(clean_table(spark, sf_dir), record["charge_cuts"])
    last = model.stages[-1]
    nodes = written_table(spark, sf_dir, "nodes", lambda: forest.node_table(spark, f"{_forest_path(spark, sf_dir)}/pipeline"))
    walked = forest.walk(forest.encode(model, rows), nodes, last.getNumTrees, last.getMaxDepth())
    scored = forest.predict(model, rows).join(walked, spec.KEY, "left")
    replies = scoring.reply(scored.withColumn("raw", F.struct("probability", "walked")), key="raw")
    p, walk = F.col("raw.probability"), F.col("raw.walked")
    tier = F.element_at(F.array(*map(F.lit, ("Low", "Medium", "High", "Critical"))), sum((p >= x).cast("int") for x in (0.3, 0.5, 0.7)) + 1)
    fits = (
        p.between(0, 1)
        & (F.col("churn_prediction") == (p > 0.5).cast("int"))
        & (F.abs(F.col("churn_probability") - p) < 0.00006)
        & (F.abs(F.col("churn_probability") + F.col("retention_probability") - 1) < 0.00011)
        & (F.col("risk_tier") == tier)
        & ((F.col("action_code") == "low_risk") == (p < 0.3))
    )
    off = lambda test: F.count_if(~F.coalesce(test, F.lit(False)))
    return replies.agg(F.count("*").alias("row_count"), off(fits).alias("rows_off"), off(F.abs(p - walk) < 1e-9).alias("scores_off"))


def _stream_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of the stream, and those that are not also replies of the batch, or the other way."""
    model, _ = fitted_forest(spark, sf_dir)
    requests = quality.validate(_requests(spark, sf_dir)).filter("is_valid").drop("errors", "is_valid")
    batch = scoring.reply(forest.predict(model, requests))
    side = lambda df, n: df.groupBy(*batch.columns).agg(F.count("*").alias("n")).withColumn("n", F.col("n") * n)
    both = side(_stream_score(spark, sf_dir), 1).unionByName(side(batch, -1))
    off = both.groupBy(*batch.columns).agg(F.sum("n").alias("off"), F.sum(F.greatest("n", F.lit(0))).alias("streamed"))
    return off.agg(F.sum("streamed").alias("row_count"), F.count_if(F.col("off") != 0).alias("rows_off"))


# Files and records ------------------------------------------------------------------------


def _csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of a load of the raw table from CSV. In the file, every 97th customer has a text for
    its months and every 101st of the others a negative charge."""
    number = F.substring("customerID", 2, 20).cast("long")
    spoilt = subscribers(spark, sf_dir).withColumns(
        {
            "tenure": F.when(number % 97 == 0, "many").otherwise(F.col("tenure").cast("string")),
            "MonthlyCharges": F.when(number % 101 == 0, F.lit(-1.0)).otherwise(F.col("MonthlyCharges")),
        }
    )
    path = written_once(spark, sf_dir, "raw-csv", lambda p: spoilt.write.option("header", True).csv(p))
    out = new_path(spark, "csv-load")
    account = readers.load_csv(spark, path, spec.RAW_SCHEMA, out, {"charge": F.col("MonthlyCharges") < 0})
    table = spark.read.parquet(out).filter("status = 'accepted'").agg(F.count("*").alias("table_rows"))
    counted = [F.lit(account[c]).cast("long").alias(c) for c in ("lines", "accepted", "rejected", "malformed")]
    return table.select(*counted, "table_rows")


def _reply_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with the place of their request in the request file."""
    requests = readers.read_indexed(spark, f"{sf_dir}/orders.parquet").select("row_index", customer_key().alias(spec.KEY))
    replies = _rule_replies(spark, sf_dir).select(spec.KEY, "churn_probability", "risk_tier")
    return requests.join(replies, spec.KEY).select("row_index", spec.KEY, "churn_probability", "risk_tier")


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log after a run, its rerun under the same id, and another run."""
    path = new_path(spark, "run-log")
    for run, status, auc in (("night", "failed", None), ("night", "success", 0.84), ("day", "success", None)):
        sinks.log_run(spark, path, status, clean_table(spark, sf_dir), auc, run)
    log = readers.read_json(spark, path, sinks.run_log_schema())
    stamped = F.col("completed_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$").alias("stamped")
    return log.select("run_id", "status", "total_customers", "churn_rate", "roc_auc", stamped)


def _clean_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, churned customers and charges in cents of the cleaned table, read back from both formats."""
    base = new_path(spark, "clean-files")
    df = telco(spark, sf_dir)
    sinks.save_clean(df, f"{base}/parquet", f"{base}/csv")
    cents = F.sum(F.round(F.col("monthly_charges") * 100).cast("long"))
    one = lambda frame, kind: frame.agg(
        F.lit(kind).alias("format"), F.count("*").alias("row_count"), F.sum(F.col(spec.LABEL).cast("long")).alias("churned"), cents.alias("cents")
    )
    back = spark.read.schema(df.schema)
    return one(back.parquet(f"{base}/parquet"), "parquet").unionByName(one(back.option("header", True).csv(f"{base}/csv"), "csv"))


def _report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, report = new_path(spark, "report"), rep.churn_by_contract(telco(spark, sf_dir))
    sinks.save_report(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


def _report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "report-text")
    sinks.save_text(attr.report_lines(_drivers(spark, sf_dir)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _insight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drivers and sentences of the insight document, read back from its file."""
    path, document = new_path(spark, "insights"), attr.insight_document(_drivers(spark, sf_dir))
    sinks.save_json(document, path)
    back = readers.read_json(spark, path, document.schema)
    rows = back.select(F.posexplode("top_churn_drivers").alias("at", "d"), "plain_english_summary")
    text = F.get(F.col("plain_english_summary"), F.col("at"))
    return rows.select((F.col("at") + 1).cast("long").alias("place"), "d.feature", "d.impact", "d.direction", text.alias("sentence"))


def _encoded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = forest.encoded_names(fitted_forest(spark, sf_dir)[0])
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "position long, feature string")


def _unseen_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with a contract no training row has: rows scored, without a score, and codes of
    the contract that are not zero."""
    model, record = fitted_forest(spark, sf_dir)
    rows = feats.engineer(clean_table(spark, sf_dir), record["charge_cuts"]).withColumn("contract", F.lit("Weekly"))
    places = [i for i, n in enumerate(forest.encoded_names(model)) if n.startswith("contract_") and n != "contract_risk_score"]
    coded = forest.encode(model, rows).select(spec.KEY, sum((F.abs(F.col("x")[i]) for i in places), F.lit(0.0)).alias("coded"))
    joined = forest.predict(model, rows).select(spec.KEY, "probability").join(coded, spec.KEY)
    return joined.agg(
        F.count("*").alias("row_count"), F.count_if(F.col("probability").isNull()).alias("unscored"), F.count_if(F.col("coded") != 0).alias("codes_set")
    )


def _saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the saved model, read back, scores otherwise than the fitted one, and the cut points
    that its record keeps."""
    model, _ = fitted_forest(spark, sf_dir)
    loaded, record = load_model(spark, _forest_path(spark, sf_dir))
    rows = feats.engineer(clean_table(spark, sf_dir), record["charge_cuts"])
    score = lambda m, name: forest.predict(m, rows, name).select(spec.KEY, name)
    both = score(model, "a").join(score(loaded, "b"), spec.KEY)
    cuts = [F.lit(c).alias(f"q{i + 1}") for i, c in enumerate(record["charge_cuts"])]
    off = F.count_if(F.col("a") != F.col("b")).alias("rows_off")
    return both.agg(F.count("*").alias("row_count"), off).select("*", *cuts, F.lit(len(record["all_features"])).alias("features"))


# Streams ----------------------------------------------------------------------------------


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of all customers, with the services counted as the forest learned them."""
    return feats.online_features(clean_table(spark, sf_dir), services=spec.ADDON_SERVICES)


def _streamed(spark: SparkSession, sf_dir: str, scorer) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected records of a stream over the request files."""
    requests = written_once(
        spark, sf_dir, "requests", lambda path: _requests(spark, sf_dir).write.parquet(path)
    )
    base = new_path(spark, "stream")
    accepted, rejected = f"{base}/accepted", f"{base}/rejected"
    score_stream(spark, requests, spec.REQUEST_SCHEMA, scorer, accepted, rejected, f"{base}/checkpoint").awaitTermination()
    return read_batches(spark, accepted), read_batches(spark, rejected)


def _stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = fitted_forest(spark, sf_dir)
    return _streamed(spark, sf_dir, lambda df: forest.predict(model, df))[0]


def _stream_rule_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    fiber = (F.col("internet_service") == "Fiber optic").cast("int")
    accepted, rejected = _streamed(spark, sf_dir, lambda df: scoring.rule_probability(df.withColumn("has_fiber", fiber)))
    replies = accepted.select(spec.KEY, "churn_probability", "risk_tier", "action_code", F.lit("").alias("errors"))
    return replies.unionByName(rejected, allowMissingColumns=True)


QUERIES: dict[str, Query] = {
    # tables and columns
    "subscribers": subscribers,
    "standardise_columns": _on(subscribers, cleaning.standardise_columns),
    "clean_subscribers": _on(subscribers, cleaning.clean),
    "category_audit": _on(subscribers, cleaning.category_audit),
    "charge_tier_thresholds": _on(clean_table, feats.charge_thresholds),
    "engineered_features": telco,
    "derive_online_features": _on(clean_table, feats.online_features),
    "contract_risk_lookup": _contract_lookup,
    "service_flags": _on(clean_table, feats.service_flags),
    "services_long": _on(clean_table, lambda df: feats.services_long(feats.service_flags(df))),
    "segment_assignment": _on(telco, _segments),
    "stg_customers": staged,
    "customer_risk": scored,
    "load_profile": _on(telco, m.load_profile),
    "model_row_counts": _model_row_counts,
    "built_models": _built_models,
    # files and records
    "csv_load": _csv_load,
    "clean_files": _clean_files,
    "report_file": _report_file,
    "report_text": _report_text,
    "run_log": _run_log,
    # reports
    "churn_kpis": _on(telco, rep.churn_kpis),
    "mart_churn_kpis": _on(staged, m.mart_churn_kpis),
    "churn_by_contract": _on(telco, rep.churn_by_contract),
    "churn_by_tenure": _on(telco, rep.churn_by_tenure),
    "revenue_at_risk": _on(telco, rep.revenue_at_risk),
    "service_usage": _on(telco, rep.service_usage),
    "service_effect_split": _on(telco, lambda df: rep.service_effect_split(rep.service_usage(df))),
    "customer_segments": _on(telco, rep.customer_segments),
    "retention_analysis": _on(telco, rep.retention_analysis),
    "mart_churn_by_segment": _on(staged, m.mart_churn_by_segment),
    "headline_insights": _on(telco, rep.headline_insights),
    "top_revenue_loss": _on(telco, lambda df: rep.top_revenue_loss(rep.revenue_at_risk(df))),
    "top_risk_customers": _on(scored, risk.top_customers),
    # dashboard
    "ingest_summary": lambda spark, sf_dir: d.ingest_summary(clean_table(spark, sf_dir), subscribers(spark, sf_dir)),
    "rate_by_dimension": _on(telco, d.rate_by_dimension),
    "overview_cards": _on(telco, d.overview_cards),
    "revenue_by_segment": _on(telco, d.revenue_by_segment),
    "revenue_by_contract": _on(telco, d.revenue_by_contract),
    "lost_mrr_share": _on(telco, d.lost_mrr_share),
    "contract_table": _on(telco, lambda df: d.display_table(rep.churn_by_contract(df), d.CONTRACT_HEADINGS)),
    "segment_table": _on(telco, lambda df: d.segment_table(rep.customer_segments(df))),
    "segment_directory": lambda spark, sf_dir: d.segment_directory(spark, rep.customer_segments(telco(spark, sf_dir))),
    # split, encoding and evaluation
    "class_balance": _on(_labelled, ev.class_balance),
    "stratified_split": _on(_labelled, stratify.split),
    "cv_folds": _on(_train_rows, stratify.folds),
    "class_weights": _on(_training, ev.class_weights),
    "scaled_features": _scaled,
    "one_hot_levels": _levels,
    "feature_labels": _on(_levels, attr.feature_labels),
    "roc_auc": _on(rule_scored, lambda df: ev.roc_auc(_as_score(df))),
    "roc_curve": _on(rule_scored, lambda df: ev.roc_curve(_as_score(df))),
    "confusion_matrix": _on(rule_scored, ev.confusion_matrix),
    "classification_report": _on(rule_scored, lambda df: ev.classification_report(ev.confusion_matrix(df))),
    "model_metrics": _rule_metrics,
    "quality_gate": _on(_rule_metrics, ev.quality_gate),
    # checks
    "dq_results": _checks,
    "validate_records": _validated,
    "output_manifest": _manifest,
    # scoring
    "risk_tier": _on(rule_scored, lambda df: df.select(spec.KEY, scoring.risk_tier(F.col("probability")).alias("risk_tier"))),
    "recommendation": _on(_rule_replies, lambda df: df.select(spec.KEY, "action_code", "recommendation")),
    "score_output": _rule_replies,
    "score_summary": _on(_rule_replies, scoring.summary),
    "highest_score_row": _on(rule_scored, scoring.highest),
    "stream_rule_score": _stream_rule_score,
    "reply_index": _reply_index,
    # explanation
    "explain_sample": _on(telco, lambda df: stratify.sample(df.select(spec.KEY, *spec.FEATURES))),
    "driver_ranking": _drivers,
    "driver_bars": _on(_contributions, attr.driver_bars),
    "driver_cards": _on(_drivers, attr.driver_cards),
    "driver_report_lines": _on(_drivers, attr.report_lines),
    "waterfall_rows": _waterfall,
    "dependence_pairs": lambda spark, sf_dir: attr.dependence(_contributions(spark, sf_dir), telco(spark, sf_dir)),
    "shap_distribution": _on(_contributions, attr.distribution),
    "insight_rows": _insight_rows,
    # forest
    "train_forest": _train_forest,
    "cv_scores": _cv_scores,
    "feature_importance": _importances,
    "score_batch": _score_batch,
    "shap_values": _shap_values,
    "shap_check": _shap_check,
    "forest_drivers": _forest_drivers,
    "forest_waterfall": _forest_waterfall,
    "forest_dependence": _forest_dependence,
    "forest_distribution": _forest_distribution,
    "train_check": _train_check,
    "cv_check": _cv_check,
    "explained_check": _explained_check,
    "importance_check": _importance_check,
    "score_check": _score_check,
    "model_information": lambda spark, sf_dir: forest.model_info(spark, fitted_forest(spark, sf_dir)[0]),
    "encoded_names": _encoded_names,
    "unseen_category": _unseen_category,
    "saved_model": _saved_model,
    "stream_check": _stream_check,
    "stream_score": _stream_score,
}
