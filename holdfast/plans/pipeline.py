"""The whole run: ingest, reports, marts and checks, training, explanation, output check, log.

Every step is one or a few Spark jobs over tables the steps before have written, so a
failed run can be started again from any of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession

from holdfast import spec
from holdfast.operators import attribution as attr
from holdfast.operators import cleaning, forest, quality, stratify, treeshap
from holdfast.operators import evaluation as ev
from holdfast.operators import features as feats
from holdfast.plans import dashboards, marts, reports
from holdfast.sources import readers, sinks

# Report name -> function on the engineered table.
REPORTS = {
    "kpis": reports.churn_kpis,
    "revenue_at_risk": reports.revenue_at_risk,
    "churn_by_contract": reports.churn_by_contract,
    "churn_by_tenure": reports.churn_by_tenure,
    "service_usage": reports.service_usage,
    "customer_segments": reports.customer_segments,
    "retention_analysis": reports.retention_analysis,
    "headline_insights": reports.headline_insights,
}


@dataclass
class Run:
    """Folders of one run and the settings of its forest."""

    out: str
    stages: Pipeline | None = None
    minimum: float = spec.MIN_ROC_AUC

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"


def ingest(run: Run, raw: DataFrame) -> tuple[DataFrame, list[float]]:
    """Write the engineered table; returns it and the fitted charge cut points."""
    spark = raw.sparkSession
    cleaned = cleaning.clean(raw)
    cuts = [float(c) for c in feats.charge_thresholds(cleaned).first()]
    sinks.save_clean(feats.engineer(cleaned, cuts), run.path("clean"), run.path("clean_csv"))
    table = readers.read_table(spark, run.path("clean"), view="telco")
    sinks.save_report(dashboards.ingest_summary(table, raw), run.path("reports/ingest_summary"))
    return table, cuts


def write_reports(run: Run, table: DataFrame) -> None:
    for name, build in REPORTS.items():
        sinks.save_report(build(table), run.path(f"reports/{name}"))


def write_marts(run: Run, table: DataFrame) -> DataFrame:
    """Write the marts, then check source, staging and marts; a failed rule stops the run."""
    spark = table.sparkSession
    staged = marts.stage_view(spark, table)
    frames = {"customers": table, "stg_customers": staged}
    for name, build in marts.MARTS.items():
        build(staged).write.mode("overwrite").parquet(run.path(f"marts/{name}"))
        frames[name] = spark.read.parquet(run.path(f"marts/{name}"))
    results = quality.check_models(frames)
    quality.require_checks(results)
    return results


def train(run: Run, table: DataFrame, cuts: list[float], with_cv: bool = True) -> DataFrame:
    """Split, cross-validate, fit, save and evaluate; stops when the quality gate fails."""
    spark = table.sparkSession
    marked = stratify.split(table)
    marked.write.mode("overwrite").parquet(run.path("split"))
    parts = spark.read.parquet(run.path("split"))
    training = parts.filter("is_test = 0")
    stages = run.stages or forest.pipeline()
    cv = None
    if with_cv:
        stratify.folds(training).write.mode("overwrite").parquet(run.path("folds"))
        scores = forest.cv_summary(forest.cross_validate(spark.read.parquet(run.path("folds")), stages))
        cv = scores.select("mean_roc_auc").distinct().scalar()
    model = forest.train(training, stages)
    sinks.save_model(spark, model, run.path("model"), cuts)
    scored = forest.predict(model, parts.filter("is_test = 1"), "score")
    sinks.save_json(ev.metrics_record(scored, cv_roc_auc=cv), run.path("model_metrics"))
    metrics = spark.read.json(run.path("model_metrics"))
    ev.require_quality(metrics, run.minimum)
    sinks.save_report(forest.importances(spark, model), run.path("reports/feature_importance"))
    return metrics


def explain(run: Run, table: DataFrame) -> DataFrame:
    """SHAP of all customers as a table, with the insight document and text."""
    spark = table.sparkSession
    model, record = sinks.load_model(spark, run.path("model"))
    treeshap.forest_leaves(spark, run.path("model/pipeline")).write.mode("overwrite").parquet(run.path("model/leaves"))
    arrays = treeshap.shap_arrays(treeshap.spread(forest.encode(model, table)), spark.read.parquet(run.path("model/leaves")))
    treeshap.shap_long(arrays, record["encoded_features"]).write.mode("overwrite").parquet(run.path("shap"))
    drivers = attr.driver_ranking(spark.read.parquet(run.path("shap")))
    sinks.save_json(attr.insight_document(drivers), run.path("insights"))
    sinks.save_text(attr.report_lines(drivers), run.path("insights_text"))
    return drivers


def manifest(run: Run, spark: SparkSession) -> DataFrame:
    """Row counts of what the run must have written."""
    report = lambda name: spark.read.option("header", True).csv(run.path(f"reports/{name}"))
    return quality.output_manifest(
        {
            "clean": (spark.read.parquet(run.path("clean")), 1),
            "clean_csv": (spark.read.option("header", True).csv(run.path("clean_csv")), 1),
            "kpis": (report("kpis"), 1),
            "customer_segments": (report("customer_segments"), 1),
            "model": (spark.read.text(run.path("model/features")), 1),
            "model_metrics": (spark.read.json(run.path("model_metrics")), 1),
            "insights": (spark.read.json(run.path("insights")), 1),
        }
    )


def run_all(run: Run, raw: DataFrame, with_cv: bool = True, with_shap: bool = True) -> DataFrame:
    """All steps; returns the metrics record."""
    spark = raw.sparkSession
    table, cuts = ingest(run, quality.require_rows(raw))
    write_reports(run, table)
    write_marts(run, table)
    metrics = train(run, table, cuts, with_cv)
    if with_shap:
        explain(run, table)
        quality.require_outputs(manifest(run, spark))
    sinks.log_run(spark, run.path("run_log"), "success", table, metrics.first()["roc_auc"])
    return metrics
