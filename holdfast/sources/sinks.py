"""Writers for tables, reports, JSON documents, text and models."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast import spec
from holdfast.operators.forest import encoded_names

RUN_LOG_SCHEMA = "completed_at string, status string, total_customers bigint, churn_rate double, roc_auc double, run_id string"
FEATURE_SPEC_SCHEMA = (
    "all_features array<string>, numerical_features array<string>, categorical_features array<string>, "
    "encoded_features array<string>, charge_cuts array<double>, version string, partitions int"
)


def save_clean(df: DataFrame, parquet: str, csv: str | None = None) -> None:
    """The cleaned table as Parquet and, where asked for, as CSV; every task writes its part."""
    df.write.mode("overwrite").parquet(parquet)
    if csv:
        df.write.mode("overwrite").option("header", True).csv(csv)


def save_report(report: DataFrame, path: str, single_file: bool = True) -> None:
    """A report as CSV. Reports have few rows; turn ``single_file`` off for anything larger."""
    out = report.coalesce(1) if single_file else report
    out.write.mode("overwrite").option("header", True).csv(path)


def save_json(document: DataFrame, path: str, mode: str = "overwrite") -> None:
    document.write.mode(mode).json(path)


def save_text(lines: DataFrame, path: str, order: str = "line_no", text: str = "line") -> None:
    """Lines of a small report in their order."""
    lines.coalesce(1).sortWithinPartitions(order).select(text).write.mode("overwrite").text(path)


def save_model(
    spark: SparkSession, model: PipelineModel, path: str, charge_cuts: list[float] | None = None, partitions: int | None = None
) -> None:
    """The pipeline and, next to it, the feature lists, charge cut points and number of partitions it
    was trained with."""
    model.write().overwrite().save(f"{path}/pipeline")
    row = (
        spec.FEATURES, spec.NUMERIC_FEATURES, spec.CATEGORICAL_FEATURES, encoded_names(model), charge_cuts or [],
        spec.MODEL_VERSION, partitions,
    )
    save_json(spark.createDataFrame([row], FEATURE_SPEC_SCHEMA).coalesce(1), f"{path}/features")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(f"{path}/pipeline")
    row = spark.read.schema(FEATURE_SPEC_SCHEMA).json(f"{path}/features").first()
    return model, row.asDict()


def run_log_schema() -> StructType:
    return StructType.fromDDL(RUN_LOG_SCHEMA)


def log_run(
    spark: SparkSession, path: str, status: str, clean: DataFrame, roc_auc: float | None, run_id: str | None = None
) -> None:
    """Write the line of one run to the log. A run that is logged again under its id replaces its
    line and no other's; without an id it gets a new one."""
    line = clean.agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("completed_at"),
        F.lit(status).alias("status"),
        F.count(F.lit(1)).alias("total_customers"),
        F.avg(spec.LABEL).alias("churn_rate"),
        F.lit(roc_auc).cast("double").alias("roc_auc"),
    )
    line = line.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex))
    line.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").json(path)
