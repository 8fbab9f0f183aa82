"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The forest here has 20 trees of depth 8; registered queries train 300 of depth 15, whose folds
would take over half an hour at sf0.1. ``ingest`` joins, cleans and writes the table the reports read, ``split`` marks the training
rows; both are timed once, as every job pays them once. Reports take the better of two runs.
"""

from __future__ import annotations

import json
import os
import re
import time

from holdfast.plans import registry as reg
from holdfast.session import local_session

REPORTS = [
    "charge_tier_thresholds", "churn_kpis", "churn_by_contract", "churn_by_tenure", "revenue_at_risk", "service_usage",
    "customer_segments", "retention_analysis", "headline_insights", "mart_churn_kpis", "mart_churn_by_segment",
    "customer_risk", "dq_results", "rate_by_dimension", "score_output", "validate_records", "roc_auc", "roc_curve",
    "driver_ranking",
]
ONCE = ["model_metrics", "cv_scores", "train_forest", "feature_importance", "score_batch", "shap_values", "forest_drivers", "stream_rule_score"]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    reg.TREES, reg.DEPTH = 20, 8
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "holdfast-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()

    def execute(name: str) -> None:
        reg.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {"ingest": timed(lambda: reg.clean_table(spark, sf_dir))}
    for name in REPORTS:
        times[name] = min(timed(lambda: execute(name)) for _ in range(2))
    times["split"] = timed(lambda: reg.split_table(spark, sf_dir))
    for name in ONCE:
        times[name] = timed(lambda: execute(name))
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "churn analytics, ingest to stream scoring",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
