import pytest
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.operators import forest
from holdfast.plans import marts, pipeline
from holdfast.session import new_path, shared_dir
from holdfast.sources import readers, sinks
from holdfast.sources.subscribers import subscribers


def test_missing_input_names_the_next_step(spark, tmp_path):
    with pytest.raises(readers.MissingInput, match="run ingest first"):
        readers.read_table(spark, str(tmp_path / "none"), next_step="run ingest first")
    with pytest.raises(readers.MissingInput):
        readers.read_csv(spark, str(tmp_path / "none.csv"), spec.RAW_SCHEMA)
    empty = readers.read_optional(spark, str(tmp_path / "none"), spec.RAW_SCHEMA)
    assert empty.columns == spec.RAW_COLUMNS and empty.isEmpty()


def test_csv_keeps_rows_that_do_not_fit(spark, tmp_path):
    lines = [",".join(spec.RAW_COLUMNS)]
    good = ["A", "Male", "0", "No", "No", "5", "Yes", "No", "DSL", "No", "No", "No", "No", "No", "No", "One year", "Yes", "Mailed check", "50.0", " ", "No"]
    bad = [*good[:5], "many", *good[6:]]
    (tmp_path / "raw.csv").write_text("\n".join(lines + [",".join(good), ",".join(bad)]) + "\n")
    rows = readers.read_csv(spark, str(tmp_path / "raw.csv"), spec.RAW_SCHEMA).cache()
    assert rows.filter(F.col(readers.CORRUPT).isNull()).count() == 1
    assert "many" in rows.filter(F.col(readers.CORRUPT).isNotNull()).first()[readers.CORRUPT]


def test_table_scan_registers_a_view(spark, telco, tmp_path):
    sinks.save_clean(telco, str(tmp_path / "p"), str(tmp_path / "c"))
    df = readers.read_table(spark, str(tmp_path / "p"), view="telco_view")
    assert spark.table("telco_view").count() == df.count() == telco.count()
    csv = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert csv.columns == telco.columns and csv.count() == telco.count()


def test_json_text_and_log(spark, telco, tmp_path):
    sinks.log_run(spark, str(tmp_path / "log"), "success", telco, 0.81)
    sinks.log_run(spark, str(tmp_path / "log"), "success", telco, None)
    log = readers.read_json(spark, str(tmp_path / "log"), spark.createDataFrame([], sinks.RUN_LOG_SCHEMA).schema)
    assert log.count() == 2 and log.filter("roc_auc = 0.81").count() == 1
    lines = spark.createDataFrame([(2, "b"), (1, "a")], "line_no int, line string")
    sinks.save_text(lines, str(tmp_path / "text"))
    assert [r.value for r in spark.read.text(str(tmp_path / "text")).collect()] == ["a", "b"]


def test_marts_build_twice_with_the_same_result(spark, telco):
    names = marts.build_marts(spark, telco, "customers")
    first = {r.model: r.row_count for r in marts.model_row_counts(spark, names).collect()}
    marts.build_marts(spark, telco, "customers")
    second = {r.model: r.row_count for r in marts.model_row_counts(spark, [*names, "nowhere"]).collect()}
    assert second.pop("nowhere") is None
    assert first == second and first["mart_customer_risk"] == telco.count() and first["mart_churn_kpis"] == 1
    for name in ["customers", *marts.MARTS]:
        spark.sql(f"DROP TABLE {name}")


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured.rstrip("/") if configured else shared_dir(spark))
    assert new_path(spark, "a") != new_path(spark, "a")


def test_without_a_shared_folder_plans_stay_lazy(spark, monkeypatch):
    from holdfast import session

    monkeypatch.setattr(session, "shared_dir", lambda _: None)
    df = spark.range(3)
    assert session.written_table(spark, "nowhere", "t", lambda: df) is df
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.new_path(spark, "t")


def test_tables_are_written_once_and_read_back(spark):
    from holdfast import session

    built = []

    def build():
        built.append(1)
        return spark.range(4).withColumn("d", F.lit(None).cast("double"))

    first = session.written_table(spark, "scope", "once", build)
    second = session.written_table(spark, "scope", "once", build)
    assert len(built) == 1 and first.count() == second.count() == 4 and first.schema["d"].dataType.simpleString() == "double"


def test_whole_run(spark, sf_dir, tmp_path):
    run = pipeline.Run(str(tmp_path / "run"), stages=forest.pipeline(4, 5))
    metrics = pipeline.run_all(run, subscribers(spark, sf_dir), with_cv=False).first()
    assert metrics["roc_auc"] >= 0.75 and metrics["test_size"] == 300
    assert spark.read.parquet(run.path("shap")).count() == subscribers(spark, sf_dir).count() * 52
    assert spark.read.json(run.path("run_log")).first()["status"] == "success"
    document = spark.read.json(run.path("insights")).first()
    assert len(document["top_churn_drivers"]) == 10
    assert spark.read.text(run.path("insights_text")).count() == 11
    for name in pipeline.REPORTS:
        assert spark.read.option("header", True).csv(run.path(f"reports/{name}")).count() > 0


def test_gate_stops_the_run(spark, telco, tmp_path):
    run = pipeline.Run(str(tmp_path / "run"), stages=forest.pipeline(1, 1), minimum=0.999)
    with pytest.raises(ValueError, match="below the minimum"):
        pipeline.train(run, telco, [1.0, 2.0, 3.0], with_cv=False)
