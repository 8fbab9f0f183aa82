"""Builds in the catalog, snapshots of inputs, row numbers, load accounts and the run log."""

import os

import pytest
from pyspark.sql import functions as F

from holdfast.plans.catalog import Catalog, Model
from holdfast.session import drop_written, fingerprint, written_table
from holdfast.sources import readers, sinks


@pytest.fixture
def models(spark, tmp_path):
    path = str(tmp_path / "input")
    spark.range(10).write.parquet(path)
    made = {
        "doubled": Model(["shown"], lambda shown: shown.select((F.col("n") * 2).alias("twice"))),
        "base": Model([], lambda: spark.read.parquet(path)),
        "shown": Model(["base"], view=["id AS n"]),
        "total": Model(["doubled", "base"], lambda doubled, base: doubled.agg(F.sum("twice").alias("s")).join(base.agg(F.count("*").alias("n")))),
    }
    out = Catalog(spark, "catalog_test", made, [path])
    out.drop()
    yield path, made, out
    out.drop()


def test_models_are_built_in_order_and_only_when_needed(spark, models):
    path, _, built = models
    order = built.order()
    assert order.index("base") < order.index("shown") < order.index("doubled") < order.index("total")
    assert set(built.build().values()) == {"built"} and set(built.build().values()) == {"unchanged"}
    assert built.table("total").first() == (90, 10)
    spark.range(3).write.mode("overwrite").parquet(path)
    assert set(built.build().values()) == {"built"} and built.table("total").first() == (6, 3)


def test_a_failed_build_leaves_the_table(spark, models):
    path, made, built = models
    built.build()

    def fails(shown):
        return shown.select(F.raise_error(F.lit("no")).alias("twice"))

    broken = Catalog(spark, "catalog_test", {**made, "doubled": Model(["shown"], fails)}, [path])
    with pytest.raises(Exception, match="no"):
        broken.build()
    assert built.table("doubled").count() == 10


def test_a_model_with_new_columns_is_replaced(spark, models):
    path, made, built = models
    built.build()

    def wider(shown):
        return shown.select("n", F.lit("x").alias("tag"))

    Catalog(spark, "catalog_test", {**made, "doubled": Model(["shown"], wider), "total": Model([], lambda: spark.range(1))}, [path]).build()
    assert built.table("doubled").columns == ["n", "tag"]


def test_unknown_references_and_circles(spark):
    with pytest.raises(ValueError, match="nowhere"):
        Catalog(spark, "catalog_test", {"a": Model(["nowhere"], lambda x: x)})
    with pytest.raises(ValueError):
        Catalog(spark, "catalog_test", {"a": Model(["b"], lambda x: x), "b": Model(["a"], lambda x: x)}).order()


def test_written_tables_follow_their_input(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = lambda: written_table(spark, path, "copy", lambda: spark.read.parquet(path))
    spark.range(4).write.parquet(path)
    first = fingerprint(spark, path)
    assert rows().count() == 4 and fingerprint(spark, path) == first
    spark.range(7).write.mode("overwrite").parquet(path)
    assert fingerprint(spark, path) != first and rows().count() == 7
    assert fingerprint(spark, str(tmp_path / "none")) == fingerprint(spark, str(tmp_path / "neither"))


def test_written_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    from holdfast import session

    spark.range(2).write.parquet(str(tmp_path / "in"))
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    monkeypatch.setattr(session, "_written", {})
    table = written_table(spark, str(tmp_path / "in"), "copy", lambda: spark.range(2))
    assert table.count() == 2 and os.listdir(tmp_path / "shared" / "holdfast")
    drop_written(spark)
    assert not os.listdir(tmp_path / "shared" / "holdfast") and not session._written


def test_rows_are_numbered_by_file_and_place(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 1000, 1, 7).select(F.col("id").alias("v"), F.lit(1).alias("row")).write.parquet(path)
    numbered = readers.read_indexed(spark, path)
    assert numbered.columns == ["row_index", "v", "row"]
    assert numbered.filter("row_index <> v").isEmpty() and numbered.agg(F.count_distinct("row_index")).first()[0] == 1000
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan and "Sort [" not in plan
    spark.range(0).write.parquet(str(tmp_path / "none"))
    assert readers.read_indexed(spark, str(tmp_path / "none")).count() == 0


def test_load_accounts_for_every_line(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("id,amount\n1,5.0\n2,-1.0\nthree,2.0\n4,\n")
    schema = spark.createDataFrame([], "id int, amount double").schema
    account = readers.load_csv(spark, str(tmp_path / "raw.csv"), schema, str(tmp_path / "out"), {
        "negative": F.col("amount") < 0, "missing": F.col("amount").isNull(),
    })
    assert account == {"lines": 4, "accepted": 1, "rejected": 2, "malformed": 1}
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.status, r.rule) for r in rows) == [("accepted", None), ("malformed", None), ("rejected", "missing"), ("rejected", "negative")]


def test_a_rerun_replaces_its_line(spark, telco, tmp_path):
    log = str(tmp_path / "log")
    sinks.log_run(spark, log, "failed", telco, None, "a")
    sinks.log_run(spark, log, "success", telco, 0.9, "b")
    sinks.log_run(spark, log, "success", telco, 0.8, "a")
    rows = readers.read_json(spark, log, sinks.run_log_schema()).collect()
    assert sorted((r.run_id, r.status, r.roc_auc) for r in rows) == [("a", "success", 0.8), ("b", "success", 0.9)]
