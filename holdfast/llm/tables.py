"""Inputs and written intermediates of the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.session import new_path


#: Column chunks are read in pieces into the heap. Parquet's reads of many ranges at once pass through
#: buffers outside the heap that each thread keeps, as large as the largest chunk it has read.
PLAIN_READS = {"parquet.hadoop.vectored.io.enabled": "false"}


def read(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """``options``: of Spark's Parquet reader."""
    return spark.read.options(**options).parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """Key and text alone, so columns of other names never meet those of an operator.

    The key is doc_id, or whatever an operator shall carry along, such as the whole row
    (``struct("*")``).
    """
    key = F.col("doc_id").cast("long") if key is None else key
    return docs.select(key.alias("doc_id"), F.col("text").cast("string").alias("text"))


#: Spark's setting to delete a query's shuffle files when it ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, settings: Mapping[str, str] | None = None, **options) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here, and a lost
    executor costs the tasks it ran, not the steps before. The table takes the place of the
    shuffle files that led to it, so these go at once.

    ``settings``: of the session while it writes; ``options``: of Spark's Parquet writer and reader."""
    spark = df.sparkSession
    path = new_path(spark, name)
    settings = {CLEAN_SHUFFLES: "true", **(settings or {})}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.options(**options).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.options(**options).schema(df.schema).parquet(path)
