"""Scans with a fixed schema and a clear message when the input is missing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


class MissingInput(FileNotFoundError):
    """The input path does not exist; the message names the step that writes it."""


def _open(load, path: str, next_step: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingInput(f"no input at {path}; {next_step}") from e


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    next_step: str = "put the raw file there first",
    keep_corrupt: bool = True,
) -> DataFrame:
    """CSV with a header. Rows that do not fit the schema keep their text in ``_corrupt_record``."""
    full = StructType(schema.fields + [StructField(CORRUPT, StringType())]) if keep_corrupt else schema
    reader = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return _open(lambda: reader.csv(path), path, next_step)


def load_csv(spark: SparkSession, path: str, schema: StructType, out: str, rules: Mapping[str, Column]) -> dict[str, int]:
    """Write the rows of a CSV as Parquet, parted by ``status``, and return how many lines there were
    and how many were accepted, rejected (a rule of ``rules`` holds; ``rule`` names the first) and
    malformed. The counts are observed while the rows are written; nothing is read twice."""
    rule = F.lit(None).cast("string")
    for name, broken in reversed(rules.items()):
        rule = F.when(broken, F.lit(name)).otherwise(rule)
    malformed = F.col(CORRUPT).isNotNull()
    status = F.when(malformed, "malformed").when(F.col("rule").isNotNull(), "rejected").otherwise("accepted")
    rows = read_csv(spark, path, schema).withColumn("rule", F.when(~malformed, rule)).withColumn("status", status)
    kinds = ("accepted", "rejected", "malformed")
    account = Observation("load")
    rows.observe(
        account, F.count(F.lit(1)).alias("lines"), *[F.count_if(F.col("status") == kind).alias(kind) for kind in kinds]
    ).write.mode("overwrite").partitionBy("status").parquet(out)
    return account.get


def read_indexed(spark: SparkSession, path: str, out: str = "row_index") -> DataFrame:
    """Parquet scan with the number of each row, from 0, in order of file name and place in the file.

    A row's place is what its file says; only the row counts of files are brought together, one
    line a file on the driver, which lists the files of a scan anyway. No row is moved or sorted.
    """
    rows = _open(lambda: spark.read.parquet(path), path, "put the input there first")
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    counts = placed.groupBy("_file").agg((F.max("_place") + 1).alias("n")).collect()
    before, offsets = 0, []
    for file, n in sorted(counts):
        offsets.append((file, before))
        before += n
    files = spark.createDataFrame(offsets, "_file string, _before long")
    return placed.join(files, "_file").select((F.col("_before") + F.col("_place")).alias(out), *rows.columns)


def read_table(
    spark: SparkSession,
    path: str,
    view: str | None = None,
    next_step: str = "run the step that writes it first",
) -> DataFrame:
    """Parquet scan, registered as a temp view when a name is given."""
    df = _open(lambda: spark.read.parquet(path), path, next_step)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_optional(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet", **options
) -> DataFrame:
    """The input, or an empty frame of the same schema where there is none."""
    try:
        return _open(
            lambda: spark.read.schema(schema).options(**options).format(file_format).load(path), path, "optional"
        )
    except MissingInput:
        return spark.createDataFrame([], schema)


def read_json(spark: SparkSession, path: str, schema: StructType, next_step: str = "run the step that writes it first") -> DataFrame:
    return _open(lambda: spark.read.schema(schema).json(path), path, next_step)
