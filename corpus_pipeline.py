"""From documents to token ids: quality rules, two kinds of deduplication, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result
is written as Parquet and read back as the next stage's docs. All but the last return the
columns of documents, whatever else these hold. Null or empty texts fail the quality rules, so
an empty table, or one without a good text, comes out empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import bpe, contamination, quality, simhash, substring
from holdfast.llm.tables import read, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows the quality rules keep."""
    return quality.judge(docs, key=F.struct("*")).filter("kept").select("doc_id.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id."""
    return simhash.distinct(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; repeated passages are cut out of the texts that have any."""
    return substring.cut(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by a benchmark item."""
    return contamination.clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids of every row and of what they decode to."""
    return bpe.round_trip(docs, bpe.rank_file()).drop("n_split_tokens")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: SQL has neither the hashes of the fingerprints nor the merges of the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
