"""Weighted rendezvous hashing of stable record keys over shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a numbering bucket, about; buckets are numbered one by one and laid end to end.
BUCKET_ROWS = 250_000


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key: the one with the highest score, the smaller number on a tie.

    A shard's score depends on the key and that shard alone, so a new shard takes keys only
    into itself, and a removed one gives up only its own. The score ``-ln(u) / weight`` is
    smallest for a shard in proportion to its weight.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = []
    for shard, weight in enumerate(weights):
        digest = F.conv(F.substring(F.md5(F.concat(text, F.lit(f":{shard}"))), 1, 13), 16, 10)
        unit = (digest.cast("double") + 0.5) / float(2**52)
        scores.append(F.struct((-F.ln(unit) / F.lit(float(weight))).alias("s"), F.lit(shard).alias("n")))
    return F.array_min(F.array(*scores))["n"] if len(scores) > 1 else F.lit(0)


def assign(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * 16, grown: Sequence[float] = (1.0,) * 17,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Shard and gapless slot of every row; the law is ``key``.

    Null key: a key of its own, the empty string. Null text: no bytes. Repeated rows: same
    shard, slots of their own. Empty table: no rows. Rows leave their texts behind before the
    only shuffle; slots come from counts of small buckets within the shard, so no task
    holds a shard.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.col("doc_id").cast("long")
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, grown).alias("grown_shard"),
    )
    n_buckets = max(1, -(-docs.count() // (bucket_rows * len(weights))))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = counts.select(
        F.col("shard").alias("s"),
        F.col("bucket").alias("b"),
        F.expr("sum(n) OVER (PARTITION BY shard ORDER BY bucket) - n").alias("base"),
    )
    numbered = rows.withColumn(
        "at", F.expr("row_number() OVER (PARTITION BY shard, bucket ORDER BY doc_id, text_crc32, size) - 1")
    )
    return numbered.join(before, (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b"))).select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("base") + F.col("at")).cast("long").alias("slot"),
        "grown_shard",
    )
