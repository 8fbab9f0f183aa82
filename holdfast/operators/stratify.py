"""Seeded sampling and stratified splits that neither sort nor shuffle the table.

Rows are ordered by the md5 of seed and key within their class. The first hex digits of an
md5 spread evenly, so they cut each class into equal buckets, and counting the buckets shows
which of them a cut falls into. Only the rows of those buckets are ranked, to find the row
the cut ends at. The table itself is then compared with these few end rows, in a projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast import spec

_HEX = 4  # 65,536 buckets per class


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _place(key: str, seed: int) -> Column:
    """Hash, then key: a total order of the rows as text."""
    return F.concat(hash_order(key, seed), F.col(key).cast("string"))


def _class(label: str) -> Column:
    return F.coalesce(F.col(label).cast("string"), F.lit("none"))


def _end_rows(df: DataFrame, key: str, label: str, seed: int, last_ranks: Sequence[Callable[[Column], Column]]) -> DataFrame:
    """One row: a map from class to the place of the last row of each part but the final one."""
    rows = df.select(_class(label).alias("c"), _place(key, seed).alias("p"))
    bucket = F.substring("p", 1, _HEX)
    buckets = (
        rows.groupBy("c", bucket.alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy("c").orderBy("b")))
        .withColumn("size", F.sum("n").over(Window.partitionBy("c")))
    )
    cuts = F.array(
        *[F.struct(F.lit(i).alias("part"), f(F.col("size")).cast("bigint").alias("rank")) for i, f in enumerate(last_ranks)]
    )
    before = F.col("upto") - F.col("n")
    # As many rows as classes times cuts.
    wanted = buckets.select("c", "b", before.alias("before"), "upto", F.inline(cuts)).filter(
        (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("upto"))
    )
    # Copies of a key are counted before they are ordered and stay in one part.
    counted = (
        rows.withColumn("b", bucket)
        .join(F.broadcast(wanted), ["c", "b"])
        .groupBy("c", "b", "part", "rank", "before", "p")
        .agg(F.count(F.lit(1)).alias("m"))
    )
    upto = F.col("before") + F.sum("m").over(Window.partitionBy("c", "b", "part").orderBy("p"))
    ranked = counted.withColumn("upto", upto)
    ends = ranked.filter("upto >= rank and upto - m < rank").select("c", "part", "p")
    # A cut before the first row has no end row: the empty text comes before every place.
    missing = buckets.groupBy("c").agg(F.max("size").alias("size")).select("c", F.inline(cuts)).filter("rank <= 0")
    ends = ends.unionByName(missing.select("c", "part", F.lit("").alias("p")))
    of_class = ends.groupBy("c").agg(F.collect_list("p").alias("ends"))
    return of_class.agg(F.map_from_entries(F.collect_list(F.struct("c", "ends"))).alias("ends"))


def _with_part(
    df: DataFrame, key: str, label: str, seed: int, last_ranks: Sequence[Callable[[Column], Column]], out: str,
    numbered: Callable[[Column], Column] = lambda part: part, among: DataFrame | None = None,
) -> DataFrame:
    """Add the 0-based part of each row: how many end rows come before it."""
    cut = df if among is None else among
    ends, place = f"_{out}_ends", f"_{out}_place"
    part = sum(((F.col(ends)[i] < F.col(place)).cast("int") for i in range(len(last_ranks))), F.lit(0))
    return (
        df.withColumns({ends: _end_rows(cut, key, label, seed, last_ranks).scalar()[_class(label)], place: _place(key, seed)})
        .withColumn(out, numbered(part).cast("int"))
        .drop(ends, place)
    )


def split(
    df: DataFrame,
    fraction: float = spec.TEST_FRACTION,
    key: str = spec.KEY,
    label: str = spec.LABEL,
    seed: int = spec.SEED,
    out: str = "is_test",
) -> DataFrame:
    """Mark the same share of every class as test rows."""
    test_rows = lambda size: F.floor(size * fraction + 0.5)
    return _with_part(df, key, label, seed, [test_rows], out, lambda part: 1 - part)


def folds(
    df: DataFrame,
    k: int = spec.FOLDS,
    key: str = spec.KEY,
    label: str = spec.LABEL,
    seed: int = spec.SEED + 1,
    out: str = "fold",
    among: DataFrame | None = None,
) -> DataFrame:
    """Deal every class into k folds whose sizes differ by one row at most.

    With ``among``, a part of the frame, only its rows are counted when the folds are cut.
    """
    last = [lambda size, j=j: F.floor((size * j + (k - 1)) / k) for j in range(1, k)]
    return _with_part(df, key, label, seed, last, out, among=among)


def sample_ids(df: DataFrame, n: int = spec.SAMPLE_SIZE, key: str = spec.KEY, seed: int = spec.SEED) -> DataFrame:
    """The n keys that come first in hash order; each task keeps n rows, nothing is sorted."""
    return df.select(key).orderBy(hash_order(key, seed), key).limit(n)


def sample(df: DataFrame, n: int = spec.SAMPLE_SIZE, key: str = spec.KEY, seed: int = spec.SEED) -> DataFrame:
    """Whole rows of the sampled keys, n at most even where a key has copies."""
    rows = df.join(sample_ids(df, n, key, seed), key, "left_semi")
    return rows.orderBy(hash_order(key, seed), key).limit(n)
