"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components of the links."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from holdfast.llm.arrays import utf8
from holdfast.llm.tables import texts, written

SHINGLE, DISTANCE, BLOCKS, SEED = 3, 2, 5, 42


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bit by bit over the hashes of the word shingles; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, runs), repeat(seed)), ">u8", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (as a signed long) and text hash of every row; null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle, seed) for t in utf8(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64()), batch.column(2)], names=["doc_id", "print", "th"])

    return texts(docs).withColumn("th", F.xxhash64("text")).mapInArrow(run, "doc_id long, print long, th long")


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (a < b) of different prints at most ``distance`` bits apart.

    Prints that near agree on all but ``distance`` of the blocks, so they share one of the
    keys made of ``blocks - distance`` blocks. Candidates are compared inside the join.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    keys = [sum(masks[i] for i in kept) for kept in combinations(range(blocks), blocks - distance)]
    signed = [k - (1 << 64) if k >> 63 else k for k in keys]
    table = F.explode(
        F.array(*(F.struct(F.lit(i).alias("t"), F.col("print").bitwiseAND(F.lit(k)).alias("k")) for i, k in enumerate(signed)))
    )
    keyed = prints.select("print", table.alias("x")).select("print", F.col("x.t").alias("t"), F.col("x.k").alias("k"))
    a = keyed.select(F.col("print").alias("a"), "t", "k")
    b = keyed.select(F.col("print").alias("b"), F.col("t").alias("t2"), F.col("k").alias("k2"))
    near = (
        (F.col("t") == F.col("t2")) & (F.col("k") == F.col("k2")) & (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )
    return a.join(b, near).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (smallest node) of every node of an edge list (a, b).

    Alternates two star steps, each a minimum per node and a join: no neighbour list is
    collected, and every round ends in a written table. It stops when a round changes nothing.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def both(e: DataFrame) -> DataFrame:
        return e.union(e.select("v", "u"))

    def large_star(e: DataFrame) -> DataFrame:
        sides = both(e)
        low = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        return sides.join(low, "u").filter("v > u AND v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("low"))
        moved = down.join(low, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        return moved.union(low.select("u", F.col("low").alias("v")))

    now = written(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), "links")
    seen = state(now)
    while True:
        now = written(small_star(large_star(now).distinct()).distinct(), "stars")
        after = state(now)
        if after == seen:
            break
        seen = after
    roots = now.groupBy("u").agg(F.min("v").alias("v"))
    return roots.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", F.col("v")).distinct())


def _grouped(docs: DataFrame, shingle: int, distance: int, blocks: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and of each distinct one (``print``) its first doc_id and root."""
    marked = written(fingerprints(docs, shingle, seed), "prints")
    nodes = marked.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    tree = components(links(nodes.select("print"), distance, blocks))
    roots = nodes.join(tree, F.col("print") == F.col("node"), "left")
    return marked, roots.select(F.col("print").alias("p"), "first_id", F.coalesce("root", "print").alias("root"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS, seed: int = SEED
) -> DataFrame:
    """doc_id, fingerprint and component of every row, one row for each.

    Equal fingerprints are one node, so copies cost a count, not links. Texts without words
    (null, empty, blank) share the fingerprint zero. Null doc_id: it takes part, but never
    names a component while another id does. Repeated rows stay. Empty table: no rows.
    """
    marked, roots = _grouped(docs, shingle, distance, blocks, seed)
    names = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = roots.join(names, "root").select("p", "component_id")
    return marked.join(named, F.col("print") == F.col("p")).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def distinct(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS, seed: int = SEED
) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest doc_id (a null one
    last), of the smallest text hash among rows that share it, and of the smallest hash of the whole
    row among those with equal id and text."""
    marked, roots = _grouped(docs, shingle, distance, blocks, seed)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("th").alias("hash"))
    # copies are counted out before the join: a print is one row there
    heads = marked.groupBy("print").agg(F.min(order).alias("o"))
    first = heads.join(roots, F.col("print") == F.col("p")).groupBy("root").agg(F.min("o").alias("o")).select("o.id", "o.hash")
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"), F.xxhash64(F.col("text").cast("string")).alias("th")
    )
    kept = rows.join(first, F.col("key").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash")), "left_semi")
    one = kept.groupBy("key", "th").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*")
