"""Token-id files of directly addressable codes: any token is read without decoding a block.

Ids are cut into chunks of 8 bits, lowest first. Level 0 holds the first chunk of every id;
a bitmap beside it marks the ids that go on, whose next chunks make level 1, and so on. The
number of marks before a position, from a directory and one short count, is the position on
the next level.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.arrays import ragged
from holdfast.llm.bpe import encoded_blocks
from holdfast.llm.tables import texts

END_ID = 2
#: Bits of a bitmap for each entry of its rank directory.
RANK_BITS = 512
#: One row of a file: documents of about arrays.BLOCK_BYTES of text, in order.
FILE_ROW = "part int, block int, start long, n_tokens long, doc_ids binary, has_id binary, ranges binary, codes binary"


def pack(ids: np.ndarray) -> bytes:
    """Codes of the ids: number of levels; for each, its length, chunks, bitmap and directory."""
    parts, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        parts.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes())
        if not more.any():
            return struct.pack("<I", len(parts)) + b"".join(parts)
        bits = np.packbits(more, bitorder="little")
        words = np.zeros(-(-len(more) // RANK_BITS) * (RANK_BITS // 8), np.uint8)
        words[: len(bits)] = bits
        ones = np.bitwise_count(words.view("<u8")).reshape(-1, RANK_BITS // 64).sum(axis=1, dtype=np.int64)
        parts[-1] += words.tobytes() + (np.cumsum(ones) - ones).astype("<u8").tobytes()
        rest = rest[more] >> np.uint32(8)


class Codes:
    """Read access to packed ids."""

    def __init__(self, data: bytes):
        (n_levels,) = struct.unpack_from("<I", data)
        at, self.levels = 4, []
        for level in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n
            if level + 1 == n_levels:
                self.levels.append((chunks, None, None))
                break
            groups = -(-n // RANK_BITS)
            bits = np.frombuffer(data, "<u8", groups * RANK_BITS // 64, at)
            at += groups * RANK_BITS // 8
            self.levels.append((chunks, bits, np.frombuffer(data, "<u8", groups, at).astype(np.int64)))
            at += 8 * groups

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def get(self, places: np.ndarray) -> np.ndarray:
        """Ids at any places, by rank steps down the levels."""
        ids, here, on = np.zeros(len(places), np.uint32), np.asarray(places, np.int64), np.arange(len(places))
        for level, (chunks, bits, directory) in enumerate(self.levels):
            ids[on] |= chunks[here].astype(np.uint32) << np.uint32(8 * level)
            if bits is None:
                break
            word = here >> 6
            goes = (bits[word] >> (here & 63).astype(np.uint64)) & np.uint64(1) == 1
            on, here, word = on[goes], here[goes], word[goes]
            group = here // RANK_BITS
            rank = directory[group]
            first = group * (RANK_BITS // 64)
            for k in range(RANK_BITS // 64 - 1):
                rank = rank + np.where(first + k < word, np.bitwise_count(bits[np.minimum(first + k, len(bits) - 1)]), 0)
            below = (np.uint64(1) << (here & 63).astype(np.uint64)) - np.uint64(1)
            here = rank + np.bitwise_count(bits[word] & below)
        return ids

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        ids, on = np.zeros(len(self), np.uint32), slice(None)
        for level, (chunks, bits, _) in enumerate(self.levels):
            ids[on] |= chunks.astype(np.uint32) << np.uint32(8 * level)
            if bits is not None:
                goes = np.flatnonzero(np.unpackbits(bits.view(np.uint8), count=len(chunks), bitorder="little"))
                on = goes if level == 0 else on[goes]
        return ids


def write(docs: DataFrame, source: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of every text and its end id as files in ascending doc_id order.

    Texts are dealt to ranges of doc_id found from that column alone, then encoded and packed
    where they land. Null doc_id comes first; null text is empty; repeated rows stay, each
    with its ids; an empty table makes empty files.
    """
    spread = docs.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts: dict[int, int] = {}
        block = 0
        for keys, ids, ranges in encoded_blocks(_same_part(batches), spread.value):
            part = keys.field("part")[0].as_py()
            doc_ids = keys.field("doc_id")
            n = len(doc_ids)
            ended = np.full(len(ids) + n, end_id, np.uint32)
            ended[ragged(ranges[:-1] + np.arange(n), np.diff(ranges))] = ids
            bounds = ranges + np.arange(n + 1)
            start = starts.get(part, 0)
            starts[part] = start + len(ended)
            row = {
                "part": part, "block": block, "start": start, "n_tokens": len(ended),
                "doc_ids": doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                "has_id": np.packbits(doc_ids.is_valid().to_numpy(zero_copy_only=False)).tobytes(),
                "ranges": bounds.astype("<i8").tobytes(), "codes": pack(ended),
            }
            yield pa.RecordBatch.from_pylist([row], schema=_ARROW_ROW)
            block += 1

    dealt = _in_order(docs)
    rows = dealt.select(F.struct("doc_id", "part").alias("key"), "text").mapInArrow(run, FILE_ROW)
    rows.write.option("compression", "zstd").parquet(path)


_ARROW_ROW = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
     ("doc_ids", pa.binary()), ("has_id", pa.binary()), ("ranges", pa.binary()), ("codes", pa.binary())]
)


def _same_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where the part changes."""
    for batch in batches:
        parts = batch.column(0).field("part").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text and part: parts are ranges of doc_id, in order, each sorted in one task."""
    spark = docs.sparkSession
    rows = texts(docs)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / n_parts for i in range(1, n_parts)]
    cuts = rows.agg(F.percentile_approx("doc_id", steps, 20 * n_parts).alias("c")).first()["c"] if steps else []
    cuts = sorted(set(cuts or []))
    part = F.lit(0)
    if cuts:
        table = F.array(*(F.lit(c) for c in cuts))
        part = F.coalesce(F.size(F.filter(table, lambda c: c < F.col("doc_id"))), F.lit(0))
    marked = rows.select("doc_id", "text", F.when(F.col("doc_id").isNull(), 0).otherwise(part).cast("int").alias("part"))
    return marked.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "doc_id")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids before it), n_tokens and unsigned crc32 of its ids."""
    rows = spark.read.schema(FILE_ROW).parquet(path)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row for each part: as many as there were tasks, not documents
    bases = sizes.select(F.col("part").alias("p"), F.expr("sum(n) OVER (ORDER BY part) - n").alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Codes(row["codes"]).all().astype("<u4")
                ranges = np.frombuffer(row["ranges"], "<i8")
                n = len(ranges) - 1
                known = np.unpackbits(np.frombuffer(row["has_id"], np.uint8), count=n).astype(bool)
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ranges, ranges[1:])]
                yield pa.record_batch(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=~known),
                        pa.array(row["start"] + ranges[:-1]), pa.array(np.diff(ranges)), pa.array(sums, pa.int64()),
                    ],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    found = rows.mapInArrow(run, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(bases, F.col("part") == F.col("p")).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokens_at(spark: SparkSession, path: str, part: int, places: list[int]) -> dict[int, int]:
    """Ids at places of a part: only the blocks that hold them are read, and of these only the codes asked for."""
    rows = spark.read.schema(FILE_ROW).parquet(path).filter(F.col("part") == part)
    held = F.exists(F.lit(places).cast("array<long>"), lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("n_tokens")))
    out = {}
    for row in rows.filter(held).select("start", "n_tokens", "codes").toLocalIterator():
        own = [p for p in places if row.start <= p < row.start + row.n_tokens]
        out.update(zip(own, Codes(row.codes).get(np.array(own) - row.start).tolist()))
    return out
