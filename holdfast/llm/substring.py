"""Substring deduplication: shards of an FM-index, searched by the passages that reach them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.arrays import NOT_SPACE, blocks, ragged, span_hashes, split, text_blocks, utf8, word_codes, word_hashes
from holdfast.llm.fm_index import FMIndex
from holdfast.llm.tables import texts, written

#: Words of a window, the threshold of a match.
WINDOW = 13
#: Words of the grams whose smallest hash in a window decides the shard it goes to.
GRAM = 4
#: Words of a shard's index, about.
SHARD_WORDS = 1_000_000
#: A selector found in more documents than this is split: its windows are dealt one by one.
WIDE_DOCUMENTS = 10_000
#: One document in so many is looked at beforehand for selectors that many documents share.
PROBE = 16


def selectors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Smallest gram hash of the window at each word: equal windows have equal selectors, and
    neighbouring windows mostly share theirs."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.arange(len(hashes) - gram + 1)
    low, width, wide = span_hashes(hashes, at, at + gram), 1, window - gram + 1
    while 2 * width <= wide:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[: n], low[wide - width : wide - width + n]).view(np.int64)


def _windows(docs: list[bytes], window: int, gram: int):
    """Words, hashes, selectors and document of the windows, and which windows lie in one document."""
    words = split(docs, NOT_SPACE)
    hashes = word_hashes(words)
    chosen = selectors(hashes, window, gram)
    who = words.text()
    inside = who[: len(chosen)] == who[window - 1 :] if len(chosen) else np.zeros(0, bool)
    return words, hashes, chosen, who[: len(chosen)], inside


def _pairs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(selector, doc_id) of every document, mostly once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, hi, data in text_blocks(batch.column(1)):
                _, _, chosen, who, inside = _windows(data, window, gram)
                chosen, who = chosen[inside], who[inside]
                new = np.ones(len(chosen), bool)
                new[1:] = (chosen[1:] != chosen[:-1]) | (who[1:] != who[:-1])
                yield pa.record_batch([pa.array(chosen[new]), pa.array(ids[lo:hi][who[new]])], names=["m", "doc_id"])

    return docs.mapInArrow(run, "m long, doc_id long")


def _hot(docs: DataFrame, window: int, gram: int, wide: int, probe: int) -> DataFrame:
    """Selectors so common in one document of ``probe`` that about ``wide`` of all hold them.

    This finds what to spread before the shuffle; the result does not depend on it, since
    whatever it misses or names without need is dealt another way and compared all the same.
    """
    seen = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(probe)) == 0)
    counts = _pairs(seen, window, gram).groupBy("m").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > max(1, wide // probe)).select("m")


def _shared(pairs: DataFrame, hot: DataFrame, wide: int) -> DataFrame:
    """Pairs whose selector is in two documents or more; (selector, null) where in over ``wide``.

    Reads each partition in order of selector and holds no group: a selector's first document
    waits for the second, the rest pass through. Pairs of hot selectors need no such company,
    so their documents are spread over the partitions.
    """
    common = hot.select(F.col("m").alias("hot"))
    spread = F.when(F.col("hot").isNotNull(), F.xxhash64("doc_id"))
    dealt = pairs.join(common, F.col("m") == F.col("hot"), "left").repartition("m", spread).sortWithinPartitions("m", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (0, 0, 0)  # selector, document and number of documents of the open group
        for batch in batches:
            m, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            common = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            yield _rows(m[common], d[common])
            m, d = np.append(last[0], m[~common]), np.append(last[1], d[~common])
            new = np.ones(len(m), bool)
            new[1:] = (m[1:] != m[:-1]) | (d[1:] != d[:-1])
            if not last[2]:
                new[0] = False
                if len(m) > 1:
                    new[1] = True
            m, d = m[new], d[new]
            if not len(m):
                continue
            begin = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
            size = np.diff(np.append(begin, len(m)))
            total = size.copy()
            if last[2]:
                total[0] += last[2] - 1
            emit = np.repeat(total > 1, size)
            if last[2] > 1:
                emit[0] = False  # written with the batch before
            closed = m[begin[:-1]][total[:-1] > wide]
            if total[-1] == 1:
                emit[-1] = False
            yield _rows(m[emit], d[emit])
            yield _rows(closed, None)
            last = (m[-1], d[-1], int(total[-1]))
        if last[2] > wide:
            yield _rows(np.array([last[0]]), None)

    def _rows(m: np.ndarray, d: np.ndarray | None) -> pa.RecordBatch:
        docs = pa.nulls(len(m), pa.int64()) if d is None else pa.array(d)
        return pa.record_batch([pa.array(m, pa.int64()), docs], names=["m", "doc_id"])

    found = dealt.select("m", "doc_id", "hot").mapInArrow(run, "m long, doc_id long")
    return found.union(hot.select("m", F.lit(None).cast("long")))


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed, with a hash that tells texts of one doc_id apart: what a shuffle moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data = pa.array([press.compress(t) for t in utf8(batch.column(1))], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(2), data], names=["doc_id", "th", "data"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(run, "doc_id long, th long, data binary")


def _unpacked(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of rows of about a block together, with their texts."""
    press = zstandard.ZstdDecompressor()
    sizes = [zstandard.frame_content_size(x) for x in column.to_pylist()]
    for lo, hi in blocks(sizes, size=lambda n: n):
        yield lo, hi, [press.decompress(x) for x in column.slice(lo, hi - lo).to_pylist()]


def _segments(packed: DataFrame, shared: DataFrame, window: int, gram: int) -> DataFrame:
    """Runs of windows of one shared selector: where they begin, how many, and their words."""
    wide = shared.filter("doc_id IS NULL").select(F.col("m").alias("wide_m"))
    pairs = shared.filter("doc_id IS NOT NULL").join(wide, F.col("m") == F.col("wide_m"), "left")
    lists = pairs.groupBy(F.col("doc_id").alias("id")).agg(
        F.collect_list(F.expr("CASE WHEN wide_m IS NULL THEN m END")).alias("narrow"), F.collect_list("wide_m").alias("wide")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data in _unpacked(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                words, hashes, chosen, who, inside = _windows(data, window, gram)
                # a selector is shared whoever lists it, so one set serves the block
                narrow, wide = (np.unique(part.column(c).flatten().to_numpy()) for c in (3, 4))
                alone = np.flatnonzero(inside & np.isin(chosen, wide))
                joined = np.flatnonzero(inside & np.isin(chosen, narrow))
                begins = np.ones(len(joined), bool)
                begins[1:] = (np.diff(joined) > 1) | (chosen[joined[1:]] != chosen[joined[:-1]]) | (who[joined[1:]] != who[joined[:-1]])
                first = np.flatnonzero(begins)
                starts = np.concatenate([joined[first], alone])
                counts = np.concatenate([np.diff(np.append(first, len(joined))), np.ones(len(alone), np.int64)])
                keys = np.concatenate([chosen[joined[first]], span_hashes(hashes, alone, alone + window).view(np.int64)])
                size = words.ends - words.starts + 1
                plain = words.data[ragged(words.starts, size)]
                ends = np.cumsum(size)
                plain[ends - 1] = 32
                plain = plain.tobytes()
                begin, end = (ends - size)[starts], ends[starts + counts + window - 2] - 1
                text = pa.array([plain[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()).cast(pa.string())
                doc = who[starts]
                where = starts - words.first[doc]
                yield pa.record_batch(
                    [part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)), pa.array(where), pa.array(counts), pa.array(keys), text],
                    names=["doc_id", "th", "start", "n", "m", "seg"],
                )

    joined = packed.join(lists, F.col("doc_id") == F.col("id")).select("doc_id", "th", "data", "narrow", "wide")
    return joined.mapInArrow(run, "doc_id long, th long, start long, n long, m long, seg string")


def _digest() -> Column:
    return F.unhex(F.sha2("seg", 256))


def _repeats(segments: DataFrame, window: int, shard_words: int) -> DataFrame:
    """Segment texts that repeat: their first document and, for it, the windows that also stand
    in a segment of a smaller one.

    Copies of a segment meet in one row before the shuffle. A shard numbers the words of its
    segments, indexes these and streams each of them backwards through the index. Hashes of
    words only choose the shard; ``k`` is the SHA-256 of a segment's text.
    """
    total = segments.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    classes = segments.groupBy("m", "seg").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"))
    dealt = classes.select(F.pmod(F.xxhash64("m"), F.lit(shards)).alias("shard"), "m", _digest().alias("k"), "seg", "d0", "d1")

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        words = split(utf8(table["seg"].combine_chunks()), NOT_SPACE)
        d0 = table["d0"].to_numpy()
        owners = np.unique(d0, return_inverse=True)[1]
        windows = np.diff(words.first) - window + 1
        index = FMIndex(word_codes(words), words.first, owners, window)
        ends = ragged(words.first[:-1] + window - 1, windows)
        again = index.matching(ends, np.repeat(owners, windows), window) == window
        cuts = np.concatenate([[0], np.cumsum(windows)])
        some = np.add.reduceat(again, cuts[:-1], dtype=np.int64) > 0
        keep = np.flatnonzero(some | (table["d1"].to_numpy() > d0))
        bits = [np.packbits(again[cuts[i] : cuts[i + 1]]).tobytes() if some[i] else None for i in keep.tolist()]
        return table.select(["m", "k", "d0"]).take(pa.array(keep)).append_column("bits", pa.array(bits, pa.binary()))

    return dealt.groupBy("shard").applyInArrow(search, "m long, k binary, d0 long, bits binary")


def removals(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS, wide: int = WIDE_DOCUMENTS,
    probe: int = PROBE,
) -> DataFrame:
    """doc_id, text hash (``th``) and the repeated runs of windows of documents that have any.

    A run is a start word and a number of windows, or the bits of those that repeat.
    """
    known = texts(docs).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    hot = written(_hot(known, window, gram, wide, probe), "hot-selectors")
    shared = written(_shared(_pairs(known, window, gram), hot, wide), "shared-selectors")
    segments = written(_segments(_packed(known), shared, window, gram), "segments")
    repeats = written(_repeats(segments, window, shard_words), "repeats").select(F.col("m").alias("rm"), F.col("k").alias("rk"), "d0", "bits")
    found = segments.select("doc_id", "th", "start", "n", "m", _digest().alias("k")).join(
        repeats, (F.col("m") == F.col("rm")) & (F.col("k") == F.col("rk")) & ((F.col("doc_id") > F.col("d0")) | F.col("bits").isNotNull())
    )
    run = F.struct("start", "n", F.expr("CASE WHEN doc_id = d0 THEN bits END").alias("bits"))
    return found.groupBy("doc_id", "th").agg(F.collect_list(run).alias("runs"))


def deduplicate(docs: DataFrame, window: int = WINDOW, **settings) -> DataFrame:
    """Every row with its number of words, the words removed, the word intervals they make
    (begin, end after the last) and the kept words joined by a blank.

    A word goes if a window of ``window`` words that covers it starts in a document with a
    smaller doc_id. Null text: no words. Null doc_id: smaller than none and larger than none,
    so the row is kept whole. Rows that share a doc_id take nothing from each other. Repeated
    rows stay. Empty table: no rows.
    """
    found = removals(docs, window, **settings).select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).to_pylist()
            for lo, hi, data in _unpacked(batch.column(1)):
                out = [_kept(t, r, window) for t, r in zip(data, rows[lo:hi])]
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string())
                made = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)]
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *made], names=["doc_id", "n_words", "n_removed", "intervals", "kept"])

    joined = _packed(texts(docs)).join(found, (F.col("doc_id") == F.col("id")) & (F.col("th") == F.col("hash")), "left")
    return joined.select("doc_id", "data", "runs").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, intervals array<array<long>>, kept string"
    )


def _kept(text: bytes, runs: list[dict] | None, window: int) -> tuple[int, int, list, str]:
    words = text.split()
    if not runs:
        return len(words), 0, [], b" ".join(words).decode()
    change = np.zeros(len(words) + 1, np.int64)
    for run in runs:
        at = run["start"] + np.arange(run["n"])
        if run["bits"] is not None:
            at = at[np.unpackbits(np.frombuffer(run["bits"], np.uint8), count=run["n"]).astype(bool)]
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
    gone = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
    kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
    return len(words), int(gone.sum()), edges.reshape(-1, 2).tolist(), kept.decode()


def cut(docs: DataFrame, window: int = WINDOW, **settings) -> DataFrame:
    """Every row with all its columns; a text with repeated windows becomes its kept words,
    joined by a blank, and others stay as they are. The cases are those of ``deduplicate``."""

    @F.udf("string", useArrow=True)
    def kept(text, runs):
        return _kept(text.encode(), runs, window)[3] if runs else None

    found = removals(docs, window, **settings).select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), "runs")
    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"), text.alias("whole"), F.xxhash64(text).alias("th"))
    joined = rows.join(found, (F.col("key") == F.col("id")) & (F.col("th") == F.col("hash")), "left")
    now = F.when(F.col("runs").isNull(), F.col("whole")).otherwise(kept(F.when(F.col("runs").isNotNull(), F.col("whole")), "runs"))
    return joined.select(F.col("row").withField("text", now).alias("row")).select("row.*")
