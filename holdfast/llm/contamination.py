"""Benchmark contamination by a stored positional inverted index of the documents.

The index holds, segment by segment, the terms of about SEGMENT_BYTES of text, how often each
occurs and where. Term counts come from it, each window of a benchmark item is sent by its rarest
term to the segments that hold this term, and there the lists of its terms are intersected, rarest
first, shifted by their place in the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.arrays import ALNUM, blocks, ragged, split, text_blocks, utf8, word_array
from holdfast.llm.tables import PLAIN_READS, texts, written

WINDOW = 13
#: Words a term of a proximity match may stand off its place.
SLOP = 2
#: Text of an index segment, about.
SEGMENT_BYTES = 4 << 20
#: Terms and places of a row of the index, about; a segment with more has further rows.
ROW_BYTES = 1 << 20
#: Text that a task of the index holds at once, about.
BATCH_BYTES = 16 << 20
#: Windows looked for in a segment at once; more come after them.
BUCKET_WINDOWS = 1 << 16
#: Row groups of the index, so that neither its writers nor its readers hold a file's rows at once: a
#: reader of lists takes up to 4,096 rows together.
_INDEX_FILES = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", **PLAIN_READS}


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES, row_bytes: int = ROW_BYTES) -> DataFrame:
    """The documents of each segment (doc_id, text hash, number of words) and its postings.

    ``terms`` are the distinct words, ``places`` the word numbers of each, as 32-bit integers; words are
    numbered through the segment's documents. A segment whose postings exceed ``row_bytes`` has several
    rows, each with some of the terms; its documents stand in the first. Nothing is shuffled: a segment
    is text that one task reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for lo, hi in blocks(sizes, size=lambda n: n, limit=segment_bytes):
                part = batch.slice(lo, hi - lo)
                words = split(utf8(part.column(1)), ALNUM, lower=True)
                spelt = word_array(words).dictionary_encode()
                codes = spelt.indices.to_numpy(zero_copy_only=False)
                cuts = 4 * np.cumsum(np.append(0, np.bincount(codes, minlength=len(spelt.dictionary)))).astype(np.int32)
                order = np.argsort(codes, kind="stable").astype("<i4")
                places = pa.BinaryArray.from_buffers(pa.binary(), len(spelt.dictionary), [None, pa.py_buffer(cuts), pa.py_buffer(order)])
                terms = spelt.dictionary.cast(pa.binary())
                owned = [part.column(0), part.column(2), pa.array(np.diff(words.first), pa.int64())]
                size = pc.binary_length(terms).to_numpy(zero_copy_only=False) + np.diff(cuts)
                for a, b in blocks(size.tolist(), size=int, limit=row_bytes) if len(terms) else [(0, 0)]:
                    columns = [_list(c.cast(pa.int64()).slice(0, None if a == 0 else 0)) for c in owned]
                    columns += [_list(terms.slice(a, b - a)), _list(places.slice(a, b - a))]
                    yield pa.record_batch([pa.array([number], pa.int64()), *columns], names=["segment", "doc_ids", "hashes", "n_words", "terms", "places"])
                number += 1

    rows = texts(docs).withColumn("th", F.xxhash64("text")).mapInArrow(
        run, "segment long, doc_ids array<long>, hashes array<long>, n_words array<long>, terms array<binary>, places array<binary>"
    )
    return written(rows, "postings", {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}, **_INDEX_FILES)


def _list(values: pa.Array) -> pa.ListArray:
    """The values as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def documents(index: DataFrame) -> DataFrame:
    """segment, slot, doc_id, text hash (``th``) and n_words of every document of the index."""
    each = F.posexplode(F.arrays_zip(F.col("doc_ids"), F.col("hashes"), F.col("n_words"))).alias("slot", "d")
    return index.select("segment", each).select(
        "segment", "slot", F.col("d.doc_ids").alias("doc_id"), F.col("d.hashes").alias("th"), F.col("d.n_words").alias("n_words")
    )


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item and phrase (words joined by a blank) of each window of each item; an item of fewer
    words, but not none, is one window. Null item_id: an item with an empty id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, hi, data in text_blocks(batch.column(1)):
                words = split(data, ALNUM, lower=True)
                spelt = word_array(words).to_pylist()
                found = []
                for i in range(hi - lo):
                    own = spelt[words.first[i] : words.first[i + 1]]
                    n = min(window, len(own))
                    found += [(names[lo + i], b" ".join(own[at : at + n])) for at in range(len(own) - n + 1 if n else 0)]
                columns = zip(*found) if found else ((), ())
                yield pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.binary()))], names=["item", "phrase"])

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(run, "item string, phrase binary").distinct()


def _terms(phrase: str = "phrase") -> Column:
    """Words of a phrase; none of their bytes is a blank."""
    return F.split(F.decode(phrase, "ISO-8859-1"), " ")


def _wanted_postings(windows: DataFrame, index: DataFrame) -> DataFrame:
    """segment, term and places of the terms that any window holds. The terms are a written table, so
    Spark knows how many they are when it chooses between broadcasting them and a shuffle."""
    terms = written(windows.select(F.explode(_terms()).alias("term")).distinct(), "item-terms")
    held = index.select("segment", F.inline(F.arrays_zip(F.col("terms"), F.col("places"))))
    held = held.select("segment", F.decode("terms", "ISO-8859-1").alias("term"), "places")
    return held.join(terms, "term", "left_semi").select("segment", "term", "places")


def _ranked(windows: DataFrame, postings: DataFrame) -> DataFrame:
    """w, phrase, rarest term and the places of the terms in the phrase, rarest first (``ranks``), of
    windows whose terms the index holds; how rare a term is is counted over the whole index."""
    words = windows.select("w", F.posexplode(_terms()).alias("place", "term"))
    counts = postings.groupBy("term").agg(F.sum(F.octet_length("places") / 4).cast("long").alias("n"))
    order = F.sort_array(F.collect_list(F.struct("n", "place", "term"))).alias("order")
    ranked = words.join(counts, "term").groupBy("w").agg(order)
    ranked = ranked.join(windows, "w").filter(F.size("order") == F.size(_terms()))
    return ranked.select("w", "phrase", F.col("order")[0]["term"].alias("rarest"), F.col("order.place").alias("ranks"))


def _routed(ranked: DataFrame, postings: DataFrame) -> DataFrame:
    """The windows of each segment: those whose rarest term it holds."""
    return postings.select("segment", "term").join(ranked, F.col("term") == F.col("rarest")).select("segment", "w", "phrase", "ranks")


class Segment:
    """Postings of one segment. Places are the stored word numbers, with a gap between documents, so
    that no phrase joins two."""

    def __init__(self, terms: pa.Array, counts: np.ndarray, places: np.ndarray, n_words: np.ndarray, gap: int):
        self.terms, self.gap = terms, gap
        self.first = np.concatenate([[0], np.cumsum(n_words)])
        self.begins = np.concatenate([[0], np.cumsum(counts)])
        self.span = int(self.first[-1]) + gap * (len(n_words) + 2)
        spread = places + gap * np.searchsorted(self.first, places, side="right")
        self.keys = np.repeat(np.arange(len(counts), dtype=np.int64), counts) * self.span + spread

    def matches(self, windows: np.ndarray, ranks: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Window numbers and start places where every term stands within ``slop`` of its place.

        ``windows`` has the numbers of the terms, ``ranks`` their places, rarest first. The list of
        the rarest term gives the candidates; the others, rarest first, thin them out.
        """
        rows = np.arange(len(windows))
        anchor = windows[rows, ranks[:, 0]]
        n = self.begins[anchor + 1] - self.begins[anchor]
        who = np.repeat(rows, n)
        starts = self.keys[ragged(self.begins[anchor], n)] - windows[who, ranks[who, 0]] * self.span - ranks[who, 0]
        if slop:
            shifts = np.arange(-slop, slop + 1)
            who, starts = np.repeat(who, len(shifts)), (starts[:, None] + shifts).ravel()
        for k in range(0 if slop else 1, windows.shape[1]):
            place = ranks[who, k]
            low = windows[who, place] * self.span + starts + place - slop
            hit = np.searchsorted(self.keys, low)
            ok = hit < len(self.keys)
            ok[ok] = self.keys[hit[ok]] <= low[ok] + 2 * slop
            who, starts = who[ok], starts[ok]
        return who, starts

    def slot(self, places: np.ndarray) -> np.ndarray:
        """Document of each place."""
        begins = self.first[:-1] + self.gap * (1 + np.arange(len(self.first) - 1))
        return np.searchsorted(begins, places, side="right") - 1


def _found(segment: Segment, phrases: list[bytes], ranks: list[list[int]], slop: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(slot, window, start, words, exact) arrays of the matches, for windows of one length at a time."""
    words = [p.split(b" ") for p in phrases]
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == n)
        flat = pa.array([t for i in own.tolist() for t in words[i]], pa.binary())
        codes = pc.fill_null(pc.index_in(flat, value_set=segment.terms), -1).to_numpy(zero_copy_only=False).reshape(-1, n).astype(np.int64)
        here = np.flatnonzero((codes >= 0).all(axis=1))
        order = np.array([ranks[i] for i in own[here].tolist()], np.int64).reshape(-1, n)
        for reach in (0, slop) if slop else (0,):
            who, starts = segment.matches(codes[here], order, reach)
            slot = segment.slot(starts + segment.gap // 2)
            yield slot, own[here][who], starts - segment.first[slot] - segment.gap * (slot + 1), n, reach == 0


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """The intervals, overlapping ones as one."""
    order = np.argsort(starts, kind="stable")
    starts, upto = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > upto[:-1])
    return list(zip(starts[new].tolist(), upto[np.append(new[1:], True)].tolist()))


def _looked_up(number: int, segment: Segment, windows: list[tuple[int, bytes, list[int]]], slop: int) -> pa.RecordBatch:
    """A row for each document of the segment that has a match of the windows."""
    ws, phrases, ranks = (list(c) for c in zip(*windows))
    ws = np.array(ws)
    rows: dict[int, tuple[list, list, set, set]] = {}
    for slot, who, starts, n, exact in _found(segment, phrases, ranks, slop):
        order = np.argsort(slot, kind="stable")
        slot, who, starts = slot[order], who[order], starts[order]
        cuts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, int)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(slot)]):
            begins, ends, held, near = rows.setdefault(int(slot[a]), ([], [], set(), set()))
            (held if exact else near).update(ws[who[a:b]].tolist())
            if exact:
                begins.append(starts[a:b])
                ends.append(starts[a:b] + n)
    made = [
        (number, slot, _merged(np.concatenate(begins), np.concatenate(ends)) if begins else [], sorted(held), sorted(near))
        for slot, (begins, ends, held, near) in sorted(rows.items())
    ]
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.list_(pa.int64()), pa.list_(pa.int64()))
    columns = [list(c) for c in zip(*made)] if made else [[] for _ in kinds]
    columns[2] = [[{"a": a, "b": b} for a, b in x] for x in columns[2]]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["segment", "slot", "spans", "ws", "near"])


def _segment(n_words: list[np.ndarray], terms: list[pa.Array], places: list[pa.Array], gap: int) -> Segment:
    lists = pa.chunked_array(places, pa.binary())
    counts = pc.binary_length(lists).to_numpy() // 4
    numbers = np.frombuffer(b"".join(lists.to_pylist()), "<i4").astype(np.int64)
    return Segment(pa.chunked_array(terms, pa.binary()).combine_chunks(), counts, numbers, np.concatenate(n_words), gap)


def matches(
    index: DataFrame, postings: DataFrame, routed: DataFrame, slop: int = 0, bucket_windows: int = BUCKET_WINDOWS, window: int = WINDOW
) -> DataFrame:
    """segment, slot, the word intervals inside exact matches, the windows matched exactly (``ws``) and
    those with a proximity match (``near``), of documents that have any.

    A segment's documents, postings and windows come to a task in this order, as rows of one sorted
    frame: a task holds one segment and ``bucket_windows`` windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, segment, windows = None, ([], [], []), None, []
        for batch in batches:
            of, kinds = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (kinds[1:] != kinds[:-1]))) if len(of) else np.zeros(0, int)
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(of)]):
                if of[a] != number:
                    if windows:
                        yield _looked_up(number, segment, windows, slop)
                    number, parts, segment, windows = int(of[a]), ([], [], []), None, []
                at, n_words, words, places, ranks = (batch.column(i).slice(a, b - a) for i in range(2, 7))
                if kinds[a] == 0:
                    parts[0].append(n_words.to_numpy())
                elif kinds[a] == 1:
                    parts[1].append(words)
                    parts[2].append(places)
                else:
                    segment = segment or _segment(*parts, window + 2 * slop + 2)
                    windows += zip(at.to_pylist(), words.to_pylist(), ranks.to_pylist())
                    while len(windows) > bucket_windows:
                        yield _looked_up(number, segment, windows[:bucket_windows], slop)
                        windows = windows[bucket_windows:]
        if windows:
            yield _looked_up(number, segment, windows, slop)

    def rows(frame: DataFrame, kind: int, **columns: Column) -> DataFrame:
        held = {"number": "long", "n_words": "long", "words": "binary", "places": "binary", "ranks": "array<int>"}
        each = [columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in held.items()]
        return frame.select("segment", F.lit(kind).alias("kind"), *each)

    stream = rows(documents(index), 0, number=F.col("slot"), n_words=F.col("n_words"))
    stream = stream.unionByName(rows(postings, 1, words=F.encode("term", "ISO-8859-1"), places=F.col("places")))
    stream = stream.unionByName(rows(routed, 2, number=F.col("w"), words=F.col("phrase"), ranks=F.col("ranks")))
    stream = stream.repartition("segment").sortWithinPartitions("segment", "kind", "number")
    return stream.mapInArrow(run, "segment long, slot int, spans array<struct<a: long, b: long>>, ws array<long>, near array<long>")


def _union_length(spans: Column) -> Column:
    """Words inside any of the intervals."""
    state = lambda n, upto: F.struct(n.alias("n"), upto.alias("upto"))
    step = lambda s, x: state(
        s["n"] + F.greatest(F.lit(0).cast("long"), x["b"] - F.greatest(x["a"], s["upto"])), F.greatest(s["upto"], x["b"])
    )
    zero = F.lit(0).cast("long")
    return F.aggregate(F.array_sort(spans), state(zero, zero), step, lambda s: s["n"])


def search(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = SLOP, segment_bytes: int = SEGMENT_BYTES,
    bucket_windows: int = BUCKET_WINDOWS, row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """Every row by doc_id and text hash (``th``), with its word count, the words hit (``n_hit``, inside
    an exact match), their intervals (``spans``), the items matched exactly (``item_ids``) and those with
    a window whose terms all stand within ``slop`` words of their places (``near_ids``; empty for a slop
    of 0).

    The postings are a written table; a lost executor costs no more than its own tasks. Windows go to
    segments by Spark's joins, which broadcast only what their size checks allow. Null or empty texts
    and items have no words. Items that share an id are one item. Null doc_id and repeated rows stay;
    empty tables give no rows or no hits.
    """
    index = build_index(docs, segment_bytes, row_bytes)
    phrases = written(item_windows(items, window), "item-phrases")
    windows = written(phrases.select("phrase").distinct().withColumn("w", F.monotonically_increasing_id()), "item-windows")
    owners = phrases.join(windows, "phrase").select("w", "item")
    postings = _wanted_postings(windows, index)
    ranked = written(_ranked(windows, postings), "ranked-windows")
    found = written(matches(index, postings, _routed(ranked, postings), slop, bucket_windows, window), "phrase-matches")

    spans = found.groupBy("segment", "slot").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    hits = spans.select(F.col("segment").alias("s"), F.col("slot").alias("p"), "spans", _union_length(F.col("spans")).alias("n_hit"))

    def named(column: str, out: str) -> DataFrame:
        each = found.select("segment", "slot", F.explode(column).alias("w")).join(owners, "w").select("segment", "slot", "item").distinct()
        return each.groupBy(F.col("segment").alias(f"{out}_s"), F.col("slot").alias(f"{out}_p")).agg(F.array_sort(F.collect_list("item")).alias(out))

    rows = documents(index).join(hits, (F.col("segment") == F.col("s")) & (F.col("slot") == F.col("p")), "left")
    for column, out in (("ws", "item_ids"), ("near", "near_ids")) if slop else (("ws", "item_ids"),):
        rows = rows.join(named(column, out), (F.col("segment") == F.col(f"{out}_s")) & (F.col("slot") == F.col(f"{out}_p")), "left")
    none = F.array().cast("array<string>")
    ids = lambda c: F.coalesce(F.col(c), none).alias(c)
    return rows.select(
        "doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "spans", ids("item_ids"),
        ids("near_ids") if slop else none.alias("near_ids"),
    )


def contamination(docs: DataFrame, items: DataFrame, share: int = 20, **settings) -> DataFrame:
    """Counts and verdict of every row by exact matches: contaminated from one hit word in
    ``share`` on. The cases are those of ``search``."""
    return search(docs, items, slop=0, **settings).select(
        "doc_id", "th", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """Rows that are not contaminated, with all their columns. Rows of one doc_id and text have one
    verdict, so the contaminated ones, by these two, take them out."""
    bad = contamination(docs, items, **settings).filter("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("th").alias("bad_th")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    return rows.join(bad, F.col("key").eqNullSafe(F.col("bad_id")) & (F.col("th") == F.col("bad_th")), "left_anti").select("row.*")
