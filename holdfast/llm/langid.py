"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.arrays import sums_by, text_blocks
from holdfast.llm.bpe import LETTER, _classes, code_points
from holdfast.llm.tables import texts

#: n-grams are hashed to this many buckets for each order.
BITS = 15
ORDERS = (1, 2, 3)
#: Labelled rows the model is fitted on, about; an equal share of each language, rare languages
#: whole, chosen by a hash of doc_id.
SAMPLE_ROWS = 20_000
SMOOTHING = 0.5
UNKNOWN = "und"

_SALTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@lru_cache(1)
def _folded() -> np.ndarray:
    """Lower case of each letter; everything else is a blank."""
    table = np.full(0x110000, 32, np.uint32)
    letters = np.flatnonzero(_classes() == LETTER)
    table[letters] = [ord(chr(c).lower()[0]) for c in letters]
    return table


def grams(docs: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the n-grams by order, and the range of positions of each text.

    Texts are framed by blanks and runs of non-letters are one blank. A place where no n-gram
    of the order begins within its text holds bucket ``2 ** BITS``, which scores nothing.
    """
    points, first = code_points([f" {t} " for t in docs])
    folded = _folded()[points]
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
    keep[first[:-1]] = True
    folded = folded[keep]
    first = np.concatenate([[0], np.cumsum(keep)])[first]
    out, run = [], np.zeros(len(folded), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        run[: len(run) - n + 1] += folded[n - 1 :] * _SALTS[n - 1]
        if n in ORDERS:
            bucket = ((run + np.uint32(n)) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS)).astype(np.int64)
            for back in range(1, n):
                bucket[first[1:] - back] = 1 << BITS
            out.append(bucket)
    return out, first


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    #: language x order x bucket; the last bucket is zero.
    weights: np.ndarray

    def score(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the likeliest language of each text (the first of equals) and its probability."""
        buckets, first = grams(docs)
        total = np.empty((len(self.languages), len(docs)))
        for i in range(len(self.languages)):
            total[i] = self.prior[i] + sum(sums_by(first, w[b]) for w, b in zip(self.weights[i], buckets))
        best = total.argmax(axis=0)
        return best, 1 / np.exp(total - total.max(axis=0)).sum(axis=0)


def fold_of(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def largest_share(counts: Iterable[int], limit: int) -> int:
    """Most rows to take of each language so that they are ``limit`` at most together, but one of each."""
    left, counts = limit, sorted(counts)
    for i, n in enumerate(counts):
        if n * (len(counts) - i) > left:
            return max(left // (len(counts) - i), 1)
        left -= n
    return max(counts, default=1)


def fit(docs: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model of the languages of the training rows, from a bounded sample of them.

    Languages of few rows are in the sample with all of them; priors are counts over all
    training rows. Only with about ``sample_rows`` languages or more may some be missed.
    Null or empty texts teach nothing; null languages are left out. n-grams are counted in
    the tasks and summed by language and bucket; what reaches the driver is the model.
    """
    size = 1 << BITS
    labelled = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    rows = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    share = largest_share(rows.values(), sample_rows)
    large = {name: n for name, n in rows.items() if n > share}
    if large:
        n = F.create_map(*(F.lit(x) for pair in large.items() for x in pair))[F.col("lang")]
        own = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(7)), n) < share
        labelled = labelled.filter(F.coalesce(own, F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for lo, hi, data in text_blocks(batch.column(2)):
                known, own = np.unique(names[lo:hi].astype(str), return_inverse=True)
                buckets, first = grams([t.decode() for t in data])
                row = np.repeat(own, np.diff(first)) * (len(ORDERS) * size)
                cells = np.concatenate([(row + k * size + b)[b < size] for k, b in enumerate(buckets)])
                cell, n = np.unique(cells, return_counts=True)
                yield pa.record_batch(
                    [pa.array(known[cell // (len(ORDERS) * size)]), pa.array(cell % (len(ORDERS) * size)), pa.array(n)],
                    names=["lang", "cell", "n"],
                )

    counts = labelled.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    found = np.zeros((len(languages), len(ORDERS) * size))
    if table.num_rows:
        where = {name: i for i, name in enumerate(languages)}
        found[[where[x] for x in table["lang"].to_pylist()], table["cell"].to_numpy()] = table["n"].to_numpy()
    found = found.reshape(len(languages), len(ORDERS), size) + SMOOTHING
    weights = np.zeros((len(languages), len(ORDERS), size + 1), np.float32)
    weights[:, :, :size] = np.log(found / found.sum(axis=2, keepdims=True))
    shares = np.array([rows[x] for x in languages], float)
    return Model(languages, np.log(shares / max(shares.sum(), 1)), weights)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Language and probability of every row, from its text alone.

    Null text, or one without a letter, or a model without languages: ``und`` with score 0.
    Repeated rows stay. Empty table: no rows.
    """
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        for batch in batches:
            for lo, hi, data in text_blocks(batch.column(1)):
                docs = [t.decode() for t in data]
                points, first = code_points(docs)
                judged = sums_by(first, _classes()[points] == LETTER) > 0
                names, scores = np.full(hi - lo, UNKNOWN, object), np.zeros(hi - lo)
                if m.languages and judged.any():
                    best, share = m.score(docs)
                    names[judged] = np.array(m.languages, object)[best[judged]]
                    scores[judged] = share[judged]
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Language of every row; rows with remainder 2 of 4 are held out of the fit."""
    held_out = fold_of(F.col("doc_id").cast("long"), 4) == 2
    model = fit(docs, ~held_out, sample_rows)
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
