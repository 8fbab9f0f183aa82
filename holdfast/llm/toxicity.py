"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.arrays import LOWER, Words, mix, ragged, split, sums_by, text_blocks, word_hashes
from holdfast.llm.langid import fold_of
from holdfast.llm.tables import texts, written

# The default word lists.
INSULTS = (
    "clown", "coward", "disgusting", "dumb", "filthy", "garbage", "idiot", "imbecile", "jerk", "loser", "moron",
    "pathetic", "scum", "stupid", "trash", "ugly", "vermin", "worthless",
)
SECOND_PERSON = ("you", "your", "yours", "yourself", "you're", "thou", "du", "dich", "dein", "tu", "toi", "vous", "usted", "tú")
#: Characters written for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: A second person counts as near within so many words.
NEAR = 5
#: Labelled rows the trees and the calibration are fitted on, about; chosen by a hash of doc_id.
SAMPLE_ROWS = 20_000
TREES, DEPTH = 20, 3
#: A learned term is a whole word or the first so many characters of words.
PREFIXES = range(3, 9)
#: Learned terms at most, the surest first; each in so many toxic documents, with log-odds and
#: z-score (log-odds over their standard error) of at least so much.
LEXICON_TERMS, LEXICON_DOCS, LEXICON_LOG_ODDS, LEXICON_Z = 1000, 5, 1.0, 4.0

FEATURES = (
    "insult_density", "insults", "obfuscated_density", "second_person_density", "second_person_near", "capital_share",
    "exclamation_rate", "question_rate", "punctuation_rate", "symbol_rate", "lookalike_rate", "mean_word_bytes", "log_words",
    "learned_density", "learned_words", "learned_log_odds", "learned_near",
)

_LETTERS = np.zeros(256, bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True
_LETTERS[0x27] = True
_WRITTEN = _LETTERS.copy()
_FOLDED = LOWER.copy()
for _mark, _letter in LOOKALIKES.items():
    _WRITTEN[ord(_mark)] = True
    _FOLDED[ord(_mark)] = ord(_letter)


def _listed(words: Sequence[str]) -> np.ndarray:
    return np.sort(word_hashes(split([" ".join(words).encode()], _LETTERS)))


def _in(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, hashes), len(table) - 1)] == hashes


def _terms(words: Words) -> Iterator[tuple[np.ndarray, Words]]:
    """Numbers of the words that have a term of each kind, and the terms: prefixes, shortest first,
    then whole words. Characters are counted by their first bytes."""
    heads = np.flatnonzero((words.data & 0xC0) != 0x80)
    begin, end = np.searchsorted(heads, words.starts), np.searchsorted(heads, words.ends)
    heads = np.append(heads, len(words.data))
    for n in PREFIXES:
        own = np.flatnonzero(end - begin >= n)
        yield own, Words(words.data, words.starts[own], heads[begin[own] + n], words.first)
    yield np.arange(len(words)), words


@dataclass
class Lexicon:
    """Log-odds of learned terms by the hash of the term, for each kind of term in the order of _terms."""

    hashes: list[np.ndarray]
    log_odds: list[np.ndarray]

    @staticmethod
    def of(rows: Sequence[tuple[int, str, float]]) -> Lexicon:
        hashes, values = [], []
        for kind in range(len(PREFIXES) + 1):
            own = [(t.encode(), v) for k, t, v in rows if k == kind]
            h = word_hashes(split([t for t, _ in own], _LETTERS))
            by = np.argsort(h)
            hashes.append(h[by])
            values.append(np.array([v for _, v in own], float)[by])
        return Lexicon(hashes, values)

    def weights(self, words: Words) -> np.ndarray:
        """Log-odds of the longest listed term of each word, 0 without any."""
        out = np.zeros(len(words))
        for (own, terms), listed, value in zip(_terms(words), self.hashes, self.log_odds):
            if len(listed) and len(own):
                h = word_hashes(terms)
                at = np.minimum(np.searchsorted(listed, h), len(listed) - 1)
                hit = listed[at] == h
                out[own[hit]] = value[at[hit]]
        return out


NO_LEXICON = Lexicon.of([])


def learn_lexicon(docs: DataFrame, truth: DataFrame, max_terms: int = LEXICON_TERMS) -> DataFrame:
    """kind, term, toxic, clean, log_odds and z of the terms that mark toxic documents.

    ``truth`` (id, label) names the rows to learn from. Documents that hold a term are counted by
    label; log-odds are those of a toxic against a clean document holding it, with half a document
    added to each count. At most ``max_terms`` rows, the highest z first.
    """
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = wanted.join(truth, F.col("doc_id") == F.col("id")).select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False) > 0
            for lo, _, data in text_blocks(batch.column(1)):
                words = split(data, _LETTERS, lower=True)
                who = words.text()
                for kind, (own, terms) in enumerate(_terms(words)):
                    h = word_hashes(terms)
                    _, once = np.unique(mix(h + who[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                    _, at, group = np.unique(h[once], return_index=True, return_inverse=True)
                    if not len(at):
                        continue
                    toxic = np.bincount(group, labels[lo + who[own[once]]], len(at)).astype(np.int64)
                    clean = np.bincount(group, minlength=len(at)) - toxic
                    begins, sizes = terms.starts[once[at]], (terms.ends - terms.starts)[once[at]]
                    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    text = pa.StringArray.from_buffers(
                        len(at), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(terms.data[ragged(begins, sizes)]))
                    )
                    yield pa.record_batch(
                        [pa.array(np.full(len(at), kind, np.int32)), text, pa.array(toxic), pa.array(clean)],
                        names=["kind", "term", "toxic", "clean"],
                    )

    counts = wanted.mapInArrow(run, "kind int, term string, toxic long, clean long")
    counts = counts.groupBy("kind", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rows = wanted.groupBy("label").count().collect()
    n_toxic, n_clean = (sum(r["count"] for r in rows if (r.label > 0) == toxic) for toxic in (True, False))
    odds = lambda held, n: (F.col(held) + 0.5) / (F.greatest(F.lit(n) - F.col(held), F.lit(0)) + 0.5)
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = counts.filter(F.col("toxic") >= LEXICON_DOCS).withColumn("log_odds", F.log(odds("toxic", n_toxic)) - F.log(odds("clean", n_clean)))
    found = found.withColumn("z", F.col("log_odds") / error)
    found = found.filter((F.col("log_odds") >= LEXICON_LOG_ODDS) & (F.col("z") >= LEXICON_Z))
    return found.orderBy(F.desc("z"), "kind", "term").limit(max_terms)


def features(
    docs: list[bytes], insults: Sequence[str] = INSULTS, second: Sequence[str] = SECOND_PERSON, lexicon: Lexicon = NO_LEXICON
) -> np.ndarray:
    """One row of FEATURES for each text; a text without words is all zeros."""
    words = split(docs, _LETTERS, lower=True)
    hashes = word_hashes(words)
    n = np.maximum(np.diff(words.first), 1)
    bad, you = _in(hashes, _listed(insults)), _in(hashes, _listed(second))
    seen = np.concatenate([[0], np.cumsum(you)])
    who = words.text()
    lo = np.maximum(np.arange(len(words)) - NEAR, words.first[who])
    hi = np.minimum(np.arange(len(words)) + NEAR + 1, words.first[who + 1])
    beside = seen[hi] > seen[lo]
    near = bad & beside
    weight = lexicon.weights(words)
    learned = weight > 0
    n_learned = sums_by(words.first, learned)

    raw = split(docs, _WRITTEN)
    raw.data = _FOLDED[raw.data]
    hidden = _in(word_hashes(raw), _listed(insults))

    data = np.frombuffer(b"\n".join([*docs, b""]), np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    size = np.maximum(np.diff(begins) - 1, 1)
    count = lambda table: sums_by(begins, table[data])
    marks = lambda chars: np.isin(np.arange(256), [ord(c) for c in chars])
    capital, small = marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), marks("abcdefghijklmnopqrstuvwxyz")
    n_bad, n_hidden = sums_by(words.first, bad), sums_by(raw.first, hidden)
    capitals = count(capital)
    columns = (
        n_bad / n, n_bad, np.maximum(n_hidden - n_bad, 0) / n, sums_by(words.first, you) / n,
        sums_by(words.first, near) / np.maximum(n_bad, 1), capitals / np.maximum(capitals + count(small), 1),
        count(marks("!")) / size, count(marks("?")) / size, count(marks(".,;:-()\"'")) / size, count(marks("#*%&|<>$@")) / size,
        count(marks("013457@$")) / size, sums_by(words.first, words.ends - words.starts) / n, np.log1p(np.diff(words.first)),
        n_learned / n, n_learned, sums_by(words.first, weight) / n, sums_by(words.first, learned & beside) / np.maximum(n_learned, 1),
    )
    return np.stack(columns, axis=1).astype(np.float64)


def featurise(
    docs: DataFrame, insults: Sequence[str] = INSULTS, second: Sequence[str] = SECOND_PERSON, lexicon: Lexicon = NO_LEXICON
) -> DataFrame:
    """doc_id and its features as an array, from the whole text; null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data in text_blocks(batch.column(1)):
                x = features(data, insults, second, lexicon)
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), rows], names=["doc_id", "x"])

    return texts(docs).mapInArrow(run, "doc_id long, x array<double>")


def training_labels(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """id, label and part (1 to 4) of a bounded sample of the labelled rows outside part 0.

    Labels are joined by doc_id; several labels of one document count as toxic if one does,
    null labels and null doc_id are left out.
    """
    truth = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("id IS NOT NULL AND toxic IN (0, 1)")
        .withColumn("part", fold_of(F.col("id"), 5))
        .filter("part <> 0")
        .groupBy("id", "part")
        .agg(F.max("toxic").cast("double").alias("label"))
    )
    n = truth.count()
    if n > sample_rows:
        truth = truth.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(n)) < sample_rows)
    return truth


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Calibrated probability of label 1 for every row, from its text alone.

    The lexicon and the trees learn from parts 2 to 4 of the labelled rows, the calibration from part 1; part 0 is
    held out. The trees see each row through a lexicon learned from the other two parts, so its own
    words do not vouch for it. Where the training rows show one class or none, every score is the share of
    label 1 among them (0 without any). Null or empty text: scored as a text without words.
    Repeated rows stay. Empty table: no rows.
    """
    truth = written(training_labels(labels, sample_rows), "toxicity-labels")
    labelled = texts(docs).join(truth.select("id", "part"), F.col("doc_id") == F.col("id")).select("doc_id", "text", "part")
    labelled = written(labelled, "toxicity-texts")

    def lexicon(without: int) -> Lexicon:
        rows = learn_lexicon(labelled, truth.filter((F.col("part") > 1) & (F.col("part") != without)))
        return Lexicon.of(rows.select("kind", "term", "log_odds").collect())

    whole = lexicon(1)
    seen_by = {1: whole, **{part: lexicon(part) for part in (2, 3, 4)}}
    parts = [featurise(labelled.filter(F.col("part") == part), lexicon=own) for part, own in seen_by.items()]
    train = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).join(truth, F.col("doc_id") == F.col("id"))
    train = written(train.select("id", "part", "label", array_to_vector("x").alias("features")), "toxicity-training")
    marked = written(featurise(docs, lexicon=whole), "toxicity-features")
    seen = {(r.fit, r.label): r["count"] for r in train.groupBy((F.col("part") > 1).alias("fit"), "label").count().collect()}
    base = marked.select("doc_id", "x", array_to_vector("x").alias("features"))
    if not (seen.get((True, 0.0)) and seen.get((True, 1.0))):
        n = sum(seen.values())
        share = sum(v for k, v in seen.items() if k[1] == 1.0) / n if n else 0.0
        scored = base.withColumn("score", F.lit(float(share)))
    else:
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=17, maxBins=32).fit(train.filter("part > 1"))
        raw = model.transform(base).withColumn("chance", vector_to_array("probability")[1])
        if seen.get((False, 0.0)) and seen.get((False, 1.0)):
            known = model.transform(train.filter("part = 1")).withColumn("chance", vector_to_array("probability")[1])
            curve = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="score").fit(known.select("chance", "label"))
            scored = curve.transform(raw.select("doc_id", "chance"))
        else:
            scored = raw.withColumn("score", F.col("chance"))
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return scored.select(
        "doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), value.alias("score"),
        (value >= 0.5).cast("int").alias("predicted"),
    )
