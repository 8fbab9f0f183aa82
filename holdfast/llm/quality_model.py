"""Quality classifier: regularised quadratic discriminant over transformed statistics of a text.

Each class is a normal density with a covariance of its own, drawn towards the common one and
towards a round one. A text's score is the difference of its two log-densities, each a
Mahalanobis distance by the class's Cholesky factor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.arrays import NOT_SPACE, split, sums_by, text_blocks, word_codes
from holdfast.llm.langid import fold_of
from holdfast.llm.tables import texts, written

#: Part of the class covariance that comes from the common one, and of the result from a round one.
COMMON, ROUND = 0.1, 0.05
THRESHOLD = 0.3

FEATURES = (
    "log_words", "log_lines", "mean_word_bytes", "sd_word_bytes", "longest_word", "upper", "symbol", "exclamation",
    "punctuation", "digit", "other_letter", "marked_word", "distinct_word", "top_word", "repeated_run", "repeated_line",
)


def _table(chars: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in chars])


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SYMBOL = _table("#*$%&|<>@^~{}[]_=+\\/")
_LETTER = _UPPER | _table("abcdefghijklmnopqrstuvwxyz")
_LETTER[0x80:] = True
_LINE = np.ones(256, bool)
_LINE[10] = False


def _share_stays(share: np.ndarray) -> np.ndarray:
    """Arcsine of the root: spreads shares near 0 and 1 evenly."""
    return np.arcsin(np.sqrt(np.clip(share, 0, 1)))


def _repeated(who: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of codes and of those that stand in it already."""
    total = np.bincount(who, minlength=n)
    if not len(codes):
        return total, total
    pair = np.unique(who * (int(codes.max()) + 1) + codes)
    distinct = np.bincount(pair // (int(codes.max()) + 1), minlength=n)
    return total, total - distinct


def features(docs: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each text; a text without words is all zeros."""
    count = len(docs)
    words = split(docs, NOT_SPACE)
    who, codes = words.text(), word_codes(words)
    n = np.diff(words.first)
    each = np.maximum(n, 1)
    size = words.ends - words.starts
    mean = sums_by(words.first, size) / each
    sd = np.sqrt(np.maximum(sums_by(words.first, size.astype(np.float64) ** 2) / each - mean**2, 0))
    longest, top = np.zeros(count), np.zeros(count)
    np.maximum.at(longest, who, size)

    data = words.data
    begins = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    chars = np.maximum(sums_by(words.first, size), 1)
    part = lambda table: sums_by(begins, table[data]) / chars
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    marked = letters[words.ends] - letters[words.starts] < size - 1  # more than a mark at its end

    wide = int(codes.max(initial=0)) + 1
    if len(codes):
        pair, times = np.unique(who * wide + codes, return_counts=True)
        np.maximum.at(top, pair // wide, times)
    _, again = _repeated(who, codes, count)
    run, run_who, found = codes, who, np.zeros(count, np.int64)
    for _ in range(2):  # numbers of runs of two, then of three words of one text
        inside = run_who[:-1] == who[len(who) - len(run_who) + 1 :]
        run = np.unique(run[:-1] * wide + codes[len(codes) - len(run) + 1 :], return_inverse=True)[1]
        run_who = np.where(inside, run_who[:-1], -1)
        if not len(run):
            break
    if len(run):
        runs, found = _repeated(run_who[run_who >= 0], run[run_who >= 0], count)
        found = found / np.maximum(runs, 1)

    lines = split(docs, _LINE)
    full = sums_by(np.append(lines.starts, len(data)) if len(lines) else np.zeros(1, np.int64), NOT_SPACE[data]) > 0
    line_who, line_codes = lines.text()[full], word_codes(lines)[full]
    n_lines, same_lines = _repeated(line_who, line_codes, count)
    columns = (
        np.log1p(n), np.log1p(n_lines), np.log1p(mean), np.log1p(sd), np.log1p(longest),
        *map(_share_stays, (
            part(_UPPER), part(_SYMBOL), part(_table("!")), part(_table(".,;:-()\"'?")), part(_table("0123456789")),
            sums_by(begins, data >= 0x80) / chars, sums_by(words.first, marked) / each, (n - again) / each, top / each,
            found, same_lines / np.maximum(n_lines, 1),
        )),
    )
    out = np.stack(columns, axis=1).astype(np.float64)
    out[n == 0] = 0
    return out


def featurise(docs: DataFrame) -> DataFrame:
    """doc_id and its features as an array, from the whole text; null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data in text_blocks(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), _lists(features(data))], names=["doc_id", "x"])

    return texts(docs).mapInArrow(run, "doc_id long, x array<double>")


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


@dataclass
class Discriminant:
    """Per class (0, 1): log of its share, mean, inverse of the Cholesky factor, log-determinant.

    Features are scaled by ``centre`` and ``scale`` first. ``slope`` and ``offset`` turn the
    difference of log-densities into log-odds.
    """

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_shares: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    @staticmethod
    def of(counts: np.ndarray, means: np.ndarray, scatter: np.ndarray, common: float = COMMON, round_: float = ROUND) -> Discriminant:
        """From class counts, means and sums of centred products."""
        d = means.shape[1]
        pooled = scatter.sum(axis=0) / counts.sum()
        centre = counts @ means / counts.sum()
        between = sum(c * np.outer(m - centre, m - centre) for c, m in zip(counts, means)) / counts.sum()
        spread = np.sqrt(np.diag(pooled + between))
        scale = np.where(spread > 0, spread, 1.0)
        to_unit = np.outer(scale, scale)
        shared, factors, log_dets = pooled / to_unit, [], []
        for c, s in zip(counts, scatter):
            own = (1 - common) * s / c / to_unit + common * shared
            level = max(float(np.trace(own)) / d, 1e-6)
            lower = np.linalg.cholesky((1 - round_) * own + round_ * level * np.eye(d))
            factors.append(np.linalg.inv(lower))
            log_dets.append(2 * np.log(np.diag(lower)).sum())
        return Discriminant(
            centre, scale, (means - centre) / scale, np.array(factors), np.array(log_dets), np.log(counts / counts.sum())
        )

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 minus that of class 0, with the classes' shares."""
        z = (x - self.centre) / self.scale
        distance = [(((z - m) @ f.T) ** 2).sum(axis=1) for m, f in zip(self.means, self.factors)]
        log_density = [s - (q + v) / 2 for s, q, v in zip(self.log_shares, distance, self.log_dets)]
        return log_density[1] - log_density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        odds = np.clip(self.slope * self.margin(x) + self.offset, -500, 500)
        return 1 / (1 + np.exp(-odds))


def _class_sums(rows: DataFrame, width: int, add) -> dict[int, np.ndarray]:
    """Sums by class over rows of (label, x); a task sends one row for each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            label, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for c in np.unique(label).tolist():
                total[c] = total.get(c, 0) + add(c, x[label == c])
        for c, values in total.items():
            places = np.arange(len(values))
            yield pa.record_batch([pa.array(np.full(len(values), c, np.int32)), pa.array(places), pa.array(values)], names=["label", "place", "part"])

    parts = rows.select("label", "x").mapInArrow(run, "label int, place long, part double")
    out: dict[int, np.ndarray] = {}
    for r in parts.groupBy("label", "place").agg(F.sum("part").alias("part")).collect():
        out.setdefault(r.label, np.zeros(width))[r.place] = r.part
    return out


def fit(rows: DataFrame, common: float = COMMON, round_: float = ROUND) -> Discriminant | float:
    """Discriminant of all labelled rows (``label`` 0 or 1, features ``x``), from class sums that
    Spark adds up: means first, then centred products, then a logistic curve over the margins.

    Where a class is missing: the share of label 1 (0 without any row).
    """
    d = len(FEATURES)
    first = _class_sums(rows, d + 1, lambda c, x: np.concatenate([[len(x)], x.sum(axis=0)]))
    if len(first) < 2:
        return float(next(iter(first), 0))
    counts = np.array([first[c][0] for c in (0, 1)])
    means = np.array([first[c][1:] / first[c][0] for c in (0, 1)])
    second = _class_sums(rows, d * d, lambda c, x: ((x - means[c]).T @ (x - means[c])).ravel())
    model = Discriminant.of(counts, means, np.array([second[c].reshape(d, d) for c in (0, 1)]), common, round_)
    model.slope, model.offset = _calibrate(rows, model)
    return model


#: Margins beyond this count as this when the curve is fitted: they are certain either way.
_SURE = 30.0


def _calibrate(rows: DataFrame, model: Discriminant, rounds: int = 25) -> tuple[float, float]:
    """Slope and offset of log-odds over margins by Newton's steps, each over all rows by sums."""
    margins = written(
        rows.select("label", "x").mapInArrow(_margins(model), "label int, margin double"), "quality-margins"
    ).groupBy("label", F.round("margin", 1).alias("m")).agg(F.count("*").alias("n")).collect()
    label, m, n = (np.array(c, float) for c in zip(*margins))
    slope, offset = 0.5, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(slope * m + offset)))
        target = label + (0.5 - label) * 2e-3  # never wholly certain, so the curve stays finite
        g = np.array([(n * (target - p) * m).sum(), (n * (target - p)).sum()]) - 1e-3 * np.array([slope, offset])
        w = n * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * m * m).sum(), (w * m).sum()], [(w * m).sum(), w.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        slope, offset = slope + step[0], offset + step[1]
        if abs(step).max() < 1e-9:
            break
    return (float(slope), float(offset)) if slope > 0 else (1.0, 0.0)


def _margins(model: Discriminant):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = model.margin(_matrix(batch.column(1))) if len(batch) else np.zeros(0)
            yield pa.record_batch([batch.column(0), pa.array(np.clip(m, -_SURE, _SURE))], names=["label", "margin"])

    return run


def training_labels(labels: DataFrame) -> DataFrame:
    """id and label of the labelled rows outside part 0. Null labels and null doc_id are left out;
    a document with several labels is of quality if all say so."""
    truth = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
    truth = truth.filter("id IS NOT NULL AND quality IN (0, 1)").filter(fold_of(F.col("id"), 5) != 0)
    return truth.groupBy("id").agg(F.min("quality").alias("label"))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Probability of label 1 for every row, from its text alone, learned from all labelled rows
    outside part 0.

    Where the training rows show one class or none, every score is the share of label 1 among
    them (0 without any). Null or empty text: scored as a text without words. Null doc_id: never
    learned from. Repeated rows stay, and count as often as they stand there. Empty table: no rows.
    """
    marked = written(featurise(docs), "quality-features")
    truth = training_labels(labels)
    train = marked.join(truth, F.col("doc_id") == F.col("id")).select("label", "x")
    model = fit(written(train, "quality-training"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = model.score(_matrix(batch.column(1))) if len(batch) else np.zeros(0)
            yield pa.record_batch([batch.column(0), pa.array(value)], names=["doc_id", "score"])

    if isinstance(model, float):
        scored = marked.select("doc_id", F.lit(model).alias("score"))
    else:
        scored = marked.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out() -> Column:
    return fold_of(F.col("doc_id"), 5) == 0
