"""Embedding whitening: covariances from exact squares of dimensions and of sums of two dimensions.

Var(a + b) - Var(a) - Var(b) = 2 Cov(a, b), so squares alone give every covariance. Vectors are
whole numbers, and so is all that is added up: the sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.tables import written

#: Steps to one: entries become whole numbers of 1 / SCALE.
SCALE = 256
COMPONENTS = 4
#: Vectors worked on at once.
BATCH = 4096
#: Sums leave a task as two decimals, so that Spark adds them up without an overflow.
_LIMB = 10**18
#: Widths a vector is kept in: the smallest that holds all of its entries.
_WIDTHS = (np.int16, np.int32, np.int64)


@dataclass
class Whitening:
    """Fitted on ``n`` distinct vectors: centre and direction of the components, numbered by
    falling variance; ``shift`` is the whole number next to each dimension's mean."""

    n: int
    sums: list[int]
    shift: list[int]
    variances: np.ndarray
    components: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Exact ``n * x - sums``, as 64-bit integers or, where these are too small, as Python's."""
        rest = np.array([s - self.n * m for s, m in zip(self.sums, self.shift)], object)
        near = x.astype(object) - np.array(self.shift, object) if self._wide(x) else x - np.array(self.shift, np.int64)
        reach = self.n * (int(abs(near).max(initial=0)) + 1)
        if near.dtype != object and reach * reach * max(1, x.shape[1]) < 2**62:
            return self.n * near - rest.astype(np.int64)
        return self.n * near.astype(object) - rest

    def _wide(self, x: np.ndarray) -> bool:
        return max(int(x.max(initial=0)), -int(x.min(initial=0)), *map(abs, self.shift), 0) >= 2**61

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of each vector."""
        return (self.centred(x) / self.n).astype(np.float64) @ self.components / np.sqrt(self.variances)


def _rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, number of entries and the scaled vector (``x``) of each usable row."""
    e = F.col("embedding").cast("array<double>")
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e")).filter("e IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            first = lists.offsets.to_numpy().astype(np.int64)
            entries = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null is not a number here
            x = np.floor(SCALE * entries) + 0.0
            good = np.isfinite(entries) & (np.abs(x) < 2.0**63)
            bad = np.concatenate([[0], np.cumsum(~good)])
            keep = np.flatnonzero((bad[first[1:]] == bad[first[:-1]]) & (first[1:] > first[:-1]))
            whole = np.where(good, x, 0).astype(np.int64)
            data = [_packed(whole[a:b]) for a, b in zip(first[keep].tolist(), first[keep + 1].tolist())]
            size = (first[keep + 1] - first[keep]).astype(np.int32)
            yield pa.record_batch([batch.column(0).take(pa.array(keep)), pa.array(size), pa.array(data, pa.binary())], names=["vec_id", "size", "x"])

    return usable.mapInArrow(run, "vec_id long, size int, x binary")


def _packed(x: np.ndarray) -> bytes:
    """The vector in the smallest width that holds it: equal vectors are equal bytes."""
    low, high = int(x.min()), int(x.max())
    width = next(w for w in _WIDTHS if np.iinfo(w).min <= low and high <= np.iinfo(w).max)
    return x.astype(width).tobytes()


def _matrix(data: list[bytes], size: int) -> np.ndarray:
    """Vectors of ``size`` entries as rows."""
    width = {size * np.dtype(w).itemsize: w for w in _WIDTHS}
    return np.stack([np.frombuffer(x, width[len(x)]).astype(np.int64) for x in data]) if data else np.zeros((0, size), np.int64)


def _matrices(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for lo in range(0, len(column), BATCH):
        yield lo, _matrix(column.slice(lo, BATCH).to_pylist(), size)


def _totals(points: DataFrame, size: int, width: int, add) -> list[int]:
    """Exact column sums over all vectors; ``add`` turns a matrix of vectors into one row of
    ``width`` whole numbers. A task sends one row a number, whatever its number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for batch in batches:
            for _, x in _matrices(batch.column(0), size):
                total = total + add(x).astype(object)
        parts = [divmod(int(t), _LIMB) for t in total]
        high, low = (pa.array([p[i] for p in parts], pa.decimal128(38, 0)) for i in (0, 1))
        yield pa.record_batch([pa.array(np.arange(width)), high, low], names=["place", "high", "low"])

    rows = points.select("x").mapInArrow(run, "place long, high decimal(38,0), low decimal(38,0)")
    sums = rows.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    out = [0] * width
    for r in sums:
        out[r.place] = int(r.high) * _LIMB + int(r.low)
    return out


def _squares(shift: list[int]):
    """Sums of squares of each centred dimension, then of each sum of two of them, in the order
    (0, 1), (0, 2), ..."""

    def add(x: np.ndarray) -> np.ndarray:
        top = max(int(x.max(initial=0)), -int(x.min(initial=0)), *map(abs, shift), 1)
        kind = np.int64 if len(x) * (4 * top) ** 2 < 2**62 else object
        y = x.astype(kind) - np.array(shift, kind)
        pairs = [((y[:, i : i + 1] + y[:, i + 1 :]) ** 2).sum(axis=0) for i in range(y.shape[1] - 1)]
        return np.concatenate([(y**2).sum(axis=0), *pairs])

    return add


def covariances(n: int, sums: list[int], shift: list[int], squares: list[int]) -> np.ndarray:
    """Covariance matrix, each entry rounded once, from its exact value.

    With y = x - shift and r = sums - n * shift, the squares of n * x - sums add up to
    n^2 * sum(y^2) - n * r^2, and so for the sum of two dimensions.
    """
    d = len(sums)
    rest = [s - n * m for s, m in zip(sums, shift)]
    own = [n * squares[i] - rest[i] ** 2 for i in range(d)]
    out = np.zeros((d, d))
    at = d
    for i in range(d):
        out[i, i] = own[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[at] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**2)
            at += 1
    return out


def fit(points: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Whitening by the first ``k`` components of distinct vectors (``size``, ``x``), which are
    those of the largest size. None without a vector. Components without variance are left out.
    """
    top = points.agg(F.max("size"), F.count("*")).first()
    if not top[1]:
        return None
    size, n = int(top[0]), int(top[1])
    sums = _totals(points, size, size, lambda x: x.sum(axis=0) if np.abs(x).max(initial=0) < 2**48 else x.astype(object).sum(axis=0))
    shift = [(2 * s + n) // (2 * n) for s in sums]
    squares = _totals(points, size, size * (size + 1) // 2, _squares(shift))
    cov = covariances(n, sums, shift, squares)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:k]
    order = order[values[order] > np.finfo(float).eps * size * max(values.max(), 0)]
    trace = float(np.trace(cov))
    explained = values[order] / trace if trace > 0 else values[order]
    return Whitening(n, sums, shift, values[order], vectors[:, order], explained)


def identity_error(points: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k, size = len(model.variances), len(model.sums)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            for _, x in _matrices(batch.column(0), size):
                w = model.project(x)
                total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "part"])

    parts = points.select("x").mapInArrow(run, "place long, part double").groupBy("place").agg(F.sum("part").alias("part"))
    total = np.zeros(k + k * k)
    for r in parts.collect():
        total[r.place] = r.part
    mean = total[:k] / model.n  # zero but for rounding: the vectors are centred
    return float(np.abs(total[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def transform(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """One row for each vector and component."""
    k, size = len(model.variances), len(model.sums)
    top = 2**63 - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, x in _matrices(batch.column(1), size):
                off = model.centred(x)
                deviation = [int(v) if v <= top else None for v in (off**2).sum(axis=1).tolist()]
                w = (off / model.n).astype(np.float64) @ model.components / np.sqrt(model.variances)
                at = np.repeat(np.arange(len(x)), k)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, len(x)).take(pa.array(at)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(deviation, pa.int64()).take(pa.array(at)),
                        pa.array(w.ravel()),
                        pa.array(np.tile(model.explained, len(x))),
                    ],
                    names=["vec_id", "component", "deviation", "whitened", "explained"],
                )

    out = rows.filter(F.col("size") == size).select("vec_id", "x").mapInArrow(
        run, "vec_id long, component int, deviation long, whitened double, explained double"
    )
    return out.select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"),
    )


def whiten(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """The first ``k`` whitened components of every usable row, with its squared distance from
    the mean (``deviation``, times n squared; null where a long cannot hold it).

    Entries become whole numbers, ``floor(256 * c)``; the covariance counts each distinct vector
    once and lies on the driver, as do its eigenvectors: its size depends on the dimension only.
    Rows go whose vector is null, empty, shorter than the longest usable one, or holds an entry
    that is null, not finite or, scaled, outside a long. Null vec_id and repeated rows stay.
    Components without variance, as those of a single vector, are left out; so a table without
    any usable vector, or with one distinct vector, gives no rows. Other columns do not matter.
    """
    rows = written(_rows(embeddings), "scaled-vectors")
    distinct = rows.select("size", "x").distinct()
    points = written(distinct, "distinct-vectors")
    size = points.agg(F.max("size")).first()[0]
    points = points.filter(F.col("size") == F.lit(size))
    model = fit(points, k)
    if model is None or not len(model.variances):
        return embeddings.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    return transform(rows, model, identity_error(points, model))
