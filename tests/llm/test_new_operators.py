"""Whitening, prefix trie and quality classifier against plain Python, on awkward rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import prefix_trie, quality_model, whitening
from tests.llm import brute
from tests.llm.test_operators import LONG, ROWS, frame, order, rows_of

NAN, INF = math.nan, math.inf


def vectors(rng, n, d=6):
    base = [[rng.gauss(0, 1 + j) for j in range(d)] for _ in range(n)]
    return [[v + 0.3 * row[0] for v in row] for row in base]


def embeddings(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return table.select("*", *(F.lit(i).alias(n) for i, n in enumerate(("x", "size", "place", "n", "component")))).repartition(3)


@pytest.fixture(scope="module")
def embedded():
    rng = random.Random(8)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(vectors(rng, 120))]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # one vector many times
    rows += [(3, rows[3][1]), (None, rows[5][1]), (None, rows[5][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 5 + [NAN]), (303, [1.0] * 5 + [INF]), (304, [1.0] * 5 + [None]), (305, [2.0] * 5)]
    return rows


def test_whitening(spark, embedded):
    got = whitening.whiten(embeddings(spark, embedded)).collect()
    n, deviation, cov = brute.whitened(embedded)
    assert {r.n for r in got} == {n} and n == 120
    assert order((r.vec_id, r.deviation) for r in got) == order(d for d in deviation for _ in range(4))
    exact = np.array([[float(c) for c in row] for row in cov])
    values = np.sort(np.linalg.eigvalsh(exact))[::-1]
    for k in range(1, 5):
        assert all(r.explained == pytest.approx(values[k - 1] / np.trace(exact), rel=1e-12) for r in got if r.component == k)
    assert max(r.identity_error for r in got) < 1e-12
    # distances in the whitened space do not depend on the signs of the components
    points = {i: v for i, v in brute.scaled(embedded) if i is not None}
    mean = np.mean(sorted({tuple(v) for v in points.values()}), axis=0)
    w, vectors_ = np.linalg.eigh(exact)
    top = np.argsort(-w)[:4]
    for r in got:
        if r.vec_id is not None:
            expected = (np.array(points[r.vec_id]) - mean) @ vectors_[:, top[r.component - 1]] / np.sqrt(w[top[r.component - 1]])
            assert abs(r.whitened) == pytest.approx(abs(expected), rel=1e-9, abs=1e-9)


def test_whitening_edges(spark):
    whiten = lambda rows: whitening.whiten(embeddings(spark, rows)).collect()
    assert whiten([]) == [] and whiten([(1, None), (2, [])]) == [] and whiten([(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == []
    # one direction only: the others have no variance and are left out
    assert {r.component for r in whiten([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])} == {1}


def test_whitening_of_large_entries(spark):
    """Squares beyond 64 bits stay exact; a deviation no long can hold is null."""
    rng = random.Random(2)
    rows = [(i, [float(np.float32(rng.uniform(-1, 1) * 10.0**e)) for e in (6, 8, 10)]) for i in range(40)]
    got = whitening.whiten(embeddings(spark, [*rows, (99, [1e30, 0.0, 0.0])])).collect()
    n, deviation, cov = brute.whitened(rows)
    expected = {i: v if v < 2**63 else None for i, v in deviation}
    assert {r.vec_id: r.deviation for r in got} == expected and None in expected.values()
    assert max(r.identity_error for r in got) < 1e-6


def test_covariances_are_exact():
    rng = random.Random(3)
    points = [[rng.randint(-(10**6), 10**6) for _ in range(5)] for _ in range(50)]
    x = np.array(points)
    sums = [int(s) for s in x.sum(axis=0)]
    shift = [(2 * s + 50) // 100 for s in sums]
    got = whitening.covariances(50, sums, shift, [int(v) for v in whitening._squares(shift)(x)])
    _, _, cov = brute.whitened([(i, [c / 256 for c in p]) for i, p in enumerate(points)])
    assert got.tolist() == [[float(c) for c in row] for row in cov]


def talks(rng, n):
    pool = [("user", "hi"), ("assistant", "hello"), ("user", "x" * 300), (None, "hi"), ("user", None), ("", ""), ("ab", "c"), ("a", "bc"), ("user", "é中😀")]
    rows = []
    for c in [*range(-20, n), 10**12]:
        for t in range(rng.randint(0, 12)):
            rows.append((c, t, *pool[0 if t < 3 and c % 3 else rng.randrange(len(pool))]))
    return rows


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(5)
    rows = talks(rng, 120)
    rows += [(500 + i, t, "user", "copy") for i in range(200) for t in range(3)]  # copies of one conversation
    rows += [(1000, None, "user", "first"), (1000, 3, "user", "third"), (1000, 2, None, None), (None, 1, "user", "lost")]
    rows += [(1001, t, "user", f"long {t % 3}") for t in range(90)]
    rows += [(1003, 1, "user", "same"), (1003, 1, "user", "same")]
    rng.shuffle(rows)
    return rows


def conversation_frame(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return table.select("*", *(F.lit(i).alias(n) for i, n in enumerate(("seq", "key", "step", "low", "depth")))).repartition(4)


@pytest.mark.parametrize("shard_turns", [250_000, 400])
def test_trie(spark, conversations, shard_turns):
    got = prefix_trie.prefix_trie(conversation_frame(spark, conversations), shard_turns)
    assert rows_of(got) == order(brute.prefix_nodes(conversations))


def test_trie_edges(spark):
    trie = lambda rows: rows_of(prefix_trie.prefix_trie(conversation_frame(spark, rows)))
    assert trie([]) == [] and trie([(None, 1, "user", "x")]) == []
    # 3 keeps none of its turns and finds no conversation 0: it has no turns, and is a member of the root
    alone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    assert trie([(alone, 1, "user", "x")]) == order(brute.prefix_nodes([(alone, 1, "user", "x")])) and len(trie([(alone, 1, "user", "x")])) == 1


def test_trie_orders_turns_of_one_number(spark):
    rows = [(5, 1, "user", t) for t in ("b", "a", "c")]
    first, second = (rows_of(prefix_trie.prefix_trie(conversation_frame(spark, r))) for r in (rows, rows[::-1]))
    assert first == second and len(first) == 4


def test_pieces_of_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = [(b"k" if i % 4 else b"m", i) for i in range(-30, 60)]
    got = {bytes(r.end_key): bytes(r.ends) for r in prefix_trie._end_digests(spark.createDataFrame(rows, "key binary, conv_id long")).collect()}
    digest = lambda key: brute.sha(",".join(str(i) for k, i in rows if k == key).encode())
    assert {k: v.hex() for k, v in got.items()} == {k: digest(k) for k in (b"k", b"m")}


def test_ternary_tree_is_balanced():
    tree = prefix_trie.TernaryTree()
    places = list(prefix_trie.TernaryTree.median_order(1000))
    assert sorted(places) == list(range(1000))
    ends = {tuple(s): tree.insert(s) for s in ([p, p % 7] for p in places)}
    assert {s: tree.insert(list(s)) for s in ends} == ends and len(tree.symbol) == 2001
    height, level = 0, [tree.down[0]]
    while level := [n for x in level for n in (tree.lower[x], tree.higher[x]) if n]:
        height += 1
    assert height <= 10


def plain_features(text):
    """The statistics of quality_model, from their definitions."""
    import re

    words = re.findall(brute.SPACES, text)
    if not words:
        return [0.0] * len(quality_model.FEATURES)
    raw = [w.encode() for w in words]
    sizes = [len(w) for w in raw]
    n, total = len(words), sum(sizes)
    mean = total / n
    sd = math.sqrt(max(sum(s * s for s in sizes) / n - mean * mean, 0))
    data = text.encode()
    share = lambda chars: sum(data.count(c.encode()) for c in chars) / total
    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    runs = [tuple(words[i : i + 3]) for i in range(n - 2)]
    lines = [x for x in text.split("\n") if re.search(brute.SPACES, x)]
    arc = lambda v: math.asin(math.sqrt(min(max(v, 0), 1)))
    return [
        math.log1p(n), math.log1p(len(lines)), math.log1p(mean), math.log1p(sd), math.log1p(max(sizes)),
        arc(share("ABCDEFGHIJKLMNOPQRSTUVWXYZ")), arc(share("#*$%&|<>@^~{}[]_=+\\/")), arc(share("!")), arc(share(".,;:-()\"'?")),
        arc(share("0123456789")), arc(sum(b >= 128 for b in data) / total),
        arc(sum(sum(map(letter, w)) < len(w) - 1 for w in raw) / n), arc(len(set(words)) / n),
        arc(max(Counter(words).values()) / n), arc((len(runs) - len(set(runs))) / max(len(runs), 1)),
        arc((len(lines) - len(set(lines))) / max(len(lines), 1)),
    ]


def test_quality_features():
    texts = [t or "" for _, t in ROWS] + ["a b a b a b", "x\n\nx\ny x", "one"]
    got = quality_model.features([t.encode() for t in texts])
    assert np.allclose(got, [plain_features(t) for t in texts], atol=1e-6)
    assert np.allclose(quality_model.features([LONG.encode()]), got[texts.index(LONG)])
    assert not quality_model.features([b"", b" \n"]).any()


def test_discriminant_is_the_posterior():
    """Without shrinkage the score is the posterior of two normal densities."""
    rng = np.random.default_rng(4)
    x = [rng.normal(size=(300, 3)) @ a + m for a, m in ((np.diag([1, 2, 0.5]), [0, 1, 0]), (rng.normal(size=(3, 3)), [1, 0, 2]))]
    counts, means = np.array([300.0, 300.0]), np.array([v.mean(axis=0) for v in x])
    scatter = np.array([(v - m).T @ (v - m) for v, m in zip(x, means)])
    model = quality_model.Discriminant.of(counts, means, scatter, 0.0, 0.0)
    at = rng.normal(size=(50, 3))
    density = lambda m, s: np.array([
        np.exp(-0.5 * (p - m) @ np.linalg.inv(s) @ (p - m)) / np.sqrt(np.linalg.det(s)) for p in at
    ])
    a, b = (density(m, s / 300) for m, s in zip(means, scatter))
    assert np.allclose(model.score(at), b / (a + b))


def graded(n):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeilnorstu") for _ in range(rng.randint(2, 9)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(30, 120))]
        if i % 4 == 0:
            words = [w + rng.choice(["###", "$$$"]) for w in words] if i % 8 else words[:3] * 30
        rows.append((i, " ".join(words)))
    return rows


def test_quality_model(spark):
    rows = graded(400)
    labels = spark.createDataFrame(
        [*((i, int(i % 4 != 0)) for i, _ in rows), (None, 1), (8, 1), (12, None), (9999, 1)], "doc_id long, quality int"
    ).withColumn("label", F.lit(0)).withColumn("x", F.lit(0))
    docs = frame(spark, [*rows, (8, rows[8][1]), (None, "a b c"), (500, None), (501, ""), (502, LONG)])
    got = quality_model.score(docs, labels).collect()
    assert len(got) == 405 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    known = [r for r in got if r.doc_id is not None and r.doc_id < 400]
    assert all(r.predicted == (r.doc_id % 4 != 0) for r in known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in known)
    assert quality_model.score(frame(spark, []), labels).count() == 0


@pytest.mark.parametrize("labels, expected", [([], 0.0), ([(1, 1), (2, 1), (3, 1)], 1.0), ([(1, 0), (2, 0), (3, 0)], 0.0)])
def test_quality_model_with_one_class(spark, labels, expected):
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    assert {r.score for r in quality_model.score(frame(spark, graded(6)), table).collect()} == {expected}


def test_quality_model_of_few_rows(spark):
    """One row of a class, or rows that are all alike: shrinkage keeps the densities proper."""
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (6, 1), (7, 0)], "doc_id long, quality int")
    got = quality_model.score(frame(spark, [(i, "same text") for i in range(10)]), labels).collect()
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_model_holds_out(spark):
    """Held-out rows of the given tables."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_model.score(docs, labels).filter("held_out").join(labels.select("doc_id", "quality"), "doc_id").collect()
    good, junk = ([r for r in got if r.quality == q] for q in (1, 0))
    assert sum(r.predicted == 1 for r in good) >= 0.95 * len(good) and sum(r.predicted == 0 for r in junk) >= 0.9 * len(junk)
