"""Language model and toxicity features against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from holdfast.llm import langid, toxicity
from tests.llm.test_operators import LONG, TEXTS, frame


def plain_grams(text):
    """(order, bucket) of every n-gram of the framed, folded text."""
    folded = re.sub(r" +", " ", "".join(c.lower()[0] if regex.match(r"\p{L}", c) else " " for c in f" {text} "))
    out = []
    for n in (1, 2, 3):
        for i in range(len(folded) - n + 1):
            run = sum(ord(c) * int(langid._SALTS[k]) for k, c in enumerate(folded[i : i + n])) + n
            out.append((n, (run * 0x2C1B3C6D) % 2**32 >> (32 - langid.BITS)))
    return out


def plain_model(rows):
    """Counts by language, totals by order, priors."""
    counts = {lang: Counter() for _, lang in rows}
    for text, lang in rows:
        counts[lang].update(plain_grams(text))
    n = Counter(lang for _, lang in rows)
    return counts, {lang: math.log(n[lang] / len(rows)) for lang in n}


def plain_score(model, text):
    counts, prior = model
    total = {}
    for lang in sorted(counts):
        size = {n: sum(v for (m, _), v in counts[lang].items() if m == n) + 0.5 * 2**langid.BITS for n in (1, 2, 3)}
        total[lang] = prior[lang] + sum(math.log((counts[lang][g] + 0.5) / size[g[0]]) for g in plain_grams(text))
    best = max(sorted(total), key=lambda x: total[x])
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


def sentences():
    rng = random.Random(9)
    words = {"aa": ["the", "of", "Straße", "don't"], "bb": ["la", "éco", "que", "ñandú"], "cc": ["и", "не", "что", "Ё"]}
    return [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 12))) + rng.choice(["", "!", " 12"]), lang)
            for i, lang in enumerate(rng.choice(["aa", "aa", "bb", "cc"]) for _ in range(160))]


def test_language_equals_plain_bayes(spark):
    rows = sentences()
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.fit(table, F.lit(True))
    plain = plain_model([(t, lang) for _, t, lang in rows])
    asked = [t for _, t, _ in rows[:40]] + ["the la", "Что éco", "xyz", "a", "don't  la\nla"]
    best, share = model.score(asked)
    for i, text in enumerate(asked):
        lang, score = plain_score(plain, text)
        assert model.languages[best[i]] == lang and share[i] == pytest.approx(score, abs=1e-4)


def test_language_of_awkward_rows(spark):
    """Very long text, repeated rows, columns with names the operator uses, labels present."""
    rows = [*sentences(), (900, "la éco que " * 30_000, "bb"), (3, "the of", "aa"), (3, "the of", "aa"), (901, "", "aa")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = table.select("*", *(F.lit(1).alias(n) for n in ("score", "held_out", "cell", "n", "lang_pred")))
    got = langid.identify(table).collect()
    assert len(got) == len(rows) and [r.lang_pred for r in got if r.doc_id == 900] == ["bb"]
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 3 and r.lang_pred == "aa"}) >= 1 and sum(r.doc_id == 3 for r in got) == 3
    assert [r.lang_pred for r in got if r.doc_id == 901] == ["und"]


LETTERS = rb"[A-Za-z'\x80-\xff]+"
WRITTEN = rb"[A-Za-z'\x80-\xff013457@$]+"


def plain_features(text, lexicon):
    """The 17 features, from their definitions."""
    data = text.encode()
    lower = data.lower() if data.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    words = re.findall(LETTERS, lower)
    n = max(len(words), 1)
    bad = [w.decode(errors="replace") in toxicity.INSULTS for w in words]
    you = [w.decode(errors="replace") in toxicity.SECOND_PERSON for w in words]
    beside = [any(you[max(0, i - 5) : i + 6]) for i in range(len(words))]
    fold = {ord(a): ord(b) for a, b in toxicity.LOOKALIKES.items()}
    raw = [bytes(fold.get(b, b + 32 if 65 <= b <= 90 else b) for b in w) for w in re.findall(WRITTEN, data)]
    hidden = sum(w.decode(errors="replace") in toxicity.INSULTS for w in raw)
    count = lambda chars: sum(data.count(c.encode()) for c in chars)
    size = max(len(data), 1)
    capitals, small = count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count("abcdefghijklmnopqrstuvwxyz")
    weight = []
    for w in words:
        own = w.decode(errors="replace")
        terms = [(k, own[: k + 3]) for k in range(6) if len(own) >= k + 3] + [(6, own)]
        weight.append(next((lexicon[t] for t in reversed(terms) if t in lexicon), 0.0))
    learned = [v > 0 for v in weight]
    return [
        sum(bad) / n, sum(bad), max(hidden - sum(bad), 0) / n, sum(you) / n,
        sum(b and s for b, s in zip(bad, beside)) / max(sum(bad), 1), capitals / max(capitals + small, 1), count("!") / size, count("?") / size,
        count(".,;:-()\"'") / size, count("#*%&|<>$@") / size, count("013457@$") / size, sum(map(len, words)) / n, math.log1p(len(words)),
        sum(learned) / n, sum(learned), sum(weight) / n, sum(v and s for v, s in zip(learned, beside)) / max(sum(learned), 1),
    ]


def test_toxicity_features_equal_plain_python():
    rng = random.Random(2)
    pool = [*toxicity.INSULTS[:6], *toxicity.SECOND_PERSON, "1d10t", "$tup1d", "word", "Wörter", "ÉCLAT", "tú", "IDIOT", "!", "??", "#", "it's", "\n", "scummy"]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", "", ", "]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += [t or "" for t in TEXTS if not t or len(t) < 5000] + [LONG[:20_000]]
    lexicon = {(0, "wör"): 1.5, (2, "wörte"): 2.0, (6, "word"): 1.25, (6, "it's"): 3.0, (5, "scummy"): 9.0, (3, "scummy"): 2.5}
    made = toxicity.Lexicon.of([(k, t, v) for (k, t), v in lexicon.items()])
    got = toxicity.features([t.encode() for t in texts], lexicon=made)
    assert np.allclose(got, [plain_features(t, lexicon) for t in texts], atol=1e-9)


def test_toxicity_of_awkward_rows(spark):
    """Very long texts, repeated rows, equal scores, clashing columns in documents and labels."""
    rows = [(i, f"plain words you {'idiot scum' if i % 3 == 0 else 'friend guest'} {i}") for i in range(150)]
    rows += [(200, "you idiot scum " * 40_000), (201, LONG), (6, rows[6][1]), (6, rows[6][1])]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)], "doc_id long, toxic int")
    labels = labels.select("*", *(F.lit(0).alias(n) for n in ("label", "part", "id", "text", "x", "score")))
    got = toxicity.score(frame(spark, rows), labels).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id == 6}) == 1 and sum(r.doc_id == 6 for r in got) == 3
    assert all(0 <= r.score <= 1 for r in got) and [r.predicted for r in got if r.doc_id == 200] == [1]
