"""Quality rules: divergence of a document's histograms from those of its likeliest language.

DataFrame functions only. Every array lives in its row; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.tables import texts

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: Digits are no class: numbers follow what a text is about, not its language.
CLASSES = ("lower", "upper", "other_letter", "symbol", "punctuation")

# Common words of each language, most frequent first.
COMMON_WORDS = {
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "it", "for", "on", "was", "as"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
}


@dataclass(frozen=True)
class Profile:
    """Reference histograms of a language: shares of CLASSES, and of its common words among all words."""

    classes: tuple[float, ...]
    words: tuple[float, ...]


# Default references, shares measured by learn_profiles.
PROFILES = {
    "de": Profile(
        (0.9152, 0.0148, 0.0445, 0.0, 0.0255),
        (0.0525, 0.0267, 0.0214, 0.0126, 0.0102, 0.0088, 0.0081, 0.0065, 0.0062, 0.0055, 0.0051, 0.0041, 0.8323),
    ),
    "en": Profile(
        (0.9543, 0.017, 0.0, 0.0, 0.0287),
        (0.0535, 0.027, 0.0218, 0.0156, 0.0105, 0.009, 0.008, 0.0067, 0.0062, 0.0052, 0.0056, 0.0039, 0.8269),
    ),
    "es": Profile(
        (0.8654, 0.0146, 0.0922, 0.0, 0.0277),
        (0.0537, 0.0269, 0.02, 0.014, 0.0125, 0.0099, 0.0086, 0.0071, 0.0058, 0.0076, 0.0054, 0.0051, 0.8233),
    ),
    "fr": Profile(
        (0.8509, 0.0129, 0.1073, 0.0, 0.0289),
        (0.0537, 0.0284, 0.0202, 0.0144, 0.0121, 0.0107, 0.0102, 0.0081, 0.007, 0.0058, 0.0052, 0.0046, 0.8195),
    ),
}

#: Fewer words than this fail the base rule.
MIN_WORDS = 50
#: Guards: with fewer word characters, or words, a histogram is too coarse to judge and passes.
MIN_CLASS_CHARS, MIN_HISTOGRAM_WORDS = 200, 200
#: Largest accepted Jensen-Shannon distances (0 to 1) to the nearest reference.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.15, 0.29


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two histograms of equal length."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def _counts(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """doc_id with the counts the rules use."""
    d = texts(docs, key).select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("doc_id", "t", word_list(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    # what is left of the text after each class is taken out of it
    left = {"spaceless": F.regexp_replace("t", SPACE, "")}
    for name, before, pattern in (
        ("no_lower", "spaceless", "[a-z]+"), ("no_upper", "no_lower", "[A-Z]+"), ("no_digit", "no_upper", "[0-9]+"),
        ("plain", "no_digit", r"[^\x00-\x7F]+"), ("no_symbol", "plain", SYMBOLS),
    ):
        left[name] = F.regexp_replace(before, pattern, "")
    for name, value in left.items():
        d = d.withColumn(name, value)
    size = {name: F.char_length(name) for name in left}
    taken = (("spaceless", "no_lower"), ("no_lower", "no_upper"), ("no_digit", "plain"), ("plain", "no_symbol"))
    classes = [*(size[a] - size[b] for a, b in taken), size["no_symbol"]]
    d = d.select(
        "doc_id", "w",
        F.size("w").alias("n_words"),
        size["spaceless"].alias("word_chars"),
        (size["plain"] - size["no_symbol"]).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.array(*classes).alias("class_counts"),
    )
    # windows by hash; those of a hash that comes again, in order of place
    window = F.when(
        F.col("n_words") >= 3,
        F.transform(F.slice("w", F.lit(1), F.col("n_words") - 2), lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("h", window)
    d = d.withColumn(
        "sorted",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda x, k: F.coalesce(x["h"] == F.get("sorted", k)["h"], F.lit(False))
    d = d.withColumn(
        "again", F.sort_array(F.transform(F.filter("sorted", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    )
    covered = F.aggregate(
        F.transform("again", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("again", k + 1) - p, F.lit(3)))), F.lit(0), lambda s, x: s + x
    )
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0))).drop("h", "sorted", "again")


def _histograms(counts: DataFrame, words: dict[str, Sequence[str]]) -> DataFrame:
    """Counts with ``word_counts``: occurrences of every common word of any language, in order."""
    listed = sorted({w for ws in words.values() for w in ws})
    table = F.array(*(F.lit(w) for w in listed))
    # one letter for each common word in the text; a letter's number is what removing it takes away
    letters = [chr(0x30 + i) for i in range(len(listed))]
    code = F.array_join(
        F.transform(
            F.filter(F.transform("w", lambda w: F.lower(w)), lambda w: w.isin(*listed)),
            lambda w: F.substring(F.lit("".join(letters)), F.array_position(table, w).cast("int"), F.lit(1)),
        ),
        "",
    )
    d = counts.withColumn("code", code).drop("w")
    total = F.char_length("code")
    return d.withColumn("word_counts", F.array(*(total - F.char_length(F.replace("code", F.lit(c), F.lit(""))) for c in letters))).drop("code")


def _class_shares() -> Column:
    total = F.greatest(F.aggregate("class_counts", F.lit(0), lambda s, c: s + c), F.lit(1))
    return F.transform("class_counts", lambda c: c / total)


def _language_shares(words: dict[str, Sequence[str]], language: str) -> Column:
    """Shares of the language's common words, and of all other words, in the text."""
    listed = sorted({w for ws in words.values() for w in ws})
    own = [F.get("word_counts", F.lit(listed.index(w))) / F.greatest("n_words", F.lit(1)) for w in words[language]]
    rest = F.lit(1.0) - sum(own[1:], own[0])
    return F.array(*own, rest)


def learn_profiles(docs: DataFrame, words: dict[str, Sequence[str]] = COMMON_WORDS) -> dict[str, Profile]:
    """References from labelled documents: median shares over the rows of each language, scaled to one.

    One row for each language of ``words`` reaches the driver.
    """
    out = {}
    for language in words:
        rows = _histograms(_counts(docs.filter(F.col("lang") == language)), words).filter(F.col("n_words") >= MIN_WORDS)
        shares = _class_shares()
        own = _language_shares(words, language)
        n = len(words[language]) + 1
        middle = lambda name, size: [F.percentile_approx(F.col(name)[i], 0.5).alias(f"{name}{i}") for i in range(size)]
        middles = rows.select(shares.alias("c"), own.alias("o")).agg(*middle("c", len(CLASSES)), *middle("o", n)).first()
        if middles["c0"] is not None:
            c = [middles[f"c{i}"] for i in range(len(CLASSES))]
            o = [middles[f"o{i}"] for i in range(n)]
            out[language] = Profile(tuple(round(x / sum(c), 4) for x in c), tuple(round(x / sum(o), 4) for x in o))
    return out


def judge(
    docs: DataFrame,
    profiles: dict[str, Profile] = PROFILES,
    words: dict[str, Sequence[str]] = COMMON_WORDS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    min_class_chars: int = MIN_CLASS_CHARS,
    min_histogram_words: int = MIN_HISTOGRAM_WORDS,
    key: Column | None = None,
) -> DataFrame:
    """Counts, distances and verdict of every row.

    A row fails the base rules with fewer than MIN_WORDS words, or if over half of them stand
    in repeated three-word windows. Otherwise it is kept unless its histogram of character
    classes or of common words is further than the limit from that of its nearest language,
    each judged only in texts long enough for it. ``key`` is carried as doc_id. Null text: no
    words, so it fails. Null doc_id and repeated rows stay as they are. Empty table: no rows.
    """
    d = _histograms(_counts(docs, key), words).withColumn("class_shares", _class_shares())
    near = lambda values: F.least(*values) if len(values) > 1 else values[0] if values else F.lit(0.0)
    literal = lambda xs: F.array(*(F.lit(float(x)) for x in xs))
    d = d.withColumn("class_distance", near([js_distance(F.col("class_shares"), literal(p.classes)) for p in profiles.values()]))
    d = d.withColumn(
        "word_distance", near([js_distance(_language_shares(words, name), literal(p.words)) for name, p in profiles.items()])
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    # one element: a later filter would otherwise be pushed below, with every expression above written out in it
    d = d.select("doc_id", F.inline(F.array(F.struct(*counts, "class_distance", "word_distance"))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = ((F.col("word_chars") >= min_class_chars) & (F.col("class_distance") > max_class_distance)) | (
        (F.col("n_words") >= min_histogram_words) & (F.col("word_distance") > max_word_distance)
    )
    return d.select(
        "doc_id", *(F.col(c).cast("long").alias(c) for c in counts), failed.alias("base_failed"),
        (~failed & ~far).alias("kept"), "class_distance", "word_distance",
    )
