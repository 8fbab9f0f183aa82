"""Each operator against its brute-force version on awkward rows, and on the small tables."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from holdfast.llm import (
    bpe, contamination, fm_index, langid, pieces, quality, sharding, simhash, substring, token_files, toxicity,
)
from tests.llm import brute

PASSAGE = " ".join(f"word{i}" for i in range(40))
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
#: Words of two letters that a polynomial hash modulo 2^64 takes for each other.
MORSE = {n: "".join("ab"[i.bit_count() % 2] for i in range(n)) for n in (1024, 2048)}
ESROM = {n: w.translate(str.maketrans("ab", "ba")) for n, w in MORSE.items()}
TWELVE = " ".join(f"after{i}" for i in range(12))
TEXTS = [
    None, "", "   \n\t ", "one", "two words", PASSAGE, PASSAGE, f"before {PASSAGE} after", PASSAGE.upper(),
    "the quick brown fox jumps over the lazy dog " * 3, "é ß 中文 😀 don't 's 're \r\n\x0b x", "a" * 3000, LONG, LONG + " end",
    "<|endoftext|> and <s> </s> <0x0A>", "| a | b | c |\n| a | b | c |\n\n| a | b | c |", "\x00\x01 nul", "1234 5678 9",
    *(f"{w[n]} {TWELVE}" for n in MORSE for w in (MORSE, ESROM)), *(w[n] for n in MORSE for w in (MORSE, ESROM)), "xy" * 30_000,
]
ROWS = [*enumerate(TEXTS), (5, PASSAGE), (5, PASSAGE), (None, PASSAGE), (None, None), (-3, f"x y z {PASSAGE}"), (7, "other text of the same id")]


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names operators use inside, some of them null."""
    return (
        spark.createDataFrame(rows, "doc_id long, text string")
        .select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"))
        .select("*", *(F.lit(i).alias(n) for i, n in enumerate(("row", "key", "th", "kept", "runs", "n_words", "print", "m", "seg", "part"))))
        .repartition(parts)
    )


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def order(rows):
    return sorted(rows, key=repr)


def rows_of(df, n=None):
    return order(tuple(r)[:n] for r in df.collect())


def test_substring(spark, docs, empty):
    digest = lambda df: df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    expected = order(brute.deduplicated(ROWS))
    assert rows_of(digest(substring.deduplicate(docs))) == expected
    assert rows_of(digest(substring.deduplicate(docs, shard_words=50, wide=1))) == expected
    assert rows_of(digest(substring.deduplicate(docs, shard_words=50, wide=1, probe=1))) == expected
    assert substring.deduplicate(empty).count() == 0


def test_substring_spreads_a_hot_passage(spark):
    rows = [(i, f"{PASSAGE} tail{i}" if i % 3 == 0 else " ".join(f"own{i}x{k}" for k in range(20))) for i in range(300)]
    docs = frame(spark, rows)
    found = substring.deduplicate(docs, wide=20, probe=1).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert rows_of(found) == order(brute.deduplicated(rows))
    known = docs.select("doc_id", "text")
    hot = substring._hot(known, substring.WINDOW, substring.GRAM, 20, 1).cache()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shared = substring._shared(substring._pairs(known, substring.WINDOW, substring.GRAM), hot, 20)
        placed = shared.filter("doc_id IS NOT NULL").select("m", F.spark_partition_id().alias("place")).distinct()
        places = placed.groupBy("m").agg(F.count("*").alias("n"))
        spread = places.join(hot, "m").agg(F.min("n"), F.count("*")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread[0] > 1 and spread[1] == hot.count() > 0


def test_cut_keeps_columns(docs):
    got = substring.cut(docs)
    assert got.columns == docs.columns
    kept = {r.doc_id: r.text for r in got.filter("doc_id IN (7, 12, 13, 6, 10, 0)").collect() if r.text != "other text of the same id"}
    assert kept[7] == "before after" and kept[12] == LONG and kept[6] == "" and kept[10] == TEXTS[10] and kept[0] is None


def test_fm_index_counts():
    rng = np.random.default_rng(5)
    lengths = rng.integers(5, 30, 40)
    first = np.concatenate([[0], np.cumsum(lengths)])
    codes = rng.integers(0, 4, first[-1]).astype(np.uint64)
    owners = rng.integers(0, 9, 40)
    index = fm_index.FMIndex(codes, first, owners, 5)
    ends = np.concatenate([np.arange(a + 4, b) for a, b in zip(first, first[1:])])
    who = np.repeat(owners, lengths - 4)
    seen = {}
    for s in range(40):
        for n in range(1, 6):
            for i in range(first[s], first[s + 1] - n + 1):
                seen.setdefault(tuple(codes[i : i + n]), set()).add(owners[s])
    expected = []
    for e, o in zip(ends, who):
        n = 0
        while n < 5 and min(seen[tuple(codes[e - n : e + 1])]) < o:
            n += 1
        expected.append(n)
    assert index.matching(ends, who, 5).tolist() == expected


def test_token_files(spark, docs, empty, tmp_path):
    source = bpe.json_file()
    library = Tokenizer.from_str(source)
    token_files.write(docs, source, str(tmp_path / "a"))
    got = token_files.read(spark, str(tmp_path / "a")).collect()
    # ties of doc_id may lie in any order: compare counts by document, and that starts are gapless in order of doc_id
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, (_, t) in enumerate(ROWS)}
    expected = order((d, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes())) for i, (d, _) in enumerate(ROWS))
    assert order((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    numbers = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert numbers == sorted(numbers, key=lambda d: (d is not None, d or 0))
    token_files.write(empty, source, str(tmp_path / "b"))
    assert token_files.read(spark, str(tmp_path / "b")).count() == 0


def test_tokens_at(spark, tmp_path):
    source, text = bpe.json_file(), LONG
    ids = [*Tokenizer.from_str(source).encode(text, add_special_tokens=False).ids, 2]
    token_files.write(frame(spark, [(1, text)]), source, str(tmp_path / "a"))
    places = [0, 1, 513, len(ids) // 2, len(ids) - 1]
    assert token_files.tokens_at(spark, str(tmp_path / "a"), 0, places) == {p: ids[p] for p in places}


@pytest.mark.parametrize("top", [2, 256, 300, 70_000, 2**32])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 4000])
def test_codes(top, n):
    ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    codes = token_files.Codes(token_files.pack(ids))
    places = np.random.default_rng(1).integers(0, max(n, 1), 100 if n else 0)
    assert (codes.all() == ids).all() and (codes.get(places) == ids[places]).all() and len(codes) == n


ITEMS = [(1, " ".join(f"Word{i}" for i in range(3, 20))), (2, "quick brown fox"), (10, "Quick BROWN-fox!"), (3, None), (4, ""), (None, "nul"), (2, "中文"), (11, MORSE[1024]), (12, f"{ESROM[2048]} {TWELVE}")]


@pytest.mark.parametrize("settings", [{}, {"segment_bytes": 300, "bucket_windows": 3}])
def test_contamination(spark, docs, empty, settings):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("hits", F.lit(1))
    got = rows_of(contamination.contamination(docs, items, **settings).drop("th"))
    assert got == order(brute.contaminated(ROWS, ITEMS))
    assert contamination.contamination(empty, items).count() == 0
    none = contamination.contamination(docs, items.limit(0))
    assert none.count() == len(ROWS) and none.filter("contaminated OR n_hit > 0").count() == 0


def test_proximity(spark):
    docs = frame(spark, [(1, "alpha gamma beta delta"), (2, "alpha beta gamma delta"), (3, "delta alpha x x x x beta gamma")])
    items = spark.createDataFrame([(9, "alpha beta gamma delta")], "item_id long, text string")
    got = {r.doc_id: (r.item_ids, r.near_ids) for r in contamination.search(docs, items, slop=1).collect()}
    assert got == {1: ([], ["9"]), 2: (["9"], ["9"]), 3: ([], [])}


def test_proximity_equals_brute_force(spark):
    rng = random.Random(12)
    docs = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    items = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))) for i in range(30)]
    for slop in (1, 2):
        got = contamination.search(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), 4, slop, 100, 7).collect()
        assert {r.doc_id: (r.item_ids, r.near_ids) for r in got} == {
            d: (brute.near_items(t, items, 4, 0), brute.near_items(t, items, 4, slop)) for d, t in docs
        }


def test_postings_are_stored(spark, docs):
    index = contamination.build_index(docs, 500)
    row = index.orderBy(F.desc(F.size("terms"))).first()
    places = [np.frombuffer(p, "<i4") for p in row.places]
    assert sorted(np.concatenate(places)) == list(range(sum(row.n_words))) and index.count() > 3
    assert contamination.documents(index).count() == len(ROWS) and len(set(row.terms)) == len(places)
    assert all((np.diff(p) > 0).all() for p in places)


@pytest.mark.parametrize("settings", [{"row_bytes": 40}, {"segment_bytes": 300, "row_bytes": 40, "bucket_windows": 1}])
def test_postings_in_rows_of_bounded_size(spark, docs, settings):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows_of(contamination.contamination(docs, items, **settings).drop("th")) == order(brute.contaminated(ROWS, ITEMS))
    index = contamination.build_index(docs, settings.get("segment_bytes", 1 << 20), 40)
    size = lambda r: sum(len(t) + len(p) for t, p in zip(r.terms, r.places))
    rows = index.collect()
    assert all(size(r) <= 40 or len(r.terms) == 1 for r in rows) and contamination.documents(index).count() == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault(r.segment, []).append(r)
    for parts in by.values():
        places = sorted(np.concatenate([np.frombuffer(p, "<i4") for r in parts for p in r.places] or [np.zeros(0, "<i4")]))
        assert places == list(range(sum(n for r in parts for n in r.n_words))) and sum(bool(r.doc_ids) for r in parts) == 1


def test_postings_in_row_groups_of_bounded_size(spark):
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(map(str, rng.integers(10**8, 10**9, 100_000).tolist()))) for i in range(24)]
    index = contamination.build_index(frame(spark, texts, 1))
    groups = [m.row_group(i) for f in index.inputFiles() for m in (pq.ParquetFile(f.removeprefix("file:")).metadata,) for i in range(m.num_row_groups)]
    assert sum(g.total_byte_size for g in groups) > 40_000_000 and max(g.total_byte_size for g in groups) < 20_000_000


def test_clean_keeps_rows_and_columns(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = order((d, n) for d, n, *_, c in brute.contaminated(ROWS, ITEMS) if not c)
    got = contamination.clean(docs, items)
    assert got.columns == docs.columns and order((r.doc_id, len(brute.words(r.text))) for r in got.collect()) == bad


def test_simhash(spark, docs, empty):
    assert rows_of(simhash.near_duplicates(docs)) == order(brute.near(ROWS))
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_distinct(docs):
    got = simhash.distinct(docs)
    groups = {c for *_, c in brute.near(ROWS)}
    assert got.columns == docs.columns
    assert order({r.doc_id for r in got.collect()}) == order(groups)


def test_links_near_bits(spark):
    base = 0x0123456789ABCDEF
    values = [base, base ^ 1, base ^ (1 << 63), base ^ (3 << 31), base ^ 0b111, base ^ (1 << 12) ^ (1 << 13) ^ (1 << 50)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "print long")).collect()}
    near = {tuple(sorted((a, b))) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert got == near


def test_components_of_chains(spark):
    rng = random.Random(4)
    names = rng.sample(range(-500, 500), 300)
    edges = [(a, b) for part in (names[:150], names[150:290], names[290:]) for a, b in zip(part, part[1:])]
    table = spark.createDataFrame([(min(e), max(e)) for e in edges], "a long, b long")
    got = {r.node: r.root for r in simhash.components(table).collect()}
    assert got == {n: min(part) for part in (names[:150], names[150:290], names[290:]) for n in part}


def test_sharding(docs, empty):
    got = sharding.assign(docs, bucket_rows=1).collect()
    assert order((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == order(brute.shards(ROWS))
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert all(r.grown_shard in (r.shard, 16) for r in got)
    assert sharding.assign(empty).count() == 0


def test_sharding_weights(spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    counts = {r.shard: r["count"] for r in sharding.assign(many, (1.0, 3.0), (1.0, 3.0, 1.0)).groupBy("shard").count().collect()}
    assert abs(counts[1] / 20_000 - 0.75) < 0.02


def test_quality(docs, empty):
    got = quality.judge(docs)
    expected = order((d, *brute.base_quality(t)) for d, t in ROWS)
    assert rows_of(got, 7) == expected
    assert quality.judge(empty).count() == 0


def test_quality_verdicts(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(6))
    prose = " ".join(rng.choice(["the", "of", "and", "to", "in"]) if rng.random() < 0.2 else word() for _ in range(300)) + "."
    cases = {1: prose, 2: prose.upper(), 3: " | ".join(prose.split()), 4: " ".join(w + "###" for w in prose.split()), 5: prose[:200]}
    got = {r.doc_id: r.kept for r in quality.judge(frame(spark, list(cases.items()))).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


@pytest.fixture(scope="module")
def written_languages(spark):
    rng = random.Random(3)
    letters = {"xx": "abcde", "yy": "vwxyz", "zz": "éèçñü"}
    rows = [(i, "".join(rng.choice(letters[lang] + " ") for _ in range(80)), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 80)]
    return spark.createDataFrame([*rows, (900, None, "xx"), (901, "12 !?", "yy"), (902, "abc", None), (None, "vwx", "yy")], "doc_id long, text string, lang string")


def test_language(written_languages, empty):
    got = langid.identify(written_languages).collect()
    truth = {r.doc_id: r.lang for r in written_languages.collect()}
    assert all(r.lang_pred == truth[r.doc_id] for r in got if r.doc_id is not None and r.doc_id < 900)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (900, 901)} == {900: "und", 901: "und"}
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 244
    assert {r.held_out for r in got if r.doc_id is not None} == {zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got if r.doc_id is not None}
    assert langid.identify(empty).count() == 0


def test_language_held_by_few_rows(spark):
    """A sample keeps a rare language whole; priors are shares of all training rows."""
    rows = [(i, "zz" if i % 200 == 7 else "yy" if i % 3 else "xx") for i in range(1000)]
    spell = {"zz": "qof wuq qix", "yy": "lorem amet nam", "xx": "the thing shut"}
    table = spark.createDataFrame([(i, lang, spell[lang]) for i, lang in rows], "doc_id long, lang string, text string")
    model = langid.fit(table, F.lit(True), sample_rows=60)
    assert model.languages == ["xx", "yy", "zz"]
    assert np.allclose(np.exp(model.prior), [sum(x == lang for _, x in rows) / len(rows) for lang in model.languages])
    assert model.score(["wuq qix"])[0][0] == 2
    assert langid.largest_share([5, 300, 695], 60) == 27 and langid.largest_share([5, 10], 60) == 10


def test_language_without_labels(docs):
    assert {(r.lang_pred, r.score) for r in langid.identify(docs).collect()} == {("und", 0.0)}


@pytest.fixture(scope="module")
def encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_round_trip(docs, empty, encoding):
    source = bpe.rank_file()
    ids = [encoding.encode_ordinary(t or "") for _, t in ROWS]
    expected = order((d, len(i), brute.sha(brute.ids_bytes(i)), brute.sha((t or "").encode())) for (d, t), i in zip(ROWS, ids))
    assert rows_of(bpe.round_trip(docs, source), 4) == expected
    assert bpe.round_trip(empty, source).count() == 0


def test_encoder_cuts_like_the_library(encoding):
    rng = random.Random(1)
    pool = ["'", "'s", "'re", "'LL", "'ll", " ", "  ", "\n", "\t", " ", "a", "é", "1", "²", "中", "😀", "!", "don't", " 's", "''s", "\r\n", "\x85", "​"]
    own = bpe.Encoder(bpe.rank_file())
    for _ in range(1500):
        texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(2)]
        ids, ranges = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(ranges, ranges[1:])] == [encoding.encode_ordinary(t) for t in texts]


def test_decoder_offsets_and_split_characters():
    source = bpe.rank_file()
    ids, _ = bpe.Encoder(source).encode(["a😀b"])
    data, offsets = bpe.Decoder(source).decode(ids)
    assert data == "a😀b".encode() and offsets[0] == 0 and (np.diff(offsets) > 0).all()


def test_small_memory_gives_the_same(encoding, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_IDS", 10)
    own = bpe.Encoder(bpe.rank_file())
    own.memory = bpe.Memory(own._make, slots=4)
    for t in (LONG[:5000], PASSAGE, LONG[:5000]):
        assert own.encode([t])[0].tolist() == encoding.encode_ordinary(t)


TOXIC = [(i, f"some plain words here you {'idiot and scum' if i % 3 == 0 else 'friend and guest'} number {i}") for i in range(200)]


def test_toxicity(spark):
    labels = spark.createDataFrame([*((i, 1 if i % 3 == 0 else 0) for i, _ in TOXIC), (None, 1), (3, None), (3, 1), (9999, 1)], "doc_id long, toxic int")
    got = toxicity.score(frame(spark, [*TOXIC, (500, None), (501, "")]), labels).collect()
    assert len(got) == 202 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in got if r.doc_id < 500)
    assert all(r.predicted == 0 for r in got if r.doc_id >= 500)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


@pytest.mark.parametrize("labels, expected", [([], 0.0), ([(1, 1), (2, 1), (3, 1)], 1.0)])
def test_toxicity_with_one_class(spark, labels, expected):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(frame(spark, TOXIC[:5]), table).collect()} == {expected}
    assert toxicity.score(frame(spark, []), table).count() == 0


def test_toxicity_features():
    x = dict(zip(toxicity.FEATURES, toxicity.features([b"You are an 1d10t, IDIOT!"])[0]))
    assert x["insults"] == 1 and x["obfuscated_density"] > 0 and x["second_person_near"] == 1 and x["exclamation_rate"] > 0
    assert not toxicity.features([b""]).any()


def test_toxicity_learns_words_it_does_not_list(spark):
    """Toxic rows of another language, told by words that share a beginning only."""
    ends = ["ab", "ec", "id", "of", "ug", "ah", "ei", "ij"]
    bad = lambda i: " ".join(f"éblom{ends[(i + k) % 8]}{ends[(i * 3 + k) % 8]}" for k in range(3))
    rows = [(i, f"du bla mot {ends[i % 8]} {bad(i) if i % 3 == 0 else bad(i).replace('éblom', 'éclam')} nombre {ends[i % 7]}") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = [r for r in toxicity.score(frame(spark, rows), labels).collect() if r.held_out]
    assert len(got) > 50 and all(r.predicted == (r.doc_id % 3 == 0) for r in got)
    terms = toxicity.learn_lexicon(frame(spark, rows), labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))).collect()
    found = {(r.kind, r.term): r for r in terms}
    n_toxic = sum(i % 3 == 0 for i, _ in rows)
    assert (found[2, "éblom"].toxic, found[2, "éblom"].clean) == (n_toxic, 0) and (0, "écl") not in found and (0, "nom") not in found
    assert len(toxicity.learn_lexicon(frame(spark, rows), labels.selectExpr("doc_id AS id", "toxic AS label"), 3).collect()) == 3


def test_piece_counts(docs, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counts = [len(model.encode(t or "")) for _, t in ROWS]
    expected = order((d, len((t or "").encode()), n, n > 4096) for (d, t), n in zip(ROWS, counts))
    assert rows_of(pieces.count(docs)) == expected
    assert pieces.count(empty).count() == 0


def test_piece_counts_of_odd_texts():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Counter(path)
    rng = random.Random(3)
    pool = [" ", "  ", "▁", "a", "in", "the", "ing", "é", "中", "😀", "<s>", "<unk>", "<0x0A>", "\n", "\x00", "00", "...", "ation", "ﬁ", "aaaa", "Ġ"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += [" " * 5000, "-" * 3000 + " x", "ab" * 2500, *MORSE.values(), *ESROM.values()]
    texts += ["".join(rng.choice("abcdeinorst") for _ in range(n)) for n in (65, 700, 3000, 100_000)]
    texts += ["".join(rng.choice(["中", "é", "the", "in", "😀"]) for _ in range(9000))]
    assert own.counts(texts).tolist() == [len(t) for t in model.encode(texts)]
