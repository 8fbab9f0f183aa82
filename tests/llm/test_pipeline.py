"""The corpus pipeline against the brute-force versions of its stages, and its awkward inputs."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import differences, duck
from holdfast.llm import quality
from holdfast.llm.tables import read
from tests.llm import brute


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    return docs, items


def test_pipeline_equals_brute_force(spark, sf_dir, tables):
    docs, items = tables
    good = {r.doc_id for r in quality.judge(read(spark, sf_dir, "documents")).filter("kept").collect()}
    docs = [d for d in docs if d[0] in good]
    first = {c for _, _, c in brute.near(docs)}
    docs = [d for d in docs if d[0] in first]
    removed = {r[0]: r[2] for r in brute.deduplicated(docs)}
    cut = {r[0]: r[3] for r in brute.deduplicated(docs)}
    texts = {}
    for doc, text in docs:
        words = re.findall(brute.SPACES, text)
        texts[doc] = text if not removed[doc] else words
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    expected_text = {}
    first_of = {}
    for doc, text in docs:
        w = re.findall(brute.SPACES, text)
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first_of[key] = min(doc, first_of.get(key, doc))
    for doc, text in docs:
        w, gone = re.findall(brute.SPACES, text), set()
        for i in range(len(w) - 12):
            if first_of[tuple(w[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert brute.sha(kept.encode()) == cut[doc]
        expected_text[doc] = kept if gone else text
    clean = {r[0] for r in brute.contaminated(list(expected_text.items()), items) if not r[5]}
    assert set(got) == clean
    assert all(got[d].decoded_sha256 == brute.sha(expected_text[d].encode()) for d in clean)


def odd(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "*", *(F.lit(i).alias(n) for i, n in enumerate(("row", "key", "kept", "th", "hash", "runs", "ids", "contaminated")))
    )


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)]])
def test_stages_take_odd_rows(spark, sf_dir, rows):
    docs = odd(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf_dir)
        if name != "encode":
            assert got.columns == docs.columns
        assert got.count() == {"quality_rules": 0, "near_dedup": min(1, len(rows))}.get(name, len(rows))


def test_near_dedup_keeps_one_of_equal_rows(spark, sf_dir):
    rows = [(2, "a b c d", "en", "s", 7)] * 3 + [(1, "a b c d", "en", "s", 7), (None, "a b c d", None, None, None), (5, "something else here", "en", "s", 1)]
    got = corpus_pipeline.near_dedup(spark, odd(spark, rows), sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == [1, 5]


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op3_benchmark_decontamination", "op6_quality_rules"])
def test_equals_sql(spark, sf_dir, name):
    assert differences(entry.queries()[name](spark, sf_dir), duck(sf_dir), entry.oracle_sql()[name]) == []


def test_quality_plan_is_native(spark, sf_dir):
    plan = entry.queries()["op6_quality_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
