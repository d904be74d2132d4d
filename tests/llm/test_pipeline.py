"""The corpus pipeline stage by stage against plain code, and the registered queries."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline as pipeline
from coursepulse.llm import byte_bpe, catalog
from tests.llm.test_operators import (
    classes_by_hand,
    fingerprint_by_hand,
    leaks_by_hand,
    spans_by_hand,
)

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def given(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


def by_name(name):
    return dict(pipeline.STAGES)[name]


def test_stages_are_in_order():
    assert [n for n, _ in pipeline.STAGES] == [
        "toxicity", "simhash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE"
    ]
    named = __spark_entry__.queries()
    assert "pipeline" in named and all(any(q.startswith(f"op{n}_") for q in named) for n in range(1, 11))


def test_toxic_documents_go(spark, sf, given):
    kept = by_name("toxicity")(spark, given, sf)
    assert kept.columns == COLUMNS
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 0").select("doc_id")
    clean = given.join(labels, "doc_id", "left_semi").count()
    assert kept.join(labels, "doc_id", "left_semi").count() >= 0.9 * clean


def test_one_of_each_group_stays(spark, sf, given):
    extra = spark.createDataFrame([(0, None, None, None, None), (None, "x", "en", "s", 1)], given.schema)
    docs = given.union(given.limit(5)).union(extra)
    kept = by_name("simhash near-dedup")(spark, docs, sf)
    rows = docs.collect()
    prints = {id(r): fingerprint_by_hand(r.text, 3) for r in rows}
    classes = classes_by_hand(list(prints.values()))
    least = {}
    for r in rows:
        if r.doc_id is not None:
            c = classes[prints[id(r)]]
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    got = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted(set(least.values())) and None in got


def test_leaking_documents_go(spark, sf, given):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(25).collect()]
    kept = {r.doc_id for r in by_name("benchmark decontamination")(spark, given, sf).collect()}
    for r in given.limit(60).collect():
        if leaks_by_hand(r.text, items):
            assert r.doc_id not in kept
    assert len(kept) >= 0.8 * given.count()


def test_secrets_are_masked(spark, sf, given):
    out = by_name("secret scans")(spark, given, sf)
    assert out.columns == COLUMNS
    texts = {r.doc_id: r.text for r in given.collect()}
    for r in out.collect():
        found = spans_by_hand(texts[r.doc_id] or "", 400)
        assert (r.text != texts[r.doc_id]) == bool(found)
        if found:
            assert "[SECRET]" in r.text and r.n_chars == len(r.text)


def test_columns_of_any_name_pass(spark, sf):
    rows = [(1, "plain text", "en", 1, "a"), (None, None, None, None, None), (2, "", "de", 2, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, spans string")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "score", "spans"]
    assert {(r.doc_id, r.score, r.spans) for r in docs.collect()} == {(1, 1, "a"), (None, None, None), (2, 2, "b")}
    last = pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.filter("round_trip").count() == 3


def test_empty_documents_pass(spark, sf, given):
    docs = given.limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.isEmpty()


def test_run_encodes_what_is_kept(spark, sf, given):
    ranks = byte_bpe.read_ranks(catalog.BYTE_RANKS)
    encoder = byte_bpe.Encoder(byte_bpe.Merges(ranks), public_tokenizers.PATTERN)
    rows = pipeline.run(spark, sf).collect()
    assert 0 < len(rows) < given.count() and all(r.round_trip for r in rows)
    for r in rows[:50]:
        assert r.token_ids == encoder.encode([r.text or ""])[0].tolist() and r.n_tokens == len(r.token_ids)


@pytest.mark.parametrize("name", ["op5_toxicity", "op6_token_counts", "op7_decontaminate", "op10_sharding"])
def test_queries_cover_their_table(spark, sf, given, name):
    out = catalog.QUERIES[name](spark, sf)
    if name == "op7_decontaminate":
        assert set(out.columns) == {"doc_id", "item_id", "start", "words", "similarity"}
    else:
        assert out.count() == given.count()
    if name == "op5_toxicity":
        wrong = F.col("predicted") != (F.col("score") >= 0.5).cast("int")
        assert out.filter(wrong).isEmpty()


def test_equal_rows_of_null_ids_stay_once(spark, sf):
    rows = [(1, "one two three four five six", "en"), (1, "alpha beta gamma delta epsilon zeta", "en"),
            (2, "alpha beta gamma delta epsilon zeta", "en"), (None, "a null id", "en"), (None, "a null id", "de"),
            (None, "one two three four five six", "en"), (None, None, "en"), (None, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = [(r.doc_id, r.text or "") for r in by_name("simhash near-dedup")(spark, docs, sf).collect()]
    assert sorted(t for i, t in kept if i is None) == ["", "a null id", rows[0][1]]
    assert [i for i, _ in kept if i is not None] == [1]
