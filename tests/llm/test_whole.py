"""Cases where an operator did less than the whole job, each against brute force."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from coursepulse.llm import catalog, decontaminate, tool_calls, toxicity
from tests.llm.test_operators import CALLS, RESULTS, TOOLS, prose

# --- 5 toxicity -----------------------------------------------------------------------------


def test_thresholds_come_from_all_labelled_rows(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        words = prose(rng, rng.randint(5, 30)).split(" ")
        toxic = int(i % 10 == 0)
        if toxic or rng.random() < 0.05:
            words.insert(rng.randrange(len(words)), rng.choice(["idiotic", "grumpf"]))
        rows.append((i, " ".join(words), rng.choice(["en", "de", "fr"]), toxic))
    rows.append((5000, "idiotic", None, 1))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    labels = table.select("doc_id", "toxic").filter("doc_id % 5 <> 3")
    calls, real = [], getattr(toxicity, "thresholds", None)
    monkeypatch.setattr(
        toxicity, "thresholds", lambda *a: calls.append(a) or real(*a), raising=False
    )
    model = toxicity.fit(table, labels, sample=60)
    assert set(model.thresholds) == {None, "de", "en", "fr"}
    trained = set(calls[0][2])
    scored = [r for r in toxicity.score(table, model).collect() if r.doc_id % 5 != 3]
    assert len(trained) == 90 and len(scored) - len(trained) > 1000
    for lang, got in model.thresholds.items():
        own = [r for r in scored if lang in (None, r.lang)]
        fresh = [r for r in own if r.doc_id not in trained]
        weight = {
            y: sum(r.toxic == y for r in own) / sum(r.toxic == y for r in fresh) for y in (0, 1)
        }
        f1 = []
        for cut in toxicity.CUTS:
            hit = sum(weight[1] for r in fresh if r.toxic and r.score >= cut)
            wrong = sum(weight[0] for r in fresh if not r.toxic and r.score >= cut)
            f1.append(2 * hit / (hit + wrong + sum(r.toxic for r in own)))
        best = toxicity.CUTS[np.array(f1) >= max(f1) - 1e-9]
        assert abs(got - np.median(best)) < 1e-9

# --- 7 decontamination ----------------------------------------------------------------------


def test_leaks_with_words_replaced_at_any_place():
    rng = random.Random(10)
    items = [(i, prose(rng, rng.randint(12, 60)).replace("\n", "")) for i in range(50)]
    index = decontaminate.Index(items)
    tried = 0
    for i, words in index.items:
        own = Counter(decontaminate.shingles(words))
        for place in range(len(words)):
            for more in ([], [rng.randrange(len(words))]):
                changed = words[:]
                for at in (place, *more):
                    changed[at] = b"w%d" % rng.randrange(10**6)
                value = decontaminate.similarity(Counter(decontaminate.shingles(changed)), own)
                if value < decontaminate.SIMILARITY:
                    continue
                tried += 1
                text = f"{prose(rng, 9)} {b' '.join(changed).decode()} {prose(rng, 9)}"
                assert i in {x["item_id"] for x in index.leaks(text)}, (words, place)
    assert tried > 300


# --- 8 sketches -----------------------------------------------------------------------------


def test_every_sentence_end_cuts(spark, tmp_path):
    rng = random.Random(12)
    plain = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    texts = [
        " ".join(f"{plain(6)} {end}" for end in ["ten.", "14.", "NO!", "caf\u00e9?", "sky."] * 8),
        plain(400),
        "\u65e5\u672c\u3002" * 3 + "".join(chr(0x4E00 + rng.randrange(5000)) + "\u3001" for _ in range(900)),
        "",
        None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in catalog.QUERIES["op8_iblt"](spark, str(tmp_path)).collect()}
    count = {i: int(r.fingerprint.split(";")[0]) for i, r in rows.items()}
    assert count[0] == len(set(re.split(r"\n|(?<=[.!?]) ", texts[0]))) == 40
    assert count[1] >= 10 and count[2] >= 10 and count[3] == count[4] == 0
    # Three quarters of each text are unchanged.
    assert all(rows[i].near_edited > 0.3 for i in (0, 1, 2))


# --- 1 tool calls ---------------------------------------------------------------------------


def test_no_call_or_result_is_lost(spark):
    calls = [(1, "a", None, 0, "search", '{"q":"one"}'), (1, "a", None, 0, "search", '{"q":"two"}'),
             (None, "a", None, 0, "search", '{"q":"three"}'), (None, "a", None, 0, "search", '{"q":"four"}')]
    results = [(1, "a", 1, "r1"), (1, "a", 1, "r2"), (None, "a", 1, "r3"), (None, "a", 1, "r4")]
    rows = tool_calls.link(
        spark.createDataFrame(calls, CALLS),
        spark.createDataFrame(results, RESULTS),
        tool_calls.schema_frame(spark, TOOLS),
    ).collect()
    assert len(rows) == 8
    for word in ("one", "two", "three", "four", "r1", "r2", "r3", "r4"):
        assert sum(f'"{word}"' in r.message for r in rows) == 1
    assert [r.problems for r in rows if r.conv_id == 1] == ["repeated"] * 4
    assert {r.problems for r in rows if r.conv_id is None} == {"no result", "no call"}


def test_long_texts_are_scored_in_pieces_without_loss(monkeypatch):
    rng = random.Random(13)
    model = toxicity.Model.start()
    texts = [prose(rng, rng.randint(0, 400)) + rng.choice(["", " ", "\n "]) for _ in range(30)]
    texts += [None, "", "   ", "a", "x" * 500, "a b", " ".join("abc" for _ in range(300))]
    whole = model.scores_of(texts)
    for size in (1, 7, 100):
        monkeypatch.setattr(toxicity, "BLOCK_CHARS", size)
        assert np.allclose(model.scores_of(texts), whole, atol=1e-6)
        for text in texts:
            found = [toxicity.words_of(p) for p in toxicity.pieces(text)]
            windows = {tuple(w[k : k + n]) for w in found for n in (1, 2, 3) for k in range(len(w) - n + 1)}
            words = toxicity.words_of(text)
            assert windows == {tuple(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)}


def test_scored_once_as_by_fit_and_score(spark):
    rng = random.Random(14)
    rows = [(i, prose(rng, 20) + (" idiotic" if i % 7 == 0 else ""), rng.choice(["en", "de", None])) for i in range(300)]
    rows += [(None, "idiotic", "en"), (7, "twice", "en"), (8, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("own"))
    labels = spark.range(0, 300, 2).selectExpr("id AS doc_id", "int(id % 7 = 0) AS toxic")
    want = toxicity.score(docs, toxicity.fit(docs, labels))
    got = toxicity.fit_and_score(docs, labels)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert toxicity.fit_and_score(docs.limit(0), labels).collect() == []
    assert toxicity.fit_and_score(docs, labels.limit(0), keep=["doc_id"]).filter("rejected").isEmpty()


def test_next_documents_are_cut_by_the_same_rule(spark, tmp_path):
    rng = random.Random(15)
    sentences = [f"w{rng.randrange(99)} of x{i}{rng.choice('.!?')}" for i in range(60)]
    texts = [" ".join(rng.sample(sentences, rng.randint(0, 40))) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in catalog.QUERIES["op8_iblt"](spark, str(tmp_path)).collect()}
    parts = lambda t: {p for p in re.split(r"\n|(?<=[.!?]) ", t) if p.strip()}
    for i, text in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        for other, got in ((after, rows[i].near_next), (edited, rows[i].near_edited)):
            a, b = parts(text), parts(other)
            assert abs(got - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-9
