"""Repeated word windows against brute force, and the cases that must not break them."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursepulse.llm import catalog, relative_lz
from tests.llm.test_operators import DOC, corpus, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SIZE = relative_lz.WINDOW


def cut_by_hand(rows):
    """(id, n_words, n_removed, kept) of each (id, text); null ids come last, and apart."""
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, words in texts:
        for k in range(len(words) - SIZE + 1):
            key = tuple(words[k : k + SIZE])
            least[key] = min(least.get(key, float("inf")), float("inf") if i is None else i)
    out = []
    for i, words in texts:
        gone = [False] * len(words)
        for k in range(len(words) - SIZE + 1):
            if least[tuple(words[k : k + SIZE])] < (float("inf") if i is None else i):
                gone[k : k + SIZE] = [True] * SIZE
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), kept))
    return out


def got(df):
    return [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in df.collect()]


def by_key(rows):
    return sorted(rows, key=repr)


def tangled(seed=3, n=80):
    """Texts made of shared passages, cut and joined at any place, with words replaced."""
    rng = random.Random(seed)
    stock = [prose(rng, rng.randint(10, 60)).split() for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(1, 6)):
            if rng.random() < 0.7:
                passage = rng.choice(stock)
                start = rng.randrange(len(passage))
                part = passage[start : start + rng.randint(1, 50)]
                if rng.random() < 0.3:
                    part = part[:]
                    part[rng.randrange(len(part))] = f"new{rng.randrange(99)}"
                words += part
            else:
                words += prose(rng, rng.randint(1, 20)).split()
        rows.append((rng.randrange(10**6) if rng.random() < 0.9 else 77, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize("chunk_bytes", [1, 3000, 1 << 20])
@pytest.mark.parametrize("hot", [1, 256])
def test_same_as_by_hand(spark, chunk_bytes, hot):
    rows = tangled() + [(i + 10**7, t) for i, t in corpus(30)]
    df = relative_lz.remove_repeats(
        spark.createDataFrame(rows, DOC).repartition(3), chunk_bytes=chunk_bytes, hot_pieces=hot
    )
    want = cut_by_hand(rows)
    assert sum(r[2] for r in want) > 500
    assert by_key(got(df)) == by_key(want)


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(relative_lz, "BLOCK_OFFERS", 50)
    monkeypatch.setattr(relative_lz, "BLOCK_PIECES", 20)
    rows = tangled(5)
    df = relative_lz.remove_repeats(spark.createDataFrame(rows, DOC).repartition(2), chunk_bytes=2000)
    assert by_key(got(df)) == by_key(cut_by_hand(rows))


def test_awkward_rows(spark):
    rng = random.Random(8)
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (None, text), (3, text), (3, text), (4, None), (5, ""), (6, " \n\t "),
            (7, " ".join(f"w{i}" for i in range(12))), (8, f"{text}\x85{text}"), (9, f"\x0b{text}\x0c"),
            (-1, prose(rng, 20000)), (10, "x" * 100000), (11, "a " * 40), (12, "a " * 40)]
    docs = spark.createDataFrame(rows, DOC).withColumns({"spans": F.lit(1), "kept": F.lit("k")})
    assert by_key(got(relative_lz.remove_repeats(docs))) == by_key(cut_by_hand(rows))
    assert relative_lz.remove_repeats(docs.limit(0)).collect() == []


def test_factors_are_greedy_and_checked_at_their_ends():
    word = lambda text: b"".join(b"%-8s" % w.encode() for w in text.split())
    reference = relative_lz.Reference()
    names = [f"a{i}" for i in range(30)]
    reference.add(word(" ".join(names[:20])))
    reference.add(word(" ".join(names[5:30])))
    # The longest match from the start ends at 20; windows across that end are in the second text.
    assert reference.factors(word(" ".join(names))) == [(0, 20), (8, 30)]
    assert reference.factors(word("x " + " ".join(names[:13]) + " y")) == [(1, 14)]
    assert reference.factors(word(" ".join(names[:12]))) == []


def test_words_are_those_of_the_pattern():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab\x1f \n\x0b\x0c\x85 é") for _ in range(rng.randrange(30))) for _ in range(200)]
    body = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(body), np.uint8)
    starts, ends = relative_lz.words(data, np.cumsum([len(b) for b in body]))
    found = [data[s:e].tobytes().decode() for s, e in zip(starts, ends)]
    assert found == [w for t in texts for w in WORD.findall(t)]


def test_query_covers_its_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {
        i: (n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for i, n, gone, kept in cut_by_hand([tuple(r) for r in docs])
    }
    rows = catalog.QUERIES["op11_relative_lz"](spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want
