"""Repaired conversations against brute force, and the cases that must not break them."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict
from itertools import groupby

import numpy as np
import pytest

from coursepulse.llm import catalog, path_ranking

SAID = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
FORM = {"": "su", "s": "u", "u": "a", "a": "u"}
EMPTY = hashlib.sha256(b"").hexdigest()


def cheapest(rows, faults):
    """(cost, audit, messages) by best-first search over (cost, audit)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, made = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(made)
        due = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[due]
        push = lambda *x: heapq.heappush(heap, x)
        push(cost + 3, audit + "I", i, due, (*made, (name, "")))
        if i < len(rows):
            role, text = rows[i]
            push(cost + 4, audit + "D", i + 1, last, made)
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                if role[:1] and role[:1] in FORM[last]:
                    push(cost + more, audit + "K", i + 1, role[:1], (*made, (role, text)))
                push(cost + more + 3, audit + "R", i + 1, due, (*made, (name, text)))


def faults_by_hand(rows):
    out, seen = [], set()
    for row in rows:
        bare = "".join(WORD.findall(row[1]))
        if not bare:
            out.append("blank")
        elif row in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add(row)
    return out


def by_hand(table, damaged=True):
    """conv_id to the digest of the query."""
    out = {}
    groups = defaultdict(list)
    for c, t, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        out[c] = (0, 0, 0, 0, 0, 0, "", EMPTY)
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(key.encode()) % 20 if damaged else 19
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        groups[c] += [(t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for c, rows in groups.items():
        if not rows:
            continue
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        rows = [(role, text) for _, role, text in rows]
        faults = faults_by_hand(rows)
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:]))
        cost, audit, made = cheapest(rows, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[c] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def digest_of(rows):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


def talk(seed, conversations=60, most=12, turn=lambda rng, k: k):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for k in range(rng.randint(1, most)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "Yes.", "No!", "cut off", "", " \n", "Why?  ", None, f"w{rng.randrange(99)}."])
            rows.append((c, turn(rng, k), role, text))
    return rows


@pytest.mark.parametrize("block_rows", [1, 2, 7, 8192])
def test_same_as_by_hand_at_any_block_size(spark, block_rows):
    rows = talk(1) + [(99, k, *r[2:]) for k, r in enumerate(talk(2, 1, 40) * 2)] + talk(3, 1, 60)
    rows = [(c + 200 * (i >= len(rows) - 60 and c == 0), t, r, x) for i, (c, t, r, x) in enumerate(rows)]
    found = path_ranking.repair(spark.createDataFrame(rows, SAID).repartition(3), block_rows).collect()
    want = by_hand(rows, damaged=False)
    found.sort(key=lambda r: r["at"])
    assert len(found) == len(rows)
    for c, own in groupby(found, key=lambda r: r.conv_id):
        own = list(own)
        text = "\n".join(f"{m.role}:{m.text}" for r in own for m in r.messages)
        got = (*(sum(r.fault == f for r in own) for f in ("blank", "duplicate", "truncated")),
               sum(r.illegal for r in own), sum(r.cost for r in own), "".join(r.edits for r in own),
               hashlib.sha256(text.encode()).hexdigest())
        assert got == want[c][1:], c


def test_one_long_conversation_over_many_blocks(spark):
    rows = [(1, k, *r[2:]) for k, r in enumerate(talk(4, 40, 20))]
    found = sorted(path_ranking.repair(spark.createDataFrame(rows, SAID), 5).collect(), key=lambda r: r["at"])
    want = by_hand(rows, damaged=False)[1]
    assert ("".join(r.edits for r in found), sum(r.cost for r in found)) == (want[6], want[5])


def test_query_with_nulls_ties_and_gaps(spark, tmp_path):
    rows = talk(5, 80, turn=lambda rng, k: rng.choice([None, k, k, 2 * k]))
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (None, 3, "user", "Hi."), (1000, 5, "user", "x" * 200000)]
    spark.createDataFrame(rows, SAID).write.parquet(f"{tmp_path}/conversations.parquet")
    got = digest_of(catalog.QUERIES["op12_path_ranking"](spark, str(tmp_path)).collect())
    assert got == by_hand(rows)


def test_rows_that_all_go_leave_an_empty_digest(spark, tmp_path):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = [(c, 0, "user", "Hi.") for c in gone]
    spark.createDataFrame(rows, SAID).write.parquet(f"{tmp_path}/conversations.parquet")
    got = digest_of(catalog.QUERIES["op12_path_ranking"](spark, str(tmp_path)).collect())
    assert gone and got == {c: (0, 0, 0, 0, 0, 0, "", EMPTY) for c in gone}


def test_empty_table_and_further_columns(spark, tmp_path):
    spark.createDataFrame([], SAID).write.parquet(f"{tmp_path}/conversations.parquet")
    assert catalog.QUERIES["op12_path_ranking"](spark, str(tmp_path)).collect() == []
    more = spark.createDataFrame([(1, 0, "user", "Hi.", 7, 8)], f"{SAID}, edits int, at int")
    assert [r.edits for r in path_ranking.repair(more).collect()] == ["KI"]  # 3, to delete is 4


def test_ranks_take_the_least_of_equal_costs():
    who, fault = np.array([1, 1]), np.array([0, 0])
    paths = path_ranking.Paths(
        who, fault, np.zeros(2, np.int64), path_ranking.AT_END[None], np.array([False])
    )
    # Rerolling the second row costs 3; inserting twice 6, deleting and inserting 7.
    assert paths.edits(np.array([path_ranking.START]))[0] == ["K", "R"]


def test_query_covers_its_table(spark, sf):
    said = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = by_hand([tuple(r) for r in said.collect()])
    assert digest_of(catalog.QUERIES["op12_path_ranking"](spark, sf).collect()) == want
