"""The trie and its totals against brute force, and the cases that must not break them."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from coursepulse.llm import catalog, prefix_trie

SAID = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t, role or "", text or ""))
    for c in own:
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        own[c].sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = tuple((r, x) for _, r, x in own.get(base, [])[:h] + turns[h:])
    return out


def trie_by_hand(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out, leaves, saved = [], {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = own + sum(saved[k] for k in kids[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(convs[c]) == len(node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None,
                    len(members[node]), len(kids[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def same(found, want):
    return sorted((tuple(r[n] for n in NAMES) for r in found), key=repr) == sorted(want, key=repr)


def talk(seed=1, conversations=250, most=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 900), conversations):
        for k in range(rng.randint(1, most)):
            turn = rng.choice([k, k, k, None])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "cé"])))
    return rows


def query(spark, path, rows):
    spark.createDataFrame(rows, SAID).write.parquet(f"{path}/conversations.parquet")
    return catalog.QUERIES["op13_prefix_trie"](spark, str(path)).collect()


def test_query_with_nulls_ties_and_copies(spark, tmp_path):
    rows = talk() + [(None, 0, "user", "x"), (2000, 0, "user", "y" * 100000)]
    rows += [(c, k, "user", f"t{k}") for c in range(5000, 5300) for k in range(4)]
    assert same(query(spark, tmp_path, rows), trie_by_hand(rebuilt_by_hand(rows)))


@pytest.mark.parametrize("block", [3, 8192])
def test_a_long_conversation_over_many_blocks(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", block)
    monkeypatch.setattr(prefix_trie, "PART_IDS", 2)
    rows = [(1, k, "user", f"w{k % 3}") for k in range(150)] + [(2, k, "user", f"w{k % 3}") for k in range(90)]
    rows += [(3, k, "user", f"w{k % 4}") for k in range(40)] + [(c, 0, "user", "w0") for c in range(100, 130)]
    assert same(query(spark, tmp_path, rows), trie_by_hand(rebuilt_by_hand(rows)))


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, []) == []


@pytest.mark.parametrize("kind", ["chain", "star", "random", "comb"])
def test_totals_of_any_tree(spark, kind):
    rng = random.Random(7)
    parent = {0: None}
    for i in range(1, 300):
        parent[i] = {"chain": i - 1, "star": 0, "random": rng.randrange(i), "comb": i - 1 if i % 2 else max(0, i - 2)}[kind]
    depth, want = {}, {}
    for i, p in parent.items():
        depth[i] = 0 if p is None else depth[p] + 1
        want[i] = i
    for i in sorted(parent, reverse=True):
        if parent[i] is not None:
            want[parent[i]] += want[i]
    tree = spark.createDataFrame(
        [(str(i), None if p is None else str(p), depth[i], i) for i, p in parent.items()],
        "id string, parent string, depth long, v long",
    )
    got = prefix_trie.subtree_totals(tree, ["v"]).collect()
    assert {int(r.id): r.v for r in got} == want
    assert {int(r.id): r.n_children for r in got} == {i: sum(p == i for p in parent.values()) for i in parent}


def test_ids_of_many_parts_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART_IDS", 10)
    ids = [-25, -3, 0, 7, 9, 10, 100, 1000]
    ends = spark.createDataFrame([("a", i) for i in reversed(ids)] + [("b", 5)], "id string, conv_id long")
    got = {r.id: r.sha256 for r in prefix_trie.hashed_ids(ends).collect()}
    assert got == {"a": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   "b": hashlib.sha256(b"5").hexdigest()}


def test_query_covers_its_table(spark, sf):
    said = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = trie_by_hand(rebuilt_by_hand([tuple(r) for r in said.collect()]))
    found = catalog.QUERIES["op13_prefix_trie"](spark, sf)
    assert [t for _, t in found.dtypes] == ["bigint"] * 7 + ["string"]
    assert found.filter(F.col("n_convs") < 1).isEmpty() and same(found.collect(), want)
