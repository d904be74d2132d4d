"""A trie of conversations by their first turns, and its subtree totals by tree contraction.

Conversations that begin with the same turns (role and text) share the nodes of these turns. A
node's key is its depth and 120 bits that its turns give, each hashed with its place, so that keys
are running sums (exclusive or) over a conversation. Sums are taken within blocks of turns, then
over blocks.

``subtree_totals`` contracts the tree in rounds of joins until nothing is left. In a round

- rake: each leaf is removed and its totals are added to its parent's;
- compress: of each chain of nodes with a single child every other one is taken out (those whose
  depth has the round's bit set, by hash where neighbours agree), never two neighbours. What it
  holds moves onto the arc between its parent and its child.

Then nodes that were taken out are expanded again: such a node's total is that of the child it
had, plus what it held and what was on the arc below it. The child may have been taken out later;
pointers are doubled until each leads to a raked node. The number of rounds grows with the
logarithm of the number of nodes, also for one long chain or a node with very many children.

Roles and texts that are null count as empty. Rows go by turn, null turns first, equal turns by the
hash of role and text. Null conversation ids are not conversations: their rows are left out. Equal
rows are turns of their own. Texts are hashed where they are read, long ones too; nothing else
moves. An empty table gives an empty result; further columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from coursepulse.plans.ranks import global_row_number
from coursepulse.session import materialize

BLOCK_ROWS = 8192
PART_IDS = 1 << 16  # so many consecutive ids are listed at a time
ROOT = "0-0-0"
BITS = 20  # of a depth that choose whom a round takes out; then these again


def ordered(said: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (at, conv_id, block, digest, chars), and conversations (conv_id, first, last).

    ``at`` numbers all rows by conversation and turn; ``digest`` stands for role and text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = said.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("bigint").alias("chars"),
        F.monotonically_increasing_id().alias("_same"),
    )
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "digest", "_same")]
    rows = materialize(
        global_row_number(slim, order, "at", first=0).select(
            "at", "conv_id", F.floor(F.col("at") / BLOCK_ROWS).cast("bigint").alias("block"), "digest", "chars"
        ),
        "trie-rows",
    )
    return rows, rows.groupBy("conv_id").agg(F.min("at").alias("first"), F.max("at").alias("last"))


def with_conversation(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``rows`` with the columns of their conversation, joined block by block: no key is hot."""
    at = lambda name: F.floor(F.col(name) / BLOCK_ROWS).cast("bigint")
    spans = conversations.withColumn("block", F.explode(F.sequence(at("first"), at("last"))))
    return rows.join(spans, ["conv_id", "block"])


def members(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, id, parent, chars, ends) of each conversation at each of its nodes.

    ``turns`` has conv_id, depth (from 1, gapless), digest, chars and n_turns. A conversation's
    root is not among them.
    """
    hashed = F.sha2(F.concat_ws(":", "depth", "digest"), 256)
    half = lambda at: F.conv(F.substring(hashed, at, 15), 16, 10).cast("bigint")
    keyed = turns.withColumns(
        {"part": F.floor(F.col("depth") / BLOCK_ROWS), "x": half(1), "y": half(16)}
    )
    keyed = materialize(keyed.drop("digest"), "trie-turns")
    xor = lambda name, over: F.bit_xor(name).over(over)
    parts = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy("conv_id", "part").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    before = sums.select(
        "conv_id",
        "part",
        *(F.coalesce(xor(n, parts), F.lit(0).cast("bigint")).alias(f"{n}_before") for n in "xy"),
    )
    own = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = {f"{n}_run": xor(n, own) for n in "xy"}
    found = keyed.join(before, ["conv_id", "part"]).withColumns(run)
    here = [F.hex(F.col(f"{n}_before").bitwiseXOR(F.col(f"{n}_run"))) for n in "xy"]
    above = [F.hex(F.col(f"{n}_before").bitwiseXOR(F.col(f"{n}_run")).bitwiseXOR(F.col(n))) for n in "xy"]
    return found.select(
        "conv_id",
        "depth",
        F.concat_ws("-", "depth", *here).alias("id"),
        F.concat_ws("-", F.col("depth") - 1, *above).alias("parent"),
        "chars",
        (F.col("depth") == F.col("n_turns")).alias("ends"),
    )


def _priority(key: Column, depth: Column, step: int) -> Column:
    """Neighbours never have the same; the root, which stays, has the least."""
    bit = F.shiftright(depth, step % BITS).bitwiseAND(1)
    return F.struct(
        F.when(depth == 0, -1).otherwise(bit).cast("bigint"), F.xxhash64(key, F.lit(step)), key
    )


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(id, n_children, totals of ``values``) of each node of ``tree`` (id, parent, depth, values).

    The parent of a root is null, its depth 0; other depths are one more than the parent's.
    """
    kids = tree.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    start = tree.join(kids, "id", "left").select(
        "id",
        "parent",
        F.col("depth").cast("bigint").alias("depth"),
        (F.col("depth") - 1).cast("bigint").alias("parent_depth"),
        F.coalesce("n_children", F.lit(0)).alias("kids"),
        *(F.col(v).cast("bigint").alias(v) for v in values),
        *(F.lit(0).cast("bigint").alias(f"{v}_up") for v in values),
    )
    state = materialize(start, "contract")
    children = state.select("id", F.col("kids").alias("n_children"))
    leaf = F.col("kids") == 0
    raked, spliced, step = [], [], 0
    while True:
        # What each parent learns of its children: leaves' totals, and the only other one.
        told = state.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            F.count_if(leaf).alias("gone"),
            F.max(F.when(~leaf, F.struct("id", "depth", *(f"{v}_up" for v in values)))).alias("child"),
            *(F.sum(F.when(leaf, F.col(v) + F.col(f"{v}_up"))).alias(f"{v}_raked") for v in values),
        )
        left = F.col("kids") - F.coalesce("gone", F.lit(0))
        prior = _priority(F.col("id"), F.col("depth"), step)
        out = (
            (left == 1)
            & F.col("child").isNotNull()
            & F.col("parent").isNotNull()
            & (prior > _priority(F.col("child.id"), F.col("child.depth"), step))
            & (prior > _priority(F.col("parent"), F.col("parent_depth"), step))
        )
        done = materialize(
            state.join(told, "id", "left").select(
                "id",
                "parent",
                "depth",
                "parent_depth",
                leaf.alias("leaf"),
                left.alias("kids"),
                F.coalesce(out, F.lit(False)).alias("out"),
                "child",
                *((F.col(v) + F.coalesce(f"{v}_raked", F.lit(0))).alias(v) for v in values),
                *(f"{v}_up" for v in values),
            ),
            "contract",
        )
        raked.append(done.filter("leaf").select("id", *values))
        if done.filter("NOT leaf").isEmpty():
            break
        taken = done.filter("out")
        spliced.append(
            taken.select(
                "id",
                F.col("child.id").alias("to"),
                *((F.col(v) + F.col(f"child.{v}_up")).alias(v) for v in values),
            )
        )
        moved = taken.select(
            F.col("child.id").alias("id"),
            F.col("parent").alias("_parent"),
            F.col("parent_depth").alias("_depth"),
            *((F.col(v) + F.col(f"{v}_up")).alias(f"_{v}") for v in values),
        )
        state = done.filter("NOT leaf AND NOT out").join(moved, "id", "left").select(
            "id",
            F.coalesce("_parent", "parent").alias("parent"),
            "depth",
            F.coalesce("_depth", "parent_depth").alias("parent_depth"),
            "kids",
            *values,
            *((F.col(f"{v}_up") + F.coalesce(f"_{v}", F.lit(0))).alias(f"{v}_up") for v in values),
        )
        step += 1
    totals = reduce(DataFrame.unionAll, raked)
    if spliced:
        totals = materialize(totals, "contract-raked")
        totals = totals.unionAll(_expanded(reduce(DataFrame.unionAll, spliced), totals, values, step))
    return children.join(totals, "id")


def _expanded(spliced: DataFrame, totals: DataFrame, values: list[str], rounds: int) -> DataFrame:
    """(id, totals) of the nodes that were taken out: pointers to nodes of later rounds, doubled."""
    links = materialize(spliced, "contract-links")
    for _ in range(max(0, (rounds - 1).bit_length())):
        on = links.select(
            F.col("id").alias("to"), F.col("to").alias("_to"), *(F.col(v).alias(f"_{v}") for v in values)
        )
        links = materialize(
            links.join(on, "to", "left").select(
                "id",
                F.coalesce("_to", "to").alias("to"),
                *((F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values),
            ),
            "contract-links",
        )
    ends = totals.select(F.col("id").alias("to"), *(F.col(v).alias(f"_{v}") for v in values))
    return links.join(ends, "to").select("id", *((F.col(v) + F.col(f"_{v}")).alias(v) for v in values))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, sha256) of the parts of each id, which come one after the other."""
    key, digest, ids, out = None, None, [], []

    def send() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.string())], ["id", "sha256"])
        ids.clear()
        out.clear()
        return batch

    for batch in batches:
        for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if i == key:
                digest.update(b"," + part.encode())
                continue
            if key is not None:
                ids.append(key)
                out.append(digest.hexdigest())
            key, digest = i, hashlib.sha256(part.encode())
        if len(ids) > 10000:
            yield send()
    if key is not None:
        ids.append(key)
        out.append(digest.hexdigest())
    yield send()


def hashed_ids(ends: DataFrame) -> DataFrame:
    """(id, sha256): of the ascending conv_id of each id, joined by commas.

    Ids are listed in ranges of PART_IDS, ranges hashed one after the other: however many ids there
    are, none of them is held together with more than a range.
    """
    parts = ends.groupBy("id", F.floor(F.col("conv_id") / PART_IDS).alias("part")).agg(
        F.array_sort(F.collect_list("conv_id")).alias("ids")
    )
    texts = parts.select("id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"), "part")
    dealt = texts.repartition("id").sortWithinPartitions("id", "part")
    return dealt.select("id", "text").mapInArrow(_hashed, "id string, sha256 string")


def build(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each node, from ``turns`` (see ``members``) and all (conv_id, n_turns).

    conv_id is the smallest member, parent_conv_id the parent's; n_convs the members, n_children
    the children, n_leaves the childless nodes of the subtree, saved_tokens the characters that
    members after the first need not repeat, over the subtree; ends_sha256 of the ids that end here.
    """
    deep = members(turns)
    root = conversations.select(
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(ROOT).alias("id"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("bigint").alias("chars"),
        (F.col("n_turns") == 0).alias("ends"),
    )
    at = materialize(deep.withColumn("depth", F.col("depth").cast("bigint")).unionByName(root), "trie-members")
    nodes = materialize(
        at.groupBy("id").agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max("parent").alias("parent"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("chars").alias("chars"),
        ),
        "trie-nodes",
    )
    inner = nodes.select(F.col("parent").alias("id")).distinct().withColumn("n_leaves", F.lit(0))
    tree = nodes.join(inner, "id", "left").select(
        "id",
        "parent",
        "depth",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = hashed_ids(at.filter("ends").select("id", "conv_id"))
    return (
        nodes.join(totals, "id")
        .join(ends, "id", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
