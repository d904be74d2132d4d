"""Shards of near equal bytes for indivisible groups, by Karmarkar-Karp differencing.

Documents of equal text are one group and stay together. Groups are dealt by hash into blocks
of about ``BLOCK_GROUPS``; each block repeatedly combines the two partial partitions of largest
spread, oppositely ordered, until one is left. The blocks' partitions (one number for each
shard and block) are then combined in the same way, in a tree of tasks that each take as many.
A group with more bytes than a shard's share stays whole: it bounds the balance that any division
of whole groups can reach.

Null texts count as empty (size 1: a byte for the row itself). Null ids and repeated rows are
placed like others, equal rows in no particular order among themselves. An empty table gives an
empty result. Further columns are not carried.
"""

from __future__ import annotations

import heapq
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from coursepulse.session import materialize

BLOCK_GROUPS = 1 << 16
# Rows of a shard that one task numbers.
SLOT_ROWS = 5000


def difference(sums: list[tuple[int, ...]], shards: int) -> list[tuple[int, ...]]:
    """For each partial partition the shard of each of its parts.

    ``sums`` has ``shards`` totals for each partial partition; parts of one partition go to
    different shards. Combined partitions with the largest spread come first, ties in order of
    making, so that the result depends on the order of ``sums`` only.

    >>> [x[0] for x in difference([(8, 0), (7, 0), (6, 0), (5, 0), (4, 0)], 2)]
    [1, 0, 1, 0, 0]
    """
    n = len(sums)
    if not n:
        return []
    # An entry's parts in falling order: (total, part). Totals less the smallest: only those count.
    heap, order = [], []
    for i, totals in enumerate(sums):
        parts = sorted(range(shards), key=lambda j: (-totals[j], j))
        low = totals[parts[-1]]
        order.append(parts)
        heap.append((low - totals[parts[0]], i, [totals[j] - low for j in parts]))
    heapq.heapify(heap)
    merged: list[tuple[int, int, list[int]]] = []
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        # a's largest with b's smallest; position j of b joins position shards - 1 - j of a.
        total = [p + q for p, q in zip(x, reversed(y), strict=True)]
        parts = sorted(range(shards), key=lambda j: (-total[j], j))
        low = total[parts[-1]]
        heapq.heappush(
            heap, (low - total[parts[0]], n + len(merged), [total[j] - low for j in parts])
        )
        merged.append((a, b, parts))
    shard_of: dict[int, list[int]] = {heap[0][1]: list(range(shards))}
    for k in range(len(merged) - 1, -1, -1):
        a, b, parts = merged[k]
        at = shard_of.pop(n + k)
        place = [0] * shards
        for position, part in enumerate(parts):
            place[part] = at[position]
        shard_of[a] = place
        shard_of[b] = place[::-1]
    out = []
    for i, parts in enumerate(order):
        places = [0] * shards
        for position, part in enumerate(parts):
            places[part] = shard_of[i][position]
        out.append(tuple(places))
    return out


def assign(groups: DataFrame, shards: int, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """(digest, shard) for ``groups`` (digest, bytes), one row for each digest."""
    blocks = max(1, math.ceil(groups.count() / block_groups))
    dealt = groups.withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)).cast("int"))

    def divided(key, table):
        table = table.sort_by([("bytes", "descending"), ("digest", "ascending")])
        sizes = table.column("bytes").to_pylist()
        parts = difference([(s, *[0] * (shards - 1)) for s in sizes], shards)
        return table.append_column("part", pa.array([p[0] for p in parts], pa.int32()))

    schema = T.StructType([*dealt.schema.fields, T.StructField("part", T.IntegerType())])
    parts = materialize(dealt.groupBy("block").applyInArrow(divided, schema), "shard-parts")
    places = _combined(parts, blocks, shards, max(2, block_groups))
    return parts.join(places, ["block", "part"]).select("digest", "shard")


def _combined(parts: DataFrame, blocks: int, shards: int, fan: int) -> DataFrame:
    """(block, part, shard): the blocks' partitions combined, ``fan`` in a task, level by level.

    A level's results are partial partitions again, until one is left; its parts are the shards.
    Going back down, each part takes the shard of the part that it joined. A task holds ``shards``
    totals for each of ``fan`` partitions, and the driver none.
    """

    def combined(key, table):
        units = sorted(set(table.column("block").to_pylist()))
        at = {unit: i for i, unit in enumerate(units)}
        sums = [[0] * shards for _ in units]
        rows = list(
            zip(*(table.column(c).to_pylist() for c in ("block", "part", "bytes")), strict=True)
        )
        for unit, part, size in rows:
            sums[at[unit]][part] = size
        joined = difference([tuple(x) for x in sums], shards)
        above = [joined[at[unit]][part] for unit, part, _ in rows]
        return table.append_column("joined", pa.array(above, pa.int32()))

    schema = "block int, part int, bytes bigint, above int, joined int"
    levels, units = [], blocks
    rows = parts.select("block", "part", "bytes")
    while not levels or units > 1:
        totals = rows.groupBy("block", "part").agg(F.sum("bytes").alias("bytes"))
        dealt = totals.withColumn("above", F.floor(F.col("block") / fan).cast("int"))
        level = dealt.groupBy("above").applyInArrow(combined, schema)
        levels.append(materialize(level, "shard-level"))
        rows = levels[-1].select(
            F.col("above").alias("block"), F.col("joined").alias("part"), "bytes"
        )
        units = math.ceil(units / fan)
    places = levels[-1].select("block", "part", F.col("joined").alias("shard"))
    for level in reversed(levels[:-1]):
        upper = places.toDF("above", "joined", "shard")
        places = level.join(upper, ["above", "joined"]).select("block", "part", "shard")
    return materialize(places, "shard-joined")


def numbered(placed: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``placed`` with ``slot``: gapless from 0 in each shard.

    Rows are numbered within hash buckets of a shard; a bucket starts where those before end.
    """
    total = placed.count()
    buckets = max(1, math.ceil(total / slot_rows))
    rows = placed.withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets))
    )
    sizes = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        "shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    own = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("_own", F.row_number().over(own) - 1)
        .join(starts, ["shard", "_bucket"])
        .withColumn("slot", F.col("_start") + F.col("_own"))
        .drop("_bucket", "_own", "_start")
    )


def shard(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text: str = "text",
    block_groups: int = BLOCK_GROUPS,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each row."""
    if shards < 2:
        raise ValueError("at least two shards")
    value = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(value).cast("bigint") + 1).alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(value, 256)).alias("digest"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    places = materialize(assign(groups, shards, block_groups), "shard-places")
    placed = materialize(rows.join(places, "digest").drop("digest"), "shard-placed")
    return numbered(placed)
