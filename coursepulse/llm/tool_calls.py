"""Chat formatting: tool calls linked to results, ordered, validated, as canonical JSON.

Calls and results meet in a hash join by conversation and identifier. A call may name the call
whose result it builds on (its parent); levels come from pointer doubling, so that a chain of n
calls takes log2(n) joins, and a conversation of any length is never one task's group. Arguments
are checked against the tool's schema. Messages are objects with sorted keys and no blanks.

Of repeated calls or results of one identifier the first by turn, then by content, is linked; the
others stay, marked alike, at its level. Rows equal in every column are one. A null identifier
or conversation never links; a null turn comes first. Arguments that are no JSON object, tools
without schema, missing, unknown and wrongly typed keys, calls without result, results without
call, unknown parents and cycles (all their calls, and those that build on them) are told in
``problems``; such rows stay. Empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coursepulse.plans.ranks import global_row_number
from coursepulse.session import materialize

# JSON types by the names that a variant's schema gives them.
KINDS = {
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
    "string": "^STRING$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<",
    "object": "^OBJECT<",
}
MARK = "\x1f"


def schema_frame(spark: SparkSession, tools: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """(name, rules) from tool to key to (kind, required)."""
    rows = [
        (name, [(key, kind, required) for key, (kind, required) in sorted(keys.items())])
        for name, keys in tools.items()
    ]
    return spark.createDataFrame(
        rows, "name string, rules array<struct<key:string,kind:string,required:boolean>>"
    )


def _key(conv: str, call: Column, *else_by: str) -> Column:
    """Conversation and identifier as one text; a key of its own where either is null."""
    # xxhash64 skips nulls, so the fields' places are hashed with them.
    fields = F.struct(*(F.col(c).isNull() for c in else_by))
    alone = F.concat(F.lit("null" + MARK), F.hex(F.xxhash64(call, *else_by, fields)))
    return F.coalesce(F.concat(F.col(conv).cast("string"), F.lit(MARK), call), alone)


def _repeats(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(key, name) once for each distinct row; and the least of each key with its rows' number."""
    rows = materialize(rows.groupBy("key", name).agg(F.count(F.lit(1)).alias("n")), f"{name}s")
    return rows.drop("n"), rows.groupBy("key").agg(F.min(name).alias(name), F.sum("n").alias(f"{name}s"))


def levels(calls: DataFrame) -> DataFrame:
    """(key, level, lost, cyclic) of calls (key, parent); roots have level 0.

    ``lost``: the parent is no call. A call on or behind a cycle never reaches a root; after as
    many doublings as the number of calls allows, its level is null.
    """
    known = calls.select(F.col("key").alias("parent"), F.lit(True).alias("there"))
    state = materialize(
        calls.join(known, "parent", "left").select(
            "key",
            F.when(F.col("there"), F.col("parent")).alias("to"),
            F.when(F.col("there"), 1).otherwise(0).cast("bigint").alias("level"),
            (F.col("parent").isNotNull() & F.col("there").isNull()).alias("lost"),
        ),
        "call-levels",
    )
    open_calls = state.filter("to IS NOT NULL")
    total = state.count()
    for _ in range(math.ceil(math.log2(total)) + 1 if total else 0):
        if open_calls.isEmpty():
            break
        ahead = state.select(
            F.col("key").alias("to"), F.col("to").alias("next"), F.col("level").alias("more")
        )
        moved = open_calls.join(ahead, "to").select(
            "key", F.col("next").alias("to"), (F.col("level") + F.col("more")).alias("level"), "lost"
        )
        state = materialize(state.filter("to IS NULL").union(moved), "call-levels")
        open_calls = state.filter("to IS NOT NULL")
    cyclic = F.col("to").isNotNull()
    return state.select(
        "key", F.when(~cyclic, F.col("level")).alias("level"), "lost", cyclic.alias("cyclic")
    )


def problems_of(arguments: Column, rules: Column) -> Column:
    """What is wrong with a call's arguments, sorted."""
    entries = F.map_entries(F.from_json(arguments, "map<string,variant>"))
    is_object = F.schema_of_variant(F.try_parse_json(arguments)).startswith("OBJECT")
    key_of = lambda e: e["key"]
    given = F.transform(entries, key_of)
    missing = F.filter(rules, lambda r: r["required"] & ~F.array_contains(given, r["key"]))
    unknown = F.array_except(given, F.transform(rules, key_of))
    kinds = F.map_from_arrays(
        F.array(*(F.lit(k) for k in KINDS)), F.array(*(F.lit(p) for p in KINDS.values()))
    )
    wrong = F.filter(
        entries,
        lambda e: F.exists(
            rules,
            lambda r: (r["key"] == e["key"])
            & ~F.regexp_like(
                F.coalesce(F.schema_of_variant(e["value"]), F.lit("VOID")),
                F.element_at(kinds, r["kind"]),
            ),
        ),
    )
    told = lambda label, keys: F.transform(keys, lambda k: F.concat(F.lit(label), k))
    checked = F.concat(
        told("missing:", F.transform(missing, key_of)),
        told("type:", F.transform(wrong, key_of)),
        told("unknown:", unknown),
    )
    return (
        F.when(~F.coalesce(is_object, F.lit(False)), F.array(F.lit("arguments")))
        .when(rules.isNull(), F.array(F.lit("tool")))
        .otherwise(F.array_sort(checked))
    )


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call and each result, in topological order within the conversation.

    calls: conv_id, call_id, parent_id, turn, name, arguments (JSON text); results: conv_id,
    call_id, turn, content; schemas: see ``schema_frame``, one row a tool. Rows: conv_id,
    position (from 0), kind, call_id, level, problems and message.
    """
    every_call, asked = _repeats(
        calls.withColumn(
            "key", _key("conv_id", F.col("call_id"), "conv_id", "turn", "name", "arguments", "parent_id")
        )
        .withColumn(
            "parent",
            F.when(F.col("parent_id").isNotNull(), _key("conv_id", F.col("parent_id"), "conv_id")),
        )
        .select("key", F.struct("turn", "name", "arguments", "parent", "conv_id", "call_id").alias("call")),
        "call",
    )
    every_result, told = _repeats(
        results.withColumn("key", _key("conv_id", F.col("call_id"), "conv_id", "turn", "content"))
        .select("key", F.struct("turn", "content", "conv_id", "call_id").alias("result")),
        "result",
    )
    depth = levels(asked.select("key", F.col("call.parent").alias("parent")))
    met = materialize(
        asked.hint("shuffle_hash")
        .join(told.hint("shuffle_hash"), "key", "full")
        .withColumns({"asked": F.col("call").isNotNull(), "answered": F.col("result").isNotNull()}),
        "call-pairs",
    )

    def others(every: DataFrame, name: str) -> DataFrame:
        """The repeated rows that are not linked, without their counterpart."""
        first = met.filter(F.col(f"{name}s") > 1).withColumnRenamed(name, "first")
        rest = first.join(every, "key").filter(~F.col(name).eqNullSafe(F.col("first")))
        gone = "result" if name == "call" else "call"
        kept = rest.drop("first").withColumn(gone, F.lit(None).cast(met.schema[gone].dataType))
        return kept.select(*met.columns)

    linked = (
        met.union(others(every_call, "call"))
        .union(others(every_result, "result"))
        .join(depth, "key", "left")
        .join(schemas.select(F.col("name").alias("tool"), "rules"), F.col("call.name") == F.col("tool"), "left")
    )
    has_call, has_result = F.col("call").isNotNull(), F.col("result").isNotNull()
    flag = lambda test, label: F.when(test, F.array(F.lit(label))).otherwise(F.array())
    call_problems = F.concat(
        flag(F.col("calls") > 1, "repeated"),
        flag(F.col("cyclic"), "cycle"),
        flag(F.col("lost"), "parent"),
        flag(~F.col("answered"), "no result"),
        problems_of(F.col("call.arguments"), F.col("rules")),
    )
    result_problems = F.concat(
        flag(F.col("results") > 1, "repeated"), flag(~F.col("asked"), "no call")
    )
    value = F.try_parse_json("call.arguments")
    # Fields in the order of their names; a variant prints its own keys sorted.
    call_message = F.to_json(
        F.struct(
            F.coalesce(value, F.to_variant_object(F.struct(F.col("call.arguments").alias("text")))).alias("arguments"),
            F.col("call.call_id").alias("call_id"),
            F.col("call.name").alias("name"),
            F.lit("call").alias("type"),
        )
    )
    result_message = F.to_json(
        F.struct(
            F.col("result.call_id").alias("call_id"),
            F.col("result.content").alias("content"),
            F.lit("result").alias("type"),
        )
    )
    row = lambda kind, source, step, problems, message: F.struct(
        F.lit(kind).alias("kind"),
        F.col(f"{source}.conv_id").alias("conv_id"),
        F.col(f"{source}.call_id").alias("call_id"),
        F.col(f"{source}.turn").alias("turn"),
        (F.col("level") * 2 + step).alias("level"),
        problems.alias("problems"),
        message.alias("message"),
    )
    # Where a call has no level, and for results without call, the turn decides behind the others.
    both = F.array(
        F.when(has_call, row("call", "call", 0, call_problems, call_message)),
        F.when(has_result, row("result", "result", 1, result_problems, result_message)),
    )
    events = linked.select(F.explode(F.filter(both, lambda x: x.isNotNull())).alias("e")).select("e.*")
    order = [
        F.col("conv_id").asc_nulls_first(),
        F.col("level").asc_nulls_last(),
        F.col("turn").asc_nulls_first(),
        F.col("kind").asc(),
        F.col("call_id").asc_nulls_first(),
        F.col("message").asc(),
    ]
    placed = materialize(global_row_number(events, order, "place", first=0), "call-places")
    first = materialize(
        placed.groupBy("conv_id").agg(F.min("place").alias("first")), "call-first"
    ).withColumnRenamed("conv_id", "of")
    return placed.join(first, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id",
        (F.col("place") - F.col("first")).alias("position"),
        "kind",
        "call_id",
        "level",
        F.array_join("problems", ",").alias("problems"),
        "message",
    )
