"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coursepulse.llm import (
    byte_bpe,
    decontaminate,
    golay_simhash,
    iblt,
    path_ranking,
    prefix_trie,
    relative_lz,
    repeats,
    secrets,
    sharding,
    token_counts,
    tool_calls,
    toxicity,
)
from coursepulse.session import materialize

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
FOLDS = 5
SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(value: Column) -> Column:
    return F.sha2(value, 256)


# Tools of the derived calls: key to (kind, required).
TOOLS = {
    "search": {"q": ("string", True), "n": ("integer", False), "turn": ("integer", False)},
    "translate": {"q": ("string", True), "n": ("string", False), "turn": ("integer", False)},
    "summarize": {"q": ("string", True)},
}


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn is a call that builds on the one two turns before; replies are results.

    Every fourth turn from the third leaves its text out of the arguments.
    """
    said = table(spark, sf_dir, "conversations")
    turn, n = F.col("turn"), F.length("text")
    name = lambda step: F.concat(F.lit("t"), (turn - step).cast("string"))
    fields = [turn, F.col("text").alias("q"), n.alias("n")]
    calls = said.filter(F.col("role") == "user").select(
        "conv_id",
        name(0).alias("call_id"),
        F.when(turn >= 2, name(2)).alias("parent_id"),
        "turn",
        F.when(n % 3 == 0, "search").when(n % 3 == 1, "translate").otherwise("summarize").alias("name"),
        F.when(turn % 4 == 2, F.to_json(F.struct(fields[0], fields[2])))
        .otherwise(F.to_json(F.struct(*fields)))
        .alias("arguments"),
    )
    results = said.filter(F.col("role") == "assistant").select(
        "conv_id", name(1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return tool_calls.link(calls, results, tool_calls.schema_frame(spark, TOOLS))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(BYTE_RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    slim = coded.select(
        "doc_id",
        "token_ids",
        _sha256(F.array_join(F.col("token_ids").cast("array<string>"), ",")).alias("ids_sha256"),
    )
    return byte_bpe.decode(slim, ranks).select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        "ids_sha256",
        _sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, carry=["doc_id"])
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    count = lambda kind: F.size(of(kind)).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        _sha256(secrets.digest(of(0, 1, 2))).alias("base_sha256"),
        secrets.digest(F.col("spans")).alias("spans"),
    )


def op4_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = golay_simhash.near_duplicates(docs, shingle=3)
    return found.select(
        "doc_id", golay_simhash.hex_digits("fp").alias("fingerprint"), "component_id"
    )


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt; null ids are none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    scored = toxicity.fit_and_score(docs, labels, keep=["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        "rejected",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, WORD_BPE)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op8_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = iblt.SENTENCE_END
    return iblt.compare(iblt.edited_versions(table(spark, sf_dir, "documents"), end=end), end)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        _sha256(F.col("kept")).alias("kept_sha256"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = relative_lz.remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_words", gone.alias("n_removed"), _sha256(F.col("kept")).alias("kept_sha256")
    )


PART_ROWS = 4096  # rows whose messages are joined before those of a whole conversation


def damage(said: DataFrame) -> DataFrame:
    """``conversations`` with faults, by the checksum of each row's ids; nulls are one space."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat_ws(":", text("conv_id"), text("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    bare = F.regexp_replace(text("text"), "[.!?]", "")
    return (
        said.withColumn("_kind", kind)
        .filter("_kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(text("role")).alias("role"),
            F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, bare).otherwise(text("text")).alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy"),
        )
        .drop("_copy")
    )


def op12_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with faults, repaired; the damage is part of the query."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = materialize(path_ranking.repair(damage(said)), "repaired")
    line = F.transform("messages", lambda m: F.concat_ws(":", m["role"], m["text"]))
    parts = rows.groupBy("conv_id", F.floor(F.col("at") / PART_ROWS).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("at", "edits", line.alias("lines")))).alias("x")
    )
    joined = parts.select(
        "conv_id",
        F.struct(
            "part",
            F.array_join(F.col("x.edits"), "").alias("edits"),
            F.flatten(F.col("x.lines")).alias("lines"),
        ).alias("x"),
    )
    texts = joined.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    of = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = rows.groupBy("conv_id").agg(
        turns.alias("gaps"),
        of("blank"),
        of("duplicate"),
        of("truncated"),
        F.count_if("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
    )
    ids = said.select(F.col("conv_id").alias("id")).distinct()
    found = counts.withColumnRenamed("conv_id", "c").join(
        texts.withColumnRenamed("conv_id", "t"), F.col("c").eqNullSafe(F.col("t"))
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
    empty = F.array().cast("array<string>")
    return ids.join(found, F.col("id").eqNullSafe(F.col("c")), "left").select(
        F.col("id").alias("conv_id"),
        *(zero(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce(F.array_join(F.col("x.edits"), ""), F.lit("")).alias("audit"),
        _sha256(F.array_join(F.coalesce(F.flatten("x.lines"), empty), "\n")).alias("repaired_sha256"),
    )


def rebuilt(said: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): each begins with the first turns of the hundred's first one.

    How many are taken is the checksum of its own id, modulo 6; its own turns follow from there.
    """
    rows, found = prefix_trie.ordered(said)
    c = F.col("conv_id")
    sized = found.select(
        "conv_id",
        "first",
        "last",
        (F.crc32(c.cast("string").cast("binary")) % 6).alias("h"),
        (c - c % 100).alias("base"),
    )
    bases = found.select(
        c.alias("base"), F.col("first").alias("begin"), (F.col("last") - F.col("first") + 1).alias("n")
    )
    heads = F.least("h", F.coalesce("n", F.lit(0)))
    own = F.greatest(F.col("last") - F.col("first") + 1 - F.col("h"), F.lit(0))
    convs = materialize(
        sized.join(bases, "base", "left")
        .withColumn("n_head", heads)
        .select("conv_id", "first", "last", "h", "begin", "n_head", (F.col("n_head") + own).alias("n_turns")),
        "trie-conversations",
    )
    taken = convs.filter("n_head > 0").select(
        "conv_id", "n_turns", "begin", F.explode(F.sequence(F.lit(1), F.col("n_head"))).alias("depth")
    )
    lent = rows.select("at", "digest", "chars")
    begun = taken.withColumn("at", F.col("begin") + F.col("depth") - 1).join(lent, "at")
    place = F.col("at") - F.col("first") - F.col("h")
    kept = prefix_trie.with_conversation(rows, convs).filter(place >= 0)
    names = ["conv_id", "depth", "digest", "chars", "n_turns"]
    turns = begun.select(*names).union(
        kept.withColumn("depth", F.col("n_head") + place + 1).select(*names)
    )
    return turns, convs.select("conv_id", "n_turns")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.build(*rebuilt(said))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tool_calls": op1_tool_calls,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secrets": op3_secrets,
    "op4_golay_simhash": op4_golay_simhash,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_decontaminate": op7_decontaminate,
    "op8_iblt": op8_iblt,
    "op9_repeats": op9_repeats,
    "op10_sharding": op10_sharding,
    "op11_relative_lz": op11_relative_lz,
    "op12_path_ranking": op12_path_ranking,
    "op13_prefix_trie": op13_prefix_trie,
}
