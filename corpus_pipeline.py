"""A corpus pipeline over ``documents``: filter, deduplicate, decontaminate, redact, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor. All but the last
return the columns of ``docs``. Stages name columns by place inside, so that further columns,
whatever their names, pass through. Null texts count as empty; rows with a null id are judged
alone, and equal ones kept once; empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from coursepulse.llm import byte_bpe, catalog, decontaminate, golay_simhash, secrets, toxicity
from coursepulse.session import materialize

ORACLE_SQL = None  # learnt scores and fingerprints: tests hold the stages against brute force


def _inner(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns doc_id, text and lang kept in name and all others named by place."""
    own = {"doc_id", "text", "lang"}
    names = [n if n in own else f"column_{i}" for i, n in enumerate(docs.columns)]
    return docs.toDF(*names), names


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above their language's threshold go."""
    plain, names = _inner(docs)
    labels = catalog.table(spark, sf_dir, "labels")
    labels = labels.filter(~catalog.held_out(F.col("doc_id")))
    scored = toxicity.fit_and_score(plain, labels)
    return scored.filter(~F.col("rejected")).select(*names).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays, once.

    Groups are those of ``op4``'s contract: three-word shingles, 2 of 64 bits. Of rows that share
    an id the one with the least hash of its text stays. Rows with a null id are no
    near-duplicates; of those with equal texts one stays.
    """
    plain, names = _inner(docs)
    found = golay_simhash.near_duplicates(plain.select("doc_id", "text"), shingle=3)
    by_id = materialize(
        found.groupBy("doc_id").agg(
            F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n")
        ),
        "dedup-ids",
    )
    # Joined alike at every size: the texts move once, by id.
    dropped = by_id.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").hint("merge")
    kept = plain.join(dropped, "doc_id", "left_anti").select(*names)
    several = by_id.filter("n > 1")
    if several.isEmpty():
        return kept.toDF(*docs.columns)
    repeated = several.filter("doc_id IS NOT NULL").select("doc_id").hint("merge")
    once = kept.filter("doc_id IS NOT NULL").join(repeated, "doc_id", "left_anti").select(*names)
    again = kept.join(repeated, "doc_id", "left_semi").select(*names)
    again = again.union(kept.filter("doc_id IS NULL"))
    again = materialize(again.withColumn("own_row", F.monotonically_increasing_id()), "dedup-again")
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    least = F.min(F.struct(text, "own_row"))["own_row"].alias("own_row")
    chosen = again.groupBy("doc_id", F.when(F.col("doc_id").isNull(), text)).agg(least)
    return once.union(again.join(chosen.select("own_row"), "own_row", "left_semi").select(*names)).toDF(
        *docs.columns
    )


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    plain, names = _inner(docs)
    marked = decontaminate.mark(plain, catalog.table(spark, sf_dir, "benchmark"))
    return marked.filter(F.size("leaks") == 0).select(*names).toDF(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; n_chars follows."""
    plain, names = _inner(docs)
    found = secrets.find(plain)
    out = found.withColumn("text", secrets.redact(F.col("text"), F.col("spans")))
    if "n_chars" in docs.columns:
        at = names[docs.columns.index("n_chars")]
        changed = F.length("text").cast(dict(plain.dtypes)[at])
        out = out.withColumn(at, F.when(F.size("spans") > 0, changed).otherwise(F.col(at)))
    return out.select(*names).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and text with token_ids, n_tokens and whether decoding gives the text back."""
    plain, _ = _inner(docs)
    ranks = byte_bpe.read_ranks(catalog.BYTE_RANKS)
    coded = byte_bpe.encode(
        plain.select("doc_id", "lang", "text"), ranks, public_tokenizers.PATTERN
    )
    back = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return byte_bpe.decode(coded, ranks).select(
        "doc_id",
        "lang",
        "text",
        "token_ids",
        F.size("token_ids").alias("n_tokens"),
        back.alias("round_trip"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", redact_secrets),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
