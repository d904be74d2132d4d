"""Keyword search in stored log lines by a trigram index.

Lines are stored in blocks, a folder each: the day or hour of their time (lines without one: ``none``)
and a bucket of their hash, which splits a busy day. The index lists, for each sequence of three
characters, the blocks that hold it; it names blocks and not lines, so that it stays small beside
them. A search takes the blocks that hold every trigram of the keyword, reads only these, and tests the lines themselves, so
it finds what a scan finds. A keyword of fewer than three characters has no trigram: it is a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coursepulse.functions.timestamps import event_time
from coursepulse.operators.oplog import parse_oplog, search_oplog
from coursepulse.session import materialize

BUCKETS = 4
PARTS = 64
NO_TIME = "none"
# Characters of the time that name a block.
UNITS = {"day": 10, "hour": 13}
LINES = "line string, ts string, level string, module string, message string, block string"
POSTINGS = "gram string, block string, part int"


def trigrams(text: Column) -> Column:
    """The distinct sequences of three characters of a text.

    Undecodable bytes are replaced first: whole characters keep their neighbours, so no
    keyword that a line holds is lost. One pass over the characters, also for long lines.
    """

    def of_chars(chars: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(chars) - 2)
        grams = F.transform(starts, lambda i: F.array_join(F.slice(chars, i, F.lit(3)), ""))
        none = F.array().cast("array<string>")
        return F.array_distinct(F.when(F.size(chars) >= 3, grams).otherwise(none))

    # Bound by a lambda, so that the text is split once and not for each of its trigrams.
    return F.transform(F.array(F.split(F.make_valid_utf8(text), "")), of_chars)[0]


def write_index(lines: DataFrame, path: str, buckets: int = BUCKETS, by: str = "day") -> None:
    """Store parsed lines in blocks below ``path``, and the index beside them. Null lines are left out.

    ``by`` (``day`` or ``hour``) and ``buckets`` set the size of a block, the least that a search reads.
    """
    parsed = parse_oplog(lines.filter("value IS NOT NULL"))
    timed = event_time(F.col("ts")).isNotNull()
    unit = F.when(timed, F.translate(F.substring("ts", 1, UNITS[by]), " ", "-")).otherwise(NO_TIME)
    bucket = F.pmod(F.xxhash64("line"), F.lit(buckets)).cast("string")
    blocks = parsed.withColumn("block", F.concat_ws(".", unit, bucket)).hint("rebalance", "block")
    blocks.write.mode("overwrite").partitionBy("block").parquet(f"{path}/lines")
    grams = read_lines(lines.sparkSession, path).select("block", F.explode(trigrams(F.col("line"))).alias("gram"))
    part = F.pmod(F.xxhash64("gram"), F.lit(PARTS)).cast("int")
    (
        grams.distinct()
        .withColumn("part", part)
        .hint("rebalance", "part")
        .sortWithinPartitions("part", "gram")
        .write.mode("overwrite")
        .partitionBy("part")
        .parquet(f"{path}/postings")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINES).parquet(f"{path}/lines")


def candidates(spark: SparkSession, path: str, keyword: str) -> DataFrame:
    """The blocks that hold every trigram of a keyword of three characters or more."""
    grams = sorted({keyword[i : i + 3] for i in range(len(keyword) - 2)})
    wanted = F.array(*[F.lit(g) for g in grams])
    parts = F.transform(wanted, lambda g: F.pmod(F.xxhash64(g), F.lit(PARTS)).cast("int"))
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    listed = postings.filter(F.array_contains(parts, F.col("part")) & F.col("gram").isin(grams))
    return listed.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams)).select("block")


def search_index(
    spark: SparkSession,
    path: str,
    keyword: str,
    component: str = "all",
    level: str | None = None,
) -> DataFrame:
    """The rows that ``search_oplog`` finds in the stored lines, from the candidate blocks alone.

    The candidates are stored, so that their size is known: few, they prune the folders of the
    lines; many, they are joined.
    """
    lines = read_lines(spark, path)
    if len(keyword) >= 3:
        blocks = materialize(candidates(spark, path, keyword), "blocks").filter("block > ''")
        lines = lines.join(blocks, "block", "left_semi")
    return search_oplog(lines, component, level, keyword).drop("block")
