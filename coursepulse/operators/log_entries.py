"""Log entries of several lines: a line of the form begins an entry, others continue the one before.

Lines have a place: their file, the first byte of the split that holds them and their order in it.
A split is bounded by ``spark.sql.files.maxPartitionBytes`` (a compressed file is one split), so
the window over it is bounded however long a file is; what a split begins with belongs to the last
entry that an earlier split of the file has begun, which is found from one row for each split.
Lines before the first entry of a file are an entry without a head. A long entry stays rows: its
lines are counted and searched, and joined to one text nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from coursepulse.operators.oplog import LINE, parse_oplog

SPLIT = ["file", "block"]
ENTRY = ["file", "head_block", "head_at"]


def read_oplog(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files with their place, as (value, file, block, at)."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def group_lines(lines: DataFrame) -> DataFrame:
    """Adds the place of the line that begins each line's entry, null where none does."""
    begins = F.col("value").rlike(LINE)
    within = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(begins, F.col("at")), ignorenulls=True).over(within)
    last = lines.groupBy(*SPLIT).agg(F.max(F.when(begins, F.col("at"))).alias("at"))
    place = F.when(F.col("at").isNotNull(), F.struct("block", "at"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*SPLIT, F.last(place, ignorenulls=True).over(before).alias("_carried"))
    here = F.col("_own").isNotNull()
    return (
        lines.withColumn("_own", own)
        .join(carried, SPLIT)
        .select(
            *lines.columns,
            F.when(here, F.col("block")).otherwise(F.col("_carried.block")).alias("head_block"),
            F.coalesce("_own", "_carried.at").alias("head_at"),
        )
    )


def entries(grouped: DataFrame, keyword: str | None = None) -> DataFrame:
    """One row for each entry: its parsed first line, how many lines and characters it has.

    With ``keyword`` only entries that hold it in one of their lines. Lines are counted before
    they are shuffled, and the counts meet the heads by place.
    """
    counts = grouped.groupBy(*ENTRY).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.length("value").cast("bigint")).alias("n_chars"),
        F.max(_holds(keyword)).alias("_holds"),
    )
    own = (F.col("block") == F.col("head_block")) & (F.col("at") == F.col("head_at"))
    heads = grouped.filter(own).select(*ENTRY, "value")
    found = counts.filter("_holds").drop("_holds").join(heads, ENTRY, "left")
    return _parsed(found)


def continuations(grouped: DataFrame) -> DataFrame:
    """The lines that begin no entry, with the place of the entry they belong to."""
    begins = (F.col("block") == F.col("head_block")) & (F.col("at") == F.col("head_at"))
    return grouped.filter(~F.coalesce(begins, F.lit(False)))


def _holds(keyword: str | None) -> Column:
    return F.lit(True) if not keyword else F.contains("value", F.lit(keyword))


def _parsed(found: DataFrame) -> DataFrame:
    """Time, level, module and message of the heads; an entry without one has none."""
    rest = [*ENTRY, "n_lines", "n_chars"]
    packed = found.select(F.col("value"), F.struct(*rest).alias("_rest"))
    return parse_oplog(packed, keep=["_rest"]).select(
        *[F.col(f"_rest.{c}").alias(c) for c in rest], "ts", "level", "module", "message"
    )
