"""Joining the small files of landed batches to files of a bounded size.

A stream that lands every few seconds makes many small files a day. ``roll`` rewrites what has
landed since the last roll into bins: files of at most half the bound are put into bins by their
place in the running total of their day, larger ones have a bin of their own, or several. Sizes come
from the listing, no file is opened for them.

A roll is written beside the landed batches and counts only once the caller has its result, the last
batch that is in it: ``read_rolled`` takes rolls up to there and the batches since. So readers
see each row once, before, while and after files are joined; ``drop_rolled`` removes the batches
that no reader needs any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from coursepulse.sources.readers import BATCH, PARTITIONS, _any, dated_lines, parse_records
from coursepulse.sources.writers import batch_name

BOUND = 128 << 20  # bytes of a file


def _batch_id(name: str = BATCH):
    """The number in a batch's folder name."""
    return F.try_to_number(F.substring(F.col(name), len(batch_name(0)) - 11, 12), F.lit("999999999999")).cast("bigint")


def landed_files(spark: SparkSession, path: str, after: int | None) -> DataFrame:
    """(file, size, year, month, day, batch_id) of the batches after ``after``, from the listing."""
    found = spark.read.format("binaryFile").option("basePath", path).load(f"{path}/year=*/month=*/day=*/{BATCH}=*")
    files = found.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        *PARTITIONS,
        _batch_id().alias("batch_id"),
    )
    return files if after is None else files.filter(F.col("batch_id") > after)


def bins(files: DataFrame, bound: int = BOUND) -> DataFrame:
    """(file, bin, parts): which bin of its day a file goes to; one above the bound has several.

    Small files that begin in the same half bound of their day's running total share a bin: the
    last of them ends less than half a bound later.
    """
    half = max(1, bound // 2)
    small = F.col("size") <= half
    before = Window.partitionBy(*PARTITIONS, small).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0))
    own = F.concat(F.lit("f"), F.sha1("file"))
    shared = F.concat(F.lit("s"), F.floor(start / half).cast("string"))
    return files.select(
        "file",
        F.when(small, shared).otherwise(own).alias("bin"),
        F.when(F.col("size") > bound, F.ceil(F.col("size") / half)).otherwise(1).cast("int").alias("parts"),
    )


def roll(
    spark: SparkSession, path: str, rolled: str, previous: int | None = None, bound: int = BOUND
) -> int | None:
    """Join the batches landed since ``previous`` into ``rolled``; returns the last batch in it.

    What an interrupted roll has left is removed first.
    """
    _remove(spark, rolled, "roll", previous, newer=True)
    if not _any(spark, f"{path}/year=*/month=*/day=*/{BATCH}=*"):
        return previous
    files = landed_files(spark, path, previous)
    upto = files.agg(F.max("batch_id")).first()[0]
    if upto is None:
        return previous
    placed = bins(files.filter(F.col("batch_id") <= upto), bound)
    lines = spark.read.option("basePath", path).text(f"{path}/year=*/month=*/day=*/{BATCH}=*")
    if previous is not None:
        lines = lines.filter(_batch_id() > previous)
    text = lambda name, width: F.lpad(F.col(name).cast("string"), width, "0").alias(name)
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("value", "at"), F.col("parts"))).otherwise(0)
    (
        lines.select("value", *PARTITIONS, F.col("_metadata.file_path").alias("file"))
        .withColumn("at", F.monotonically_increasing_id())
        .join(placed, "file")
        .select(
            "value",
            F.lit(upto).cast("bigint").alias("roll"),
            text("year", 4), text("month", 2), text("day", 2),
            F.concat_ws("-", "bin", part.cast("string")).alias("bin"),
        )
        .repartition("year", "month", "day", "bin")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("roll", *PARTITIONS, "bin")
        .text(rolled)
    )
    return upto


def _remove(spark: SparkSession, path: str, name: str, upto: int | None, newer: bool, above: str = "") -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for entry in fs.globStatus(hadoop.Path(folder, f"{above}{name}=*")) or []:
        number = int(entry.getPath().getName().rpartition("=")[2].removeprefix("batch-"))
        if (upto is None or number > upto) if newer else (upto is not None and number <= upto):
            fs.delete(entry.getPath(), True)


def drop_rolled(spark: SparkSession, path: str, upto: int | None) -> None:
    """Remove the batches that a roll has taken in, once the caller has stored its result."""
    _remove(spark, path, BATCH, upto, newer=False, above="year=*/month=*/day=*/")


def read_rolled(spark: SparkSession, path: str, rolled: str, upto: int | None) -> DataFrame:
    """Records of the rolls up to ``upto`` and of what has landed since, each once."""
    days = [F.col(p).cast("int").alias(p) for p in PARTITIONS]
    lines = dated_lines(spark, path)
    if upto is not None:
        since = F.col(BATCH).isNull() | (_batch_id() > upto)
        old = spark.read.text(rolled).filter(F.col("roll") <= upto).select("value", *days)
        lines = lines.filter(since).select("value", *PARTITIONS).unionAll(old)
    return parse_records(lines.select("value", *PARTITIONS))
