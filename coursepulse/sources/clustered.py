"""A log stored along a space-filling order over time and student.

Sorted by time, a filter on a student meets every row group, and the other way round. Here rows follow
the Z-order of two bucket numbers, one of their time and one of their student, so that a
row group covers a short range of both, and Parquet's least and greatest values let readers pass over
the groups that a filter on either cannot meet. The bounds of the buckets decide where rows lie and
nothing else: results are the same whatever they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coursepulse import schema as S
from coursepulse.functions.timestamps import event_time
from coursepulse.plans.ranks import global_row_number

BITS = 6
CELL = "cell"


def time_bounds(b: DataFrame, bits: int = BITS) -> list[int]:
    """Up to ``2 ** bits - 1`` seconds that part the rows evenly, from a sketch of fixed size."""
    n = 1 << bits
    seconds = F.unix_timestamp(event_time(F.col("timestamp")).cast("timestamp"))
    cuts = F.percentile_approx(seconds, [i / n for i in range(1, n)], F.lit(10_000))
    return sorted(set(b.agg(cuts.alias("cuts")).first().cuts or []))


def student_bounds(b: DataFrame, bits: int = BITS) -> list[str]:
    """Up to ``2 ** bits - 1`` students that part the distinct students evenly.

    Students are grouped before they are ordered, so one that holds a third of the rows is one.
    """
    n = 1 << bits
    ranked = global_row_number(b.filter("student_id IS NOT NULL").select("student_id").distinct(), [F.col("student_id")], "rank")
    number = F.floor(F.col("rank") * n / ranked.agg(F.max("rank")).scalar())
    first = ranked.groupBy(number.alias("bucket")).agg(F.min("student_id").alias("student_id"))
    return sorted(r.student_id for r in first.filter("bucket BETWEEN 1 AND " + str(n - 1)).collect())


def bucket_of(value: Column, bounds: Sequence) -> Column:
    """How many of the bounds a value reaches, by halving them; null values reach none."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    upper = bucket_of(value, bounds[middle + 1 :]) + (middle + 1)
    return F.when(value >= F.lit(bounds[middle]), upper).otherwise(bucket_of(value, bounds[:middle]))


def interleave(x: Column, y: Column, bits: int = BITS) -> Column:
    """The place of (x, y) in Z-order: their bits in turn."""
    one = F.lit(1)
    parts = []
    for i in range(bits):
        parts.append(F.shiftleft(F.shiftright(x, i).bitwiseAND(one), 2 * i + 1))
        parts.append(F.shiftleft(F.shiftright(y, i).bitwiseAND(one), 2 * i))
    return reduce(lambda a, c: a.bitwiseOR(c), parts)


def write_clustered(
    b: DataFrame, path: str, bits: int = BITS, tasks: int | None = None, group_bytes: int | None = None
) -> None:
    """Store a log as Parquet in Z-order of time and student.

    Rows of one cell are ordered further by student, time and record, so that a cell with a third
    of the rows is split over tasks. ``tasks`` fixes the number of files, ``group_bytes`` the size
    of row groups; by default the session's settings do.
    """
    seconds = F.unix_timestamp(event_time(F.col("timestamp")).cast("timestamp"))
    cell = interleave(
        bucket_of(seconds, time_bounds(b, bits)),
        bucket_of(F.col("student_id"), student_bounds(b, bits)),
        bits,
    )
    order = [F.col(c) for c in (CELL, "student_id", "timestamp", "record_id")]
    placed = b.withColumn(CELL, cell)
    dealt = placed.repartitionByRange(*order) if tasks is None else placed.repartitionByRange(tasks, *order)
    writer = dealt.sortWithinPartitions(*order).drop(CELL).write.mode("overwrite")
    if group_bytes is not None:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)


def read_clustered(
    spark: SparkSession, path: str, student: str | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The stored log, or the part of a student and of times from ``start`` up to, not with, ``end``.

    Times of the fixed-width form order like their text, so the filters reach the row groups.
    """
    log = spark.read.schema(S.LOG).parquet(path)
    if student is not None:
        log = log.filter(F.col("student_id") == student)
    if start is not None:
        log = log.filter(F.col("timestamp") >= start)
    if end is not None:
        log = log.filter(F.col("timestamp") < end)
    return log
