"""Exact distinct counts of a growing log from mergeable bitmaps.

Students get dense numbers as they are first seen. A batch stores, for each course and for all, the set
of its students as bitmaps over these numbers; a refresh joins them by OR. Its cost is a bit for
each student and course, whatever the pairs or the rows, where the exact fact keeps a row for
each pair and batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from coursepulse import schema as S
from coursepulse.functions import rounding
from coursepulse.plans.ranks import global_row_number
from coursepulse.session import materialize

NUMBERS = "student_id string, number bigint, batch_id bigint"
FACT = (
    "kind string, course_id string, course_name string, bucket bigint, students binary, "
    "n bigint, seconds bigint, batch_id bigint"
)
COURSE, ALL, SUMS = "course", "all", "sums"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _write(df: DataFrame, batch_id: int, path: str) -> None:
    """Store a batch's rows, replacing an earlier attempt."""
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def number_students(batch: DataFrame, batch_id: int, numbers: str) -> DataFrame:
    """(student_id, number) of the students of a batch; those not seen before get the next numbers.

    Numbers begin at 1. Students of later batches are passed over, so a repeated batch numbers
    alike; batches come one after the other.
    """
    spark = batch.sparkSession
    known = _stored(spark, numbers, NUMBERS).filter(F.col("batch_id") < batch_id)
    own = batch.filter("student_id IS NOT NULL").select("student_id").distinct()
    last = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    new = own.join(known, "student_id", "left_anti")
    ranked = global_row_number(new, [F.col("student_id")], "number", first=last + 1)
    _write(ranked.select("student_id", "number"), batch_id, numbers)
    every = _stored(spark, numbers, NUMBERS).filter(F.col("batch_id") <= batch_id)
    return every.join(own, "student_id", "left_semi").select("student_id", "number")


def add_batch(batch: DataFrame, batch_id: int, path: str, numbers: str) -> None:
    """Store the sums of a batch by course, and its students by course and in all, as bitmaps."""
    numbered = number_students(batch, batch_id, numbers)
    pairs = materialize(
        batch.groupBy("student_id", "course_id", "course_name").agg(
            F.count(F.lit(1)).alias("n"), F.sum("duration").alias("seconds")
        ),
        "batch-pairs",
    )
    sums = pairs.groupBy("course_id", "course_name").agg(F.sum("n").alias("n"), F.sum("seconds").alias("seconds"))
    placed = pairs.join(numbered, "student_id").select(
        "course_id",
        "course_name",
        F.bitmap_bucket_number("number").alias("bucket"),
        F.bitmap_bit_position("number").alias("bit"),
    )
    course, name, bucket = F.col("course_id"), F.col("course_name"), F.col("bucket")
    sets = placed.groupingSets([[course, name, bucket], [bucket]], course, name, bucket).agg(
        F.when(F.grouping("course_id") == 0, COURSE).otherwise(ALL).alias("kind"),
        F.bitmap_construct_agg("bit").alias("students"),
    )
    fact = sums.withColumn("kind", F.lit(SUMS)).unionByName(sets, allowMissingColumns=True)
    _write(fact.select("kind", "course_id", "course_name", "bucket", "students", "n", "seconds"), batch_id, path)


def merged(spark: SparkSession, path: str) -> DataFrame:
    """All batches as one: sums added, sets joined."""
    return (
        _stored(spark, path, FACT)
        .groupBy("kind", "course_id", "course_name", "bucket")
        .agg(
            F.bitmap_or_agg("students").alias("students"),
            F.sum("n").alias("n"),
            F.sum("seconds").alias("seconds"),
        )
    )


def course_popularity(fact: DataFrame) -> DataFrame:
    """``metrics.course_popularity`` of all batches."""
    count = F.sum(F.when(F.col("kind") == COURSE, F.bitmap_count("students")))
    per_course = fact.filter(F.col("kind") != ALL).groupBy("course_id", "course_name")
    return (
        per_course.agg(
            F.coalesce(count, F.lit(0)).cast("bigint").alias("student_count"),
            rounding.hours(F.coalesce(F.sum("seconds"), F.lit(0)).cast("bigint")).alias("total_hours"),
        )
        .orderBy(F.desc("student_count"), "course_id", "course_name")
    )


def summary(fact: DataFrame, roster_size: int = S.ROSTER_SIZE) -> DataFrame:
    """``metrics.summary`` of all batches."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    totals = fact.agg(
        zero(F.sum(F.when(F.col("kind") == ALL, F.bitmap_count("students")))).alias("total_students"),
        F.count_distinct(F.when(F.col("kind") == SUMS, F.col("course_id"))).alias("total_courses"),
        zero(F.sum("n")).alias("total_behaviors"),
        zero(F.sum("seconds")).alias("seconds"),
    )
    students, roster = F.col("total_students"), F.lit(roster_size).cast("bigint")
    return totals.select(
        "total_students",
        "total_courses",
        "total_behaviors",
        rounding.hours(F.col("seconds"), 1).alias("total_study_hours"),
        rounding.mean_of_tenths(rounding.tenths(F.col("seconds")), students).alias("avg_study_hours"),
        rounding.percent(F.least(students, roster), roster).alias("active_rate"),
    )
