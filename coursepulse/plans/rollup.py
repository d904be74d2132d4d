"""Measures of the log and their pre-aggregation.

Every metric works on a *measured* frame: dimensions plus ``n``, ``seconds``, ``last_ts``,
``score_tenths`` and ``score_n``. A raw log is measured row by row, a rollup is measured
already, and since all measures are sums or maxima both give the same results.

A rollup holds three coarse grains instead of one fine one: student x course, student x
behaviour and behaviour x device x hour. Each shrinks a large log by orders of magnitude;
their product hardly would. All come from one scan through grouping sets, and all buffers
are fixed-width, so the map-side hash aggregation needs no sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from coursepulse import session
from coursepulse.functions.timestamps import event_time

ENROLMENT, HABIT, ACTIVITY = "enrolment", "habit", "activity"
GRAINS = {
    ENROLMENT: ["student_id", "student_name", "course_id", "course_name"],
    HABIT: ["student_id", "behavior_type"],
    ACTIVITY: ["behavior_type", "device_type", "event_date", "event_hour"],
}

MEASURES = ["n", "seconds", "last_ts", "score_tenths", "score_n"]
ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("student_id", T.StringType()),
        T.StructField("student_name", T.StringType()),
        T.StructField("course_id", T.StringType()),
        T.StructField("course_name", T.StringType()),
        T.StructField("behavior_type", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_hour", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("seconds", T.LongType()),
        T.StructField("last_ts", T.TimestampNTZType()),
        T.StructField("score_tenths", T.LongType()),
        T.StructField("score_n", T.LongType()),
        T.StructField("grain", T.StringType()),
    ]
)
DIMS = [f.name for f in ROLLUP_SCHEMA if f.name not in ("grain", *MEASURES)]


def measured(b: DataFrame) -> DataFrame:
    """Dimensions and measures of a log; a rollup passes through."""
    if "n" in b.columns:
        return b
    time = F.col("last_ts")
    score = F.col("score") if "score" in b.columns else F.lit(None).cast("double")
    dims = [
        F.col(d) if d in b.columns else F.lit(None).cast("string").alias(d)
        for d in DIMS
        if d not in ("event_date", "event_hour")
    ]
    return b.withColumn("last_ts", event_time(F.col("timestamp"))).select(
        *dims,
        time.cast("date").alias("event_date"),
        F.hour(time).alias("event_hour"),
        F.lit(1).cast("bigint").alias("n"),
        F.col("duration").cast("bigint").alias("seconds"),
        time,
        F.round(score * 10).cast("bigint").alias("score_tenths"),
        score.isNotNull().cast("bigint").alias("score_n"),
    )


def _sums() -> list:
    return [
        F.sum("n").alias("n"),
        F.sum("seconds").alias("seconds"),
        F.max("last_ts").alias("last_ts"),
        F.sum("score_tenths").alias("score_tenths"),
        F.sum("score_n").alias("score_n"),
    ]


def rollup(b: DataFrame) -> DataFrame:
    """All grains of a log in one scan, told apart by ``grain``."""
    sets = [[F.col(d) for d in dims] for dims in GRAINS.values()]
    grain = (
        F.when(F.grouping("course_id") == 0, F.lit(ENROLMENT))
        .when(F.grouping("student_id") == 0, F.lit(HABIT))
        .otherwise(F.lit(ACTIVITY))
    )
    keys = [F.col(d) for d in DIMS]
    grouped = measured(b).groupingSets(sets, *keys).agg(*_sums(), grain.alias("grain"))
    return grouped.select(*ROLLUP_SCHEMA.fieldNames())


def merge(fact: DataFrame) -> DataFrame:
    """One row per group out of several rollups."""
    return fact.groupBy("grain", *DIMS).agg(*_sums()).select(*ROLLUP_SCHEMA.fieldNames())


def in_grain(m: DataFrame, grain: str) -> Column:
    """Whether a measured row belongs to a grain; a log row belongs to all."""
    return F.col("grain") == grain if "grain" in m.columns else F.lit(True)


def rows_of(b: DataFrame, grain: str) -> DataFrame:
    """Measured rows of one grain; of a stored rollup only its folder is read."""
    m = measured(b)
    return m.filter(in_grain(m, grain))


def write_rollup(b: DataFrame, path: str) -> DataFrame:
    """Roll a log up into ``path``, one folder per grain, and read it back."""
    rollup(b).write.mode("overwrite").partitionBy("grain").parquet(path)
    return read_rollup(b.sparkSession, path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROLLUP_SCHEMA).parquet(path)


def stored_rollup(b: DataFrame) -> DataFrame:
    """The rollup of a log in the scratch folder, for several results out of one scan."""
    return write_rollup(b, session.scratch_path(b.sparkSession, "rollup"))
