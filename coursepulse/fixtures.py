"""The behaviour log derived from the given tables (``events``, ``customer``, ``part``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from coursepulse import schema as S
from coursepulse.functions import timestamps as ts
from coursepulse.functions.labels import zero_padded

COURSE_COUNT = 8
# Which event type stands for which behaviour and log level.
EVENT_BEHAVIOR = {
    "view": "video_watch",
    "purchase": "homework_submit",
    "signup": "quiz_complete",
    "click": "forum_post",
}
EVENT_LEVEL = {"error": "ERROR", "signup": "WARN", "click": "DEBUG"}
# Texts that are no timestamps, some of them close to one.
BROKEN_TIMES = [
    "garbage",
    "2024-01-10 8:00:00Z",
    "2024-01-10 08:00:0Z",
    "2024-01-10         ",
]
LOG_MODULES = ["Web", "HDFS", "YARN", "Spark", "Flume"]


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per session, not per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, as (user_id, student_id, student_name)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        student_id(F.col("c_custkey")).alias("student_id"),
        F.col("c_name").alias("student_name"),
    )


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight courses as (course_no, course_id, course_name).

    The grouping proves that at most eight rows are left, so the frame is marked for
    broadcast.
    """
    part = table(spark, sf_dir, "part")
    eight = (
        part.filter(F.col("p_partkey").between(0, COURSE_COUNT - 1))
        .groupBy(F.col("p_partkey").alias("course_no"))
        .agg(F.min("p_name").alias("course_name"))
        .select("course_no", course_id(F.col("course_no")).alias("course_id"), "course_name")
    )
    return F.broadcast(eight)


def student_id(user: Column) -> Column:
    return F.concat(F.lit("STU_"), zero_padded(user, 8))


def course_id(number: Column) -> Column:
    return F.concat(F.lit("COURSE_"), zero_padded(number + 1, 3))


def _lookup(code: Column, table: dict[str, str], default: str) -> Column:
    case = F
    for key, value in table.items():
        case = case.when(code == key, F.lit(value))
    return case.otherwise(F.lit(default))


def behavior(spark: SparkSession, sf_dir: str, names: bool = True) -> DataFrame:
    """The clean log. Queries that read no names ask for none, which saves both joins."""
    source = events(spark, sf_dir)
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    df = source.withColumns(
        {"k": k, "cents": F.floor(F.col("value") * 100 + 0.5).cast("bigint")}
    ).withColumns({"course_no": (F.col("k") % COURSE_COUNT).cast("bigint")})
    kind = _lookup(F.col("event_type"), EVENT_BEHAVIOR, "material_download")
    df = df.withColumn("behavior_type", kind)
    if names:
        df = df.join(students(spark, sf_dir).drop("student_id"), "user_id", "left").join(
            courses(spark, sf_dir).drop("course_id"), "course_no", "left"
        )
    event_id, user = F.col("event_id"), F.col("user_id")
    columns = {
        "record_id": zero_padded(event_id, 12),
        "student_id": student_id(user),
        "student_name": F.col("student_name") if names else None,
        "course_id": course_id(F.col("course_no")),
        "course_name": F.col("course_name") if names else None,
        "behavior_type": F.col("behavior_type"),
        "duration": F.call_function("div", F.col("cents") * 36, F.lit(1000)),
        "timestamp": ts.timestamp_text(F.col("ts")),
        "ip_address": F.concat(
            F.lit("192.168."),
            (user % 254 + 1).cast("string"),
            F.lit("."),
            (event_id % 254 + 1).cast("string"),
        ),
        "device_type": F.element_at(
            F.array(*[F.lit(d) for d in S.DEVICES]), (event_id % 3 + 1).cast("int")
        ),
        "chapter_id": F.concat(F.lit("CH_"), zero_padded(F.col("k") % 12 + 1, 3)),
        "score": F.when(
            F.col("behavior_type").isin(S.SCORED_BEHAVIORS),
            (F.col("cents") % 1001).cast("double") / F.lit(10.0),
        ),
    }
    return df.select(*[c.alias(name) for name, c in columns.items() if c is not None])


def behavior_raw(spark: SparkSession, sf_dir: str, names: bool = True) -> DataFrame:
    """The log as it lands: every row of ``behavior``, some damaged, some delivered twice."""
    log = behavior(spark, sf_dir, names)
    no = F.col("record_id").cast("bigint")

    def damage(column: str, every: int, broken: Column) -> Column:
        return F.when(no % every == 0, broken).otherwise(F.col(column))

    damaged = log.withColumns(
        {
            "student_id": damage("student_id", 101, F.lit(None).cast("string")),
            "behavior_type": damage("behavior_type", 103, F.lit(None).cast("string")),
            "course_id": damage("course_id", 107, F.lit("")),
            "ip_address": damage("ip_address", 109, F.concat("ip_address", F.lit(".1"))),
            "timestamp": damage(
                "timestamp",
                113,
                F.element_at(
                    F.array(*(F.lit(x) for x in BROKEN_TIMES)),
                    (F.call_function("div", no, F.lit(113)) % len(BROKEN_TIMES) + 1).cast("int"),
                ),
            ),
        }
    )
    copies = F.when(no % 50 == 0, F.array(F.lit(""), F.lit("dup"))).otherwise(F.array(F.lit("")))
    return (
        damaged.withColumn("_copy", F.explode(copies))
        .withColumn("record_id", F.concat("_copy", "record_id"))
        .drop("_copy")
    )


def oplog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One operational log line per event."""
    event_id = F.col("event_id")
    module = F.element_at(F.array(*[F.lit(m) for m in LOG_MODULES]), (event_id % 5 + 1).cast("int"))
    line = F.concat(
        F.lit("["),
        ts.timestamp_text(F.col("ts")),
        F.lit("] ["),
        _lookup(F.col("event_type"), EVENT_LEVEL, "INFO"),
        F.lit("] ["),
        module,
        F.lit("] event "),
        event_id.cast("string"),
    )
    return events(spark, sf_dir).select(line.alias("value"))
