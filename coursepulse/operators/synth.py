"""Synthetic behaviour logs, generated where the rows are.

Every generator takes a frame with a ``row_id`` and dimension frames with a dense ``idx``
from 0; its size and parallelism are those of the rows it is given.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coursepulse import schema as S
from coursepulse.functions import draws as D, timestamps as ts
from coursepulse.functions.labels import zero_padded
from coursepulse.plans import ranks
from coursepulse.sources.readers import dim

TERM_START = "2025-09-01"
TERM_DAYS = 115
# Acceptance weights are multiples of 0.05 out of 4.0, hence whole units out of 80.
SLOT_UNITS = 80


def sequence_rows(spark: SparkSession, n: int) -> DataFrame:
    """``n`` numbered rows."""
    return spark.range(n).withColumnRenamed("id", "row_id")


def dense_index(df: DataFrame, order: list[Column]) -> DataFrame:
    """Adds a dense ``idx`` from 0 in the given total order."""
    return ranks.global_row_number(df, order, "idx", first=0)


def roster(spark: SparkSession, n: int) -> DataFrame:
    """``n`` students by rule."""
    return spark.range(n).select(
        F.col("id").alias("idx"),
        F.concat(F.lit("STU_2021"), zero_padded(F.col("id"), 4)).alias("student_id"),
        F.concat(F.lit("学生"), F.col("id").cast("string")).alias("student_name"),
    )


def course_catalogue(spark: SparkSession) -> DataFrame:
    """The eight courses with chapters and credits."""
    schema = "course_id string, course_name string, chapters int, credits double"
    return dim(spark, S.COURSES, schema)


def _size(dim: DataFrame) -> Column:
    return dim.agg(F.count(F.lit(1))).scalar()


def join_students(df: DataFrame, students: DataFrame) -> DataFrame:
    """Adds the student of each ``student_idx``; Spark broadcasts a roster it knows is small."""
    return df.join(students, df["student_idx"] == students["idx"], "left").drop(
        "idx", "student_idx"
    )


def join_courses(df: DataFrame, courses: DataFrame) -> DataFrame:
    """Adds the course of each ``course_idx``; ``dim`` marks the catalogue for broadcast."""
    return df.join(courses, df["course_idx"] == courses["idx"], "left").drop("idx", "course_idx")


def _u(salt: int) -> Column:
    return F.col(f"u{salt}")


def _record_uuid(seed: int, row: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), row.cast("string"), F.lit("id")))
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in parts])


def synth_b8(
    rows: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    seed: int = 0,
    start: str = TERM_START,
    days: int = TERM_DAYS,
) -> DataFrame:
    """Standard records: everything uniform."""
    row, u = F.col("row_id"), _u
    clock = [D.below(u(4 + i), n) for i, n in enumerate((24, 60, 60))]
    when = ts.at_offset(start, D.below(u(3), days), *clock)
    drawn = D.with_draws(rows, seed, row, 8).select(
        _record_uuid(seed, row).alias("record_id"),
        D.below(u(0), _size(students)).alias("student_idx"),
        D.below(u(1), _size(courses)).alias("course_idx"),
        D.pick(u(2), S.BEHAVIORS).alias("behavior_type"),
        u(7),
        ts.timestamp_text(when).alias("timestamp"),
    ).withColumn("duration", D.duration_for(F.col("behavior_type"), u(7)))
    joined = join_courses(join_students(drawn, students), courses)
    return joined.select(*S.B8_COLUMNS)


def synth_b11(
    rows: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    seed: int = 0,
    start: str = TERM_START,
    days: int = 7,
) -> DataFrame:
    """Detailed records; a daytime record is moved to a new uniform time in 30 of 100 cases."""
    u = _u
    first, again = D.below(u(2), days * 86400), D.below(u(3), days * 86400)
    hour = F.call_function("div", first % 86400, F.lit(3600))
    moved = hour.between(8, 22) & (D.below(u(4), 100) < 30)
    behavior = F.col("behavior_type")
    drawn = D.with_draws(rows, seed, F.col("row_id"), 13).select(
        *[u(i) for i in (7, 10, 11, 12)],
        D.below(u(0), _size(students)).alias("student_idx"),
        D.below(u(1), _size(courses)).alias("course_idx"),
        ts.timestamp_text(ts.at_second(start, F.when(moved, again).otherwise(first))).alias(
            "timestamp"
        ),
        D.pick(u(5), S.BEHAVIORS).alias("behavior_type"),
        D.pick(u(6), S.DEVICES).alias("device_type"),
        D.private_ip(u(8), u(9)).alias("ip_address"),
    )
    joined = join_courses(join_students(drawn, students), courses)
    chapter_no = D.below(u(10), F.col("chapters")) + 1
    return joined.withColumns(
        {
            "duration": D.inclusive_duration_for(behavior, u(7)),
            "chapter_id": F.concat(F.lit("CH_"), zero_padded(chapter_no, 3)),
            "score": D.score(behavior, u(11), u(12)),
        }
    ).select(*S.B11.fieldNames())


def slot_units(start: str, day: int, hour: int) -> int:
    """Acceptance of an hour of the term in units of 1/80, from the study-time weights."""
    weekday = (date.fromisoformat(start) + timedelta(days=day)).weekday()
    table = S.WEEKDAY_HOUR_WEIGHTS if weekday < 5 else S.WEEKEND_HOUR_WEIGHTS
    weight = next((w for (lo, hi), w in table if lo <= hour <= hi), 1.0)
    if day // 7 + 1 in S.EXAM_WEEKS:
        weight *= S.EXAM_WEEK_FACTOR
    return min(SLOT_UNITS, round(weight / 4.0 * SLOT_UNITS))


def weighted_ts(
    df: DataFrame, u_slot: Column, u_second: Column, start: str = TERM_START, days: int = TERM_DAYS
) -> DataFrame:
    """Adds ``event_ts`` in the term, hours weighted by weekday, hour and exam week.

    Rejection sampling accepts an hour in proportion to its units, so one draw over all
    units gives the same distribution without a loop: the draw falls into a class of hours
    of equal weight, then on one hour of the class, which an equi-join on (weight, position)
    looks up. The table has 24 rows per day of the term.
    """
    if days < 1:
        raise ValueError("a term has at least one day")
    classes: dict[int, list[int]] = {}
    for slot in range(days * 24):
        classes.setdefault(slot_units(start, *divmod(slot, 24)), []).append(slot)
    slots = df.sparkSession.createDataFrame(
        [(w, i, slot) for w, members in sorted(classes.items()) for i, slot in enumerate(members)],
        "_weight bigint, _member bigint, _slot bigint",
    )
    total = sum(w * len(members) for w, members in classes.items())
    unit = F.col("_unit")
    weight, base, upto = F, F, 0
    for w, members in sorted(classes.items()):
        lo, upto = upto, upto + w * len(members)
        weight = weight.when(unit < upto, F.lit(w).cast("bigint"))
        base = base.when(unit < upto, F.lit(lo).cast("bigint"))
    placed = (
        df.withColumns({"_unit": D.below(u_slot, total), "_second": D.below(u_second, 3600)})
        .withColumns({"_weight": weight, "_base": base})
        .withColumn("_member", F.call_function("div", unit - F.col("_base"), F.col("_weight")))
        .join(slots, ["_weight", "_member"], "left")
    )
    second = F.col("_slot") * 3600 + F.col("_second")
    return placed.withColumn("event_ts", ts.at_second(start, second)).drop(
        "_unit", "_second", "_weight", "_base", "_member", "_slot"
    )


def dataset_students(students: DataFrame, seed: int = 0) -> DataFrame:
    """Adds enrolment year, id and major of the dataset's students to (idx, student_name)."""
    idx = F.col("idx")
    return students.select(
        "idx",
        F.concat(
            F.lit("STU_202"),
            D.below(D.draw(seed, idx, 0), 3).cast("string"),
            zero_padded(idx, 4),
        ).alias("student_id"),
        "student_name",
        D.pick(D.draw(seed, idx, 1), S.MAJORS).alias("student_major"),
    )


def synth_b22(
    rows: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    seed: int = 0,
    start: str = TERM_START,
    days: int = TERM_DAYS,
) -> DataFrame:
    """Dataset records: weighted behaviours, devices and times, triangular durations,
    scores with a failing tail, chapters that follow the term."""
    row, u = F.col("row_id"), _u
    behavior, when = F.col("behavior_type"), F.col("event_ts")
    day = when.cast("date")
    drawn = D.with_draws(rows, seed, row, 17).select(
        "row_id",
        *[u(i) for i in range(9, 17)],
        D.below(u(0), _size(students)).alias("student_idx"),
        D.below(u(1), _size(courses)).alias("course_idx"),
        D.weighted(u(2), S.BEHAVIOR_WEIGHTS).alias("behavior_type"),
        D.weighted(u(3), S.DEVICE_WEIGHTS).alias("device_type"),
        D.campus_ip(u(4), u(5), u(6)).alias("ip_address"),
        D.pick(u(7), S.BROWSERS).alias("browser"),
        D.pick(u(8), S.OPERATING_SYSTEMS).alias("os"),
    )
    # Computed before the joins: one projection for everything would generate a method
    # beyond the size the JVM compiles, and run interpreted.
    timed = weighted_ts(drawn, u(9), u(10), start, days).withColumns(
        {
            "duration": D.triangular_duration_for(behavior, u(11)),
            "score": D.score(behavior, u(13), u(14), 12.0, (u(15), u(16))),
        }
    )
    joined = join_courses(join_students(timed, students), courses)
    week = ts.week_number(day, start)
    return joined.withColumns(
        {
            "record_id": F.concat(
                F.lit("REC_"), ts.compact_text(when), F.lit("_"), zero_padded(row, 4)
            ),
            "course_credits": F.col("credits"),
            "timestamp": ts.timestamp_text(when),
            "date": ts.date_text(day),
            "hour": F.hour(when),
            "weekday": F.weekday(day),
            "week_number": week,
            "chapter_id": D.chapter(F.col("chapters"), week, u(12)),
            "is_weekend": ts.is_weekend(day),
            "is_exam_week": week.isin(*S.EXAM_WEEKS).cast("int"),
        }
    ).select(*S.B22.fieldNames())
