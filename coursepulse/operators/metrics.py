"""Aggregations. All accept a log or a rollup (see ``plans.rollup``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from coursepulse import schema as S
from coursepulse.functions import rounding
from coursepulse.functions.labels import label_behavior
from coursepulse.functions.timestamps import is_weekend, timestamp_text
from coursepulse.plans.rollup import ACTIVITY, ENROLMENT, GRAINS, HABIT, in_grain, measured, rows_of

GROUP, LATEST = "group", "latest"


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))


def _with_percent(counts: DataFrame, n: str = "count") -> DataFrame:
    """Share of the total. The total reuses the shuffle of the counts, no second scan."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn("percentage", rounding.percent(F.col(n), total))


def _latest(name: str) -> Column:
    """The name last seen; names seen at the same second are decided by text order."""
    return F.max_by(name, F.struct("last_ts", name))


def summary(b: DataFrame, roster_size: int = S.ROSTER_SIZE) -> DataFrame:
    """Distinct students and courses, rows, hours, hours per student, active rate.

    Counting distinct values over student x course pairs keeps the row expansion of two
    distinct counts off the log itself.
    """
    pairs = (
        rows_of(b, ENROLMENT)
        .groupBy("student_id", "course_id")
        .agg(F.sum("n").alias("n"), F.sum("seconds").alias("seconds"))
    )
    totals = pairs.agg(
        F.count_distinct("student_id").alias("total_students"),
        F.count_distinct("course_id").alias("total_courses"),
        _total("n").alias("total_behaviors"),
        _total("seconds").alias("seconds"),
    )
    students = F.col("total_students")
    roster = F.lit(roster_size).cast("bigint")
    tenths = rounding.tenths(F.col("seconds"))
    return totals.select(
        "total_students",
        "total_courses",
        "total_behaviors",
        rounding.hours(F.col("seconds"), 1).alias("total_study_hours"),
        rounding.mean_of_tenths(tenths, students).alias("avg_study_hours"),
        rounding.percent(F.least(students, roster), roster).alias("active_rate"),
    )


def _by_entity(b: DataFrame, key: str, name: str, other: str, policy: str) -> DataFrame:
    """Seconds and distinct ``other`` per entity, by (key, name) or by key and latest name."""
    m = rows_of(b, ENROLMENT)
    if policy == GROUP:
        return m.groupBy(key, name).agg(
            _total("seconds").alias("total_seconds"), F.count_distinct(other).alias("others")
        )
    if policy != LATEST:
        raise ValueError(f"unknown name policy: {policy}")
    small = m.groupBy(key, name, other).agg(
        F.sum("seconds").alias("seconds"), F.max("last_ts").alias("last_ts")
    )
    return small.groupBy(key).agg(
        _latest(name).alias(name),
        _total("seconds").alias("total_seconds"),
        F.count_distinct(other).alias("others"),
    )


def student_hours(b: DataFrame, name_policy: str = GROUP) -> DataFrame:
    """Hours and distinct courses per student."""
    return _by_entity(b, "student_id", "student_name", "course_id", name_policy).select(
        "student_id",
        "student_name",
        "total_seconds",
        rounding.hours(F.col("total_seconds")).alias("total_hours"),
        F.col("others").alias("courses"),
    )


def course_popularity(b: DataFrame, name_policy: str = GROUP) -> DataFrame:
    """Distinct students and hours per course, most students first."""
    per_course = _by_entity(b, "course_id", "course_name", "student_id", name_policy).select(
        "course_id",
        "course_name",
        F.col("others").alias("student_count"),
        rounding.hours(F.col("total_seconds")).alias("total_hours"),
    )
    return per_course.orderBy(F.desc("student_count"), "course_id", "course_name")


def behavior_distribution(b: DataFrame) -> DataFrame:
    """Rows, label and share per behaviour, most frequent first."""
    counts = (
        rows_of(b, ACTIVITY)
        .groupBy(F.col("behavior_type").alias("type"))
        .agg(F.sum("n").alias("count"))
    )
    return (
        _with_percent(counts)
        .select("type", label_behavior(F.col("type")).alias("name"), "count", "percentage")
        .orderBy(F.desc("count"), "type")
    )


def time_distribution(b: DataFrame, zero_fill: bool = False) -> DataFrame:
    """Rows per hour of day; rows without a readable timestamp have no hour."""
    counts = (
        rows_of(b, ACTIVITY)
        .filter(F.col("event_hour").isNotNull())
        .groupBy(F.col("event_hour").alias("hour"))
        .agg(F.sum("n").alias("count"))
    )
    return (zero_fill_hours(counts) if zero_fill else counts).orderBy("hour")


def zero_fill_hours(counts: DataFrame) -> DataFrame:
    """All 24 hours, 0 where ``counts`` has none.

    Grouping the hours of a day bounds the broadcast to 24 rows whatever the caller passes;
    counts per hour are partitioned that way already, so it costs no shuffle.
    """
    hours = counts.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    bounded = (
        counts.filter(F.col("hour").between(0, 23))
        .groupBy("hour")
        .agg(F.sum("count").alias("count"))
    )
    return hours.join(F.broadcast(bounded), "hour", "left").select(
        "hour", F.coalesce("count", F.lit(0).cast("bigint")).alias("count")
    )


def student_activity(b: DataFrame) -> DataFrame:
    """Hours and last readable timestamp per student."""
    return (
        rows_of(b, ENROLMENT)
        .groupBy("student_id", "student_name")
        .agg(_total("seconds").alias("seconds"), F.max("last_ts").alias("last_ts"))
        .select(
            "student_id",
            "student_name",
            rounding.hours(F.col("seconds")).alias("total_hours"),
            timestamp_text(F.col("last_ts")).alias("last_activity"),
        )
    )


def by_enrolment(b: DataFrame, by: tuple[str, ...]) -> GroupedData:
    """Groups by students, courses or both."""
    if not set(by) <= set(GRAINS[ENROLMENT]):
        raise ValueError(f"cannot group by {by}")
    return rows_of(b, ENROLMENT).groupBy(*by)


def last_activity(b: DataFrame, by: tuple[str, ...] = ("student_id",)) -> DataFrame:
    """Date of the last activity per student, per course, or per student and course."""
    return (
        by_enrolment(b, by)
        .agg(F.max("last_ts").cast("date").alias("last_activity"))
    )


def course_metrics(b: DataFrame) -> DataFrame:
    """Students, seconds, rows and seconds per student of each course."""
    per_course = (
        rows_of(b, ENROLMENT)
        .groupBy("course_id")
        .agg(
            F.count_distinct("student_id").alias("student_count"),
            _total("seconds").alias("total_duration"),
            F.sum("n").alias("behavior_count"),
        )
    )
    students = F.col("student_count")
    per_head = F.when(students > 0, F.col("total_duration") / students).otherwise(F.lit(0.0))
    return per_course.withColumn("avg_duration", per_head)


def _is_other() -> Column:
    """Whether a behaviour is null or none of the known ones."""
    return ~F.coalesce(F.col("behavior_type").isin(S.BEHAVIORS), F.lit(False))


def student_profile(b: DataFrame) -> DataFrame:
    """Seconds, number of courses and rows per behaviour of each student; null and unknown
    behaviours are counted as ``n_other``, so that the counts add up to the rows.

    The set of courses itself is ``student_courses``: a relation stays distributed, an
    array per student would not.
    """
    m = measured(b)
    enrolment, habit = in_grain(m, ENROLMENT), in_grain(m, HABIT)

    def rows(code: str) -> Column:
        counted = habit & (F.col("behavior_type") == code)
        return F.sum(F.when(counted, F.col("n")).otherwise(0)).alias(f"n_{code}")

    seconds = F.sum(F.when(enrolment, F.col("seconds")))
    return (
        m.filter(enrolment | habit)
        .groupBy("student_id")
        .agg(
            F.coalesce(seconds, F.lit(0).cast("bigint")).alias("total_duration"),
            F.count_distinct(F.when(enrolment, F.col("course_id"))).alias("course_count"),
            *[rows(code) for code in S.BEHAVIORS],
            F.sum(F.when(habit & _is_other(), F.col("n")).otherwise(0)).alias("n_other"),
        )
    )


def student_courses(b: DataFrame) -> DataFrame:
    """The set of courses of each student, one row per member."""
    return rows_of(b, ENROLMENT).select("student_id", "course_id").distinct()


def student_avg_score(b: DataFrame) -> DataFrame:
    """Mean score of students with at least one score."""
    scored = (
        rows_of(b, ENROLMENT)
        .groupBy("student_id")
        .agg(F.sum("score_tenths").alias("tenths"), F.sum("score_n").alias("n_scores"))
        .filter(F.col("n_scores") > 0)
    )
    mean = F.col("tenths") / (F.col("n_scores") * 10)
    return scored.select("student_id", "n_scores", mean.alias("avg_score"))


def student_behavior_duration(b: DataFrame, wide: bool = False) -> DataFrame:
    """Seconds per student and behaviour, as rows or with a column per known behaviour.

    The wide form has a column ``other`` for null and unknown behaviours.
    """
    m = rows_of(b, HABIT)
    if wide:
        parts = {code: F.col("behavior_type") == code for code in S.BEHAVIORS}
        parts["other"] = _is_other()
        return m.groupBy("student_id").agg(
            *[
                F.coalesce(F.sum(F.when(part, F.col("seconds"))), F.lit(0).cast("bigint")).alias(name)
                for name, part in parts.items()
            ]
        )
    return m.groupBy("student_id", "behavior_type").agg(_total("seconds").alias("duration"))


def student_behavior_counts(b: DataFrame) -> DataFrame:
    """Rows per student and behaviour."""
    return rows_of(b, HABIT).groupBy("student_id", "behavior_type").agg(F.sum("n").alias("count"))


def student_total(b: DataFrame, student_id: str) -> DataFrame:
    """Seconds of one student."""
    one = rows_of(b, ENROLMENT).filter(F.col("student_id") == student_id)
    return one.agg(_total("seconds").alias("total_duration"))


def distinct_count(b: DataFrame, column: str) -> DataFrame:
    """Number of distinct values; null counts as one."""
    return b.select(column).distinct().agg(F.count(F.lit(1)).alias("distinct_values"))


def device_distribution(b: DataFrame) -> DataFrame:
    """Rows and share per device."""
    counts = rows_of(b, ACTIVITY).groupBy("device_type").agg(F.sum("n").alias("count"))
    return _with_percent(counts).orderBy("device_type")


def weekend_split(b: DataFrame) -> DataFrame:
    """Rows and share of weekdays (0) and weekends (1)."""
    counts = (
        rows_of(b, ACTIVITY)
        .filter(F.col("event_date").isNotNull())
        .groupBy(is_weekend(F.col("event_date")).alias("is_weekend"))
        .agg(F.sum("n").alias("count"))
    )
    return _with_percent(counts).orderBy("is_weekend")


def reconcile_duration(b: DataFrame) -> DataFrame:
    """Total seconds, overall, summed by student and summed by course; they must agree.

    The grouping sets run over student x course pairs; ``grouping_id`` keeps null ids apart
    from subtotals.
    """
    pairs = (
        rows_of(b, ENROLMENT)
        .groupBy("student_id", "course_id")
        .agg(F.sum("seconds").alias("seconds"))
    )
    student, course = F.col("student_id"), F.col("course_id")
    levels = pairs.groupingSets([[student], [course], []], student, course).agg(
        F.grouping_id().alias("level"), F.sum("seconds").alias("seconds")
    )

    def at(level: int) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("level") == level, F.col("seconds"))), F.lit(0).cast("bigint")
        )

    sums = levels.agg(
        at(3).alias("total_duration"),
        at(1).alias("student_total"),
        at(2).alias("course_total"),
    )
    total = F.col("total_duration")
    agree = (total == F.col("student_total")) & (total == F.col("course_total"))
    return sums.withColumn("consistent", agree)


def partition_counts(b: DataFrame) -> DataFrame:
    """Rows per date; unreadable dates share the null row, so the counts add up."""
    return rows_of(b, ACTIVITY).groupBy("event_date").agg(F.sum("n").alias("count"))


def latest_names(b: DataFrame, key: str = "student_id", name: str = "student_name") -> DataFrame:
    """The last name of each id: two steps, so only (id, name) groups meet text buffers."""
    seen = rows_of(b, ENROLMENT).groupBy(key, name).agg(F.max("last_ts").alias("last_ts"))
    return seen.groupBy(key).agg(_latest(name).alias(name))


def row_count(b: DataFrame) -> DataFrame:
    """Number of log rows."""
    return rows_of(b, ACTIVITY).agg(_total("n").alias("total_records"))
