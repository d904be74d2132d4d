"""Alerts on low engagement, absence, short study time and low scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from coursepulse import schema as S
from coursepulse.functions import rounding
from coursepulse.functions.labels import inactive_level
from coursepulse.operators import metrics
from coursepulse.plans import ranks


@dataclass(frozen=True)
class EngagementRule:
    """How low engagement is decided and reported."""

    lt: float
    high_lt: float
    k: int
    filter_first: bool
    compare_rounded: bool
    digits: int
    name_policy: str
    message: str


BATCH_RULE = EngagementRule(
    lt=5.0,
    high_lt=2.0,
    k=20,
    filter_first=True,
    compare_rounded=True,
    digits=2,
    name_policy=metrics.GROUP,
    message=S.BATCH_ALERT_MESSAGE,
)
REALTIME_RULE = EngagementRule(
    lt=100.0,
    high_lt=50.0,
    k=5,
    filter_first=False,
    compare_rounded=False,
    digits=1,
    name_policy=metrics.LATEST,
    message=S.REALTIME_ALERT_MESSAGE,
)


def alert_columns(df: DataFrame, as_of: str, high: Column, message: str) -> DataFrame:
    """Alert fields of rows with ``total_hours``; the time of the alert is the caller's."""
    return df.withColumns(
        {
            "alert_type": F.lit("low_engagement"),
            "level": F.when(high, F.lit("high")).otherwise(F.lit("medium")),
            "alert_message": F.format_string(message, F.col("total_hours").cast("string")),
            "alert_time": F.lit(as_of),
        }
    )


def low_engagement(b: DataFrame, as_of: str, rule: EngagementRule = BATCH_RULE) -> DataFrame:
    """Students who study too little, fewest hours first."""
    stats = metrics.student_hours(b, rule.name_policy).withColumn(
        "total_hours", rounding.hours(F.col("total_seconds"), rule.digits)
    )
    exact = F.col("total_seconds") / F.lit(3600.0)
    compared = F.col("total_hours") if rule.compare_rounded else exact
    shown = F.col("total_hours") if rule.compare_rounded else F.col("total_seconds")
    order = [shown.asc(), F.asc("student_id"), F.asc("student_name")]
    if rule.filter_first:
        low = ranks.top_k(stats.filter(compared < rule.lt), order, rule.k)
    else:
        low = ranks.top_k(stats, order, rule.k).filter(compared < rule.lt)
    return alert_columns(low, as_of, compared < rule.high_lt, rule.message).select(
        "student_id",
        "student_name",
        "alert_type",
        "level",
        "alert_message",
        "alert_time",
        "total_hours",
    )


def inactive_students(
    b: DataFrame,
    as_of: str,
    threshold: int = S.INACTIVE_DAYS,
    by: tuple[str, ...] = ("student_id",),
) -> DataFrame:
    """Students (or students per course) without activity for ``threshold`` days."""
    days = F.datediff(F.lit(as_of).cast("date"), F.col("last_activity"))
    return (
        metrics.last_activity(b, by)
        .withColumn("inactive_days", days)
        .filter(F.col("inactive_days") >= threshold)
    )


def with_inactive_level(inactive: DataFrame) -> DataFrame:
    """Adds the severity of the absence."""
    return inactive.withColumn("level", inactive_level(F.col("inactive_days")))


def threshold_diff(
    b: DataFrame, as_of: str, lo: int, hi: int, by: tuple[str, ...] = ("student_id",)
) -> DataFrame:
    """Who is inactive at ``lo`` days, and whether still so at ``hi``, in one pass.

    Raising the threshold can only drop students, never add any.
    """
    if hi < lo:
        raise ValueError("hi must not be below lo")
    flagged = inactive_students(b, as_of, lo, by)
    return flagged.withColumn("also_at_hi", F.col("inactive_days") >= hi)


def low_duration(
    b: DataFrame, lt: int = S.LOW_DURATION_SECONDS, by: tuple[str, ...] = ("student_id",)
) -> DataFrame:
    """Students (or students per course) strictly below ``lt`` seconds in total."""
    totals = metrics.by_enrolment(b, by).agg(
        F.coalesce(F.sum("seconds"), F.lit(0).cast("bigint")).alias("total_duration")
    )
    return totals.filter(F.col("total_duration") < lt)


def low_score(b: DataFrame, lt: float = S.LOW_SCORE) -> DataFrame:
    """Students whose mean score is below ``lt``."""
    return metrics.student_avg_score(b).filter(F.col("avg_score") < lt)
