"""Rankings of students and courses; every order ends in the id, so ties are settled."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coursepulse.operators import metrics
from coursepulse.plans import ranks

BATCH, REALTIME = "batch", "realtime"


def student_ranking(b: DataFrame, n: int = 10, preset: str = BATCH) -> DataFrame:
    """The ``n`` students with most hours.

    ``batch`` groups by id and name and compares hours rounded to two decimals;
    ``realtime`` groups by id, shows the latest name and compares exact seconds.
    """
    if preset == BATCH:
        hours = metrics.student_hours(b, metrics.GROUP)
        order = [F.desc("total_hours"), F.asc("student_id"), F.asc("student_name")]
    elif preset == REALTIME:
        hours = metrics.student_hours(b, metrics.LATEST)
        order = [F.desc("total_seconds"), F.asc("student_id")]
    else:
        raise ValueError(f"unknown preset: {preset}")
    return ranks.ranked_top_k(hours, order, n).select(
        "rank", "student_id", "student_name", "total_hours", "courses"
    )


def rank_courses(course_metrics: DataFrame, key: str = "student_count") -> DataFrame:
    """All courses numbered by a metric, highest first."""
    return ranks.global_row_number(course_metrics, [F.desc(key), F.asc("course_id")])
