"""The six result sets of a log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from coursepulse import schema as S
from coursepulse.operators import alerts, metrics, ranking

BATCH, REALTIME = ranking.BATCH, ranking.REALTIME


def six_results(
    b: DataFrame, as_of: str, preset: str = BATCH, roster_size: int = S.ROSTER_SIZE
) -> dict[str, DataFrame]:
    """Summary, ranking, popularity, behaviours, hours and alerts, all lazy.

    ``b`` may be a log, which each result then scans, or a stored rollup.
    """
    realtime = preset == REALTIME
    policy = metrics.LATEST if realtime else metrics.GROUP
    rule = alerts.REALTIME_RULE if realtime else alerts.BATCH_RULE
    return {
        "summary": metrics.summary(b, roster_size),
        "student_ranking": ranking.student_ranking(b, preset=preset),
        "course_popularity": metrics.course_popularity(b, policy),
        "behavior_distribution": metrics.behavior_distribution(b),
        "time_distribution": metrics.time_distribution(b, zero_fill=realtime),
        "alerts": alerts.low_engagement(b, as_of, rule),
    }
