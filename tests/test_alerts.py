import pytest
from pyspark.sql import functions as F

from coursepulse.operators import alerts
from tests.conftest import frame, random_log, record, rows_of

AS_OF = "2024-01-31"


def totals(spark, seconds):
    return frame(spark, [record(i, student=f"STU_{s}", duration=s) for i, s in enumerate(seconds)])


def test_batch_rule_compares_rounded_hours(spark):
    b = totals(spark, [7181, 7182, 17981, 17982])
    got = {r.student_id: (r.level, r.total_hours)
           for r in alerts.low_engagement(b, "now").collect()}
    assert got == {
        "STU_7181": ("high", 1.99), "STU_7182": ("medium", 2.0), "STU_17981": ("medium", 4.99)
    }
    first = alerts.low_engagement(b, "now").first()
    assert first.alert_message == "学习时长仅 1.99 小时，低于平均水平"
    assert first.alert_time == "now" and first.alert_type == "low_engagement"


def test_batch_rule_keeps_the_twenty_lowest(spark):
    got = alerts.low_engagement(totals(spark, range(100, 3100, 100)), "now").collect()
    assert len(got) == 20 and [r.total_hours for r in got] == sorted(r.total_hours for r in got)


def test_realtime_rule_limits_first(spark):
    b = totals(spark, [179999, 180000, 359999, 360000, 400000, 500000])
    got = [(r.student_id, r.level, r.alert_message)
           for r in alerts.low_engagement(b, "now", alerts.REALTIME_RULE).collect()]
    assert got == [
        ("STU_179999", "high", "学习时长仅 50.0 小时"),
        ("STU_180000", "medium", "学习时长仅 50.0 小时"),
        ("STU_359999", "medium", "学习时长仅 100.0 小时"),
    ]


def test_inactive_days_and_levels(spark):
    days = {25: 6, 24: 7, 22: 9, 21: 10, 18: 13, 17: 14}
    b = frame(spark, [record(d, student=f"S{n}", ts=f"2024-01-{d} 23:59:59")
                      for d, n in days.items()] + [record(99, student="S6", ts="garbage")])
    found = alerts.with_inactive_level(alerts.inactive_students(b, AS_OF))
    assert {(r.student_id, r.inactive_days, r.level) for r in found.collect()} == {
        ("S7", 7, "低"), ("S9", 9, "低"), ("S10", 10, "中"), ("S13", 13, "中"), ("S14", 14, "高")
    }


@pytest.mark.parametrize("lo", [5, 10, 20])
def test_a_higher_threshold_flags_a_subset(spark, lo):
    b = frame(spark, random_log(60, lo, students=30))
    low = {r.student_id for r in alerts.inactive_students(b, AS_OF, lo).collect()}
    high = {r.student_id for r in alerts.inactive_students(b, AS_OF, lo + 3).collect()}
    assert high <= low
    diff = alerts.threshold_diff(b, AS_OF, lo, lo + 3).collect()
    assert {r.student_id for r in diff} == low
    assert {r.student_id for r in diff if r.also_at_hi} == high
    with pytest.raises(ValueError):
        alerts.threshold_diff(b, AS_OF, lo, lo - 1)


def test_low_duration_is_strict(spark):
    b = totals(spark, [1799, 1800, 1801])
    assert rows_of(alerts.low_duration(b)) == [("STU_1799", 1799)]


def test_low_score_ignores_students_without_scores(spark):
    b = frame(spark, [record(1, student="A", score=59.9), record(2, student="B", score=60.0),
                      record(3, student="C", score=None)])
    assert [r.student_id for r in alerts.low_score(b).collect()] == ["A"]
    assert alerts.low_score(b.filter(F.lit(False))).isEmpty()
