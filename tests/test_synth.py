from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from coursepulse import schema as S
from coursepulse.functions import draws as D
from coursepulse.operators import quality, synth
from tests.conftest import as_set, plan_of, rows_of

ROWS = 4000


@pytest.fixture(scope="module")
def dims(spark):
    return synth.roster(spark, 50), synth.course_catalogue(spark)


def ranges_hold(df, table, inclusive):
    for code, bounds in table.items():
        lo, hi = df.filter(F.col("behavior_type") == code).agg(
            F.min("duration"), F.max("duration")
        ).first()
        assert bounds[0] <= lo and (hi <= bounds[1] if inclusive else hi < bounds[1])


def test_ids_grow_beyond_their_padding(spark):
    ids = synth.roster(spark, 10002).filter("idx in (0, 7, 9999, 10000, 10001)")
    got = [r.student_id for r in ids.orderBy("idx").collect()]
    assert got == ["STU_20210000", "STU_20210007", "STU_20219999", "STU_202110000",
                   "STU_202110001"]
    students = synth.dataset_students(synth.roster(spark, 10500))
    assert students.select("student_id").distinct().count() == 10500


def test_standard_records(spark, dims):
    rows = synth.sequence_rows(spark, ROWS)
    b = synth.synth_b8(rows, *dims, seed=3)
    assert b.columns == S.B8_COLUMNS and b.count() == ROWS
    assert b.select("record_id").distinct().count() == ROWS
    assert b.select("student_id").distinct().count() == 50
    assert b.filter("course_name is null or student_name is null").isEmpty()
    ranges_hold(b, S.BATCH_DURATIONS, inclusive=False)
    lo, hi = b.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert "2025-09-01" <= lo < "2025-09-03" and "2025-12-22" < hi < "2025-12-25"
    again = synth.synth_b8(rows.repartition(9), *dims, seed=3)
    assert as_set(b) == as_set(again)
    assert as_set(b) != as_set(synth.synth_b8(rows, *dims, seed=4))


def test_detailed_records_pass_every_rule(spark, dims):
    b = synth.synth_b11(synth.sequence_rows(spark, ROWS), *dims, seed=3)
    assert b.columns == S.B11.fieldNames() and b.count() == ROWS
    assert all(r.violations == 0 for r in quality.quality_report(b).collect())
    ranges_hold(b, S.LOG_DURATIONS, inclusive=True)
    wrong = (F.col("score").isNotNull()) != F.col("behavior_type").isin(S.SCORED_BEHAVIORS)
    assert b.filter(wrong).isEmpty()
    assert "Exchange hash" not in plan_of(b)


def test_dataset_records(spark, dims):
    students = synth.dataset_students(dims[0].select("idx", "student_name"))
    b = synth.synth_b22(synth.sequence_rows(spark, ROWS), students, dims[1], seed=3).cache()
    assert b.columns == S.B22.fieldNames() and b.count() == ROWS
    ranges_hold(b, S.TRIANGULAR_DURATIONS, inclusive=True)
    report = {r.rule: r.violations for r in quality.quality_report(b).collect()}
    assert report["ip_format"] > 0  # prefixes with three octets give five
    assert sum(v for k, v in report.items() if k != "ip_format") == 0
    days = b.filter(F.to_date("date") < "2025-09-01").count() + b.filter(
        F.to_date("date") > "2025-12-24"
    ).count()
    assert days == 0
    assert b.filter((F.col("weekday") >= 5) != (F.col("is_weekend") == 1)).isEmpty()
    late = b.filter("is_exam_week = 1").agg(F.min("week_number"), F.max("week_number")).first()
    assert tuple(late) == (15, 16)
    assert b.filter("chapter_id < 'CH_001' or chapter_id > 'CH_016'").isEmpty()
    assert b.filter("not record_id rlike '^REC_[0-9]{14}_[0-9]{4}$'").isEmpty()


def acceptance(when):
    """The rule of rejection sampling, written out for one time."""
    table = S.WEEKDAY_HOUR_WEIGHTS if when.weekday() < 5 else S.WEEKEND_HOUR_WEIGHTS
    weight = 1.0
    for (lo, hi), w in table:
        if lo <= when.hour <= hi:
            weight = w
    if (when - datetime(2025, 9, 1)).days // 7 + 1 in (15, 16):
        weight *= 1.5
    return min(weight / 4, 1.0)


def test_times_follow_the_weights(spark):
    n = 60000
    u = [D.draw(5, F.col("row_id"), i) for i in range(2)]
    timed = synth.weighted_ts(synth.sequence_rows(spark, n), *u)
    assert timed.filter("event_ts is null").isEmpty()
    got = {
        (r.weekend, r.hour): r["count"]
        for r in timed.groupBy(
            (F.weekday("event_ts") >= 5).alias("weekend"), F.hour("event_ts").alias("hour")
        ).count().collect()
    }
    expected, start = {}, datetime(2025, 9, 1)
    for slot in range(115 * 24):
        when = start + timedelta(hours=slot)
        key = (when.weekday() >= 5, when.hour)
        expected[key] = expected.get(key, 0) + acceptance(when)
    total = sum(expected.values())
    for key, weight in expected.items():
        share = weight / total
        spread = 5 * (n * share * (1 - share)) ** 0.5
        assert abs(got.get(key, 0) - n * share) < spread, key
    assert "BroadcastNestedLoopJoin" not in plan_of(timed)
    with pytest.raises(ValueError):
        synth.weighted_ts(timed, *u, days=0)


def test_dense_index(spark):
    names = spark.createDataFrame([(f"s{i:03d}",) for i in range(97)], "name string")
    indexed = synth.dense_index(names.repartition(5), [F.asc("name")])
    assert sorted(rows_of(indexed.select("idx", "name"))) == [(i, f"s{i:03d}") for i in range(97)]
