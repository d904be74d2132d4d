from pyspark.sql import functions as F

from coursepulse import schema as S
from coursepulse.operators import cleaning, quality
from tests.conftest import as_set, frame, plan_of, random_log, record, rows_of


def dirty(spark):
    rows = random_log(200, 5)
    rows += [dict(r, record_id="x" + r["record_id"], score=1.0) for r in rows[::3]]
    rows += [record(900, student=None), record(901, student=""), record(902, course=None),
             record(903, behavior=""), record(904, duration=0), record(905, duration=None)]
    return rows, frame(spark, rows)


def test_clean_keeps_valid_rows_only(spark):
    rows, b = dirty(spark)
    kept = {r.record_id for r in cleaning.clean(b).collect()}
    assert kept == {r["record_id"] for r in rows if not r["record_id"].startswith("r0009")}


def test_dedup_keeps_the_first_record_and_is_idempotent(spark):
    rows, b = dirty(spark)
    first = {}
    for r in sorted(rows, key=lambda r: r["record_id"]):
        first.setdefault(tuple(r[k] for k in S.BUSINESS_KEY), r["record_id"])
    once = cleaning.dedup(b)
    assert {r.record_id for r in once.collect()} == set(first.values())
    assert as_set(cleaning.dedup(once)) == as_set(once)


def test_dedup_does_not_depend_on_partitioning(spark):
    _, b = dirty(spark)
    plain = b.drop("record_id")
    assert as_set(cleaning.dedup(plain)) == as_set(cleaning.dedup(plain.repartition(9)))


def test_dedup_cuts_a_hot_key_before_the_shuffle(spark):
    rows = [record(i) for i in range(100)] + random_log(200, 6)
    for i, r in enumerate(rows):
        r["record_id"] = f"r{i:06d}"
    result = cleaning.dedup(frame(spark, rows))
    hot = result.filter((F.col("student_id") == "STU_1") & (F.col("duration") == 60))
    assert "r000000" in {r.record_id for r in hot.collect()}
    plan = plan_of(cleaning.dedup(frame(spark, rows)))
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_layers(spark):
    _, b = dirty(spark)
    dwd = cleaning.dwd(b)
    assert rows_of(cleaning.extra_keys(dwd, b)) == []
    counts = cleaning.layer_counts(dwd, b).first()
    assert counts.not_increased and counts.dwd_rows < counts.ods_rows
    lost = as_set(cleaning.extra_keys(b, dwd))
    assert lost == as_set(cleaning.keys(b).subtract(cleaning.keys(dwd)))
    assert len(lost) == 5  # the rows with zero and null duration share a key


def test_json_roundtrip_changes_nothing(spark):
    _, b = dirty(spark)
    assert as_set(cleaning.json_roundtrip(b)) == as_set(b)


def test_sort_and_sample(spark):
    _, b = dirty(spark)
    times = [(r.timestamp, r.record_id) for r in cleaning.sort_logs(b).collect()]
    assert times == sorted(times)
    assert [r.record_id for r in cleaning.sample_rows(b, 3).collect()] == [
        "r000000", "r000001", "r000002"
    ]


def test_calendar(spark):
    b = frame(spark, [record(1, ts="2025-09-01 00:00:00"), record(2, ts="2025-12-14 23:59:59"),
                      record(3, ts="2025-12-08 12:00:00"), record(4, ts="garbage")])
    got = cleaning.add_calendar(b, "2025-09-01").orderBy("record_id").select(
        "date", "hour", "weekday", "week_number", "is_weekend", "is_exam_week"
    )
    assert rows_of(got) == [
        ("2025-09-01", 0, 0, 1, 0, 0),
        ("2025-12-14", 23, 6, 15, 1, 1),
        ("2025-12-08", 12, 0, 15, 0, 1),
        (None, None, None, None, None, None),
    ]


def test_quality_rules(spark):
    b = frame(spark, [
        record(1), record(2, behavior="nap"), record(3, device_type=None),
        record(4, duration=-1), record(5, student="X"), record(6, course="X"),
        record(7, ts="2024/01/01"), record(8, score=100.1), record(9, ip_address="192.168.1.2.3"),
        record(10, score=100.0), record(11, score=0.0),
    ])
    report = {r.rule: r.violations for r in quality.quality_report(b).collect()}
    assert report == {
        "required_fields": 1, "behavior_enum": 1, "device_enum": 1, "duration_positive": 1,
        "student_id_prefix": 1, "course_id_prefix": 1, "timestamp_format": 1, "score_range": 1,
        "ip_format": 1,
    }
    bad = quality.violations(b, "score_range").collect()
    assert [r.record_id for r in bad] == ["r000008"]
    short = quality.quality_report(cleaning.select_b8(b)).collect()
    assert {r.rule for r in short if r.violations == 11} >= {"required_fields", "ip_format"}
