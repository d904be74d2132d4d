from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from coursepulse import schema as S
from coursepulse.operators import cleaning, metrics, ranking
from coursepulse.plans.results import BATCH, REALTIME, six_results
from coursepulse.plans.rollup import merge, rollup, stored_rollup
from tests.conftest import as_set, frame, random_log, record, rows_of

LOGS = [(300, 2)]


@pytest.fixture(scope="module", params=LOGS, ids=str)
def log(request, spark):
    rows = random_log(*request.param)
    return rows, frame(spark, rows).cache()


def by(rows, *keys):
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[k] for k in keys)].append(r)
    return groups


def test_totals_by_student_match_a_filtered_sum(log):
    rows, b = log
    hours = {r.student_id: r for r in metrics.student_hours(b).collect()}
    for (student,), mine in by(rows, "student_id").items():
        assert hours[student].total_seconds == sum(r["duration"] for r in mine)
        assert hours[student].courses == len({r["course_id"] for r in mine})
    one = rows[0]["student_id"]
    total = metrics.student_total(b, one).first()[0]
    assert total == hours[one].total_seconds


def test_parts_add_up(log):
    rows, b = log
    parts = defaultdict(int)
    for r in metrics.student_behavior_duration(b).collect():
        parts[r.student_id] += r.duration
    wide = {r.student_id: sum(r[c] for c in [*S.BEHAVIORS, "other"])
            for r in metrics.student_behavior_duration(b, wide=True).collect()}
    totals = {k[0]: sum(r["duration"] for r in v) for k, v in by(rows, "student_id").items()}
    assert parts == totals and wide == totals
    counts = defaultdict(int)
    for r in metrics.student_behavior_counts(b).collect():
        counts[r.student_id] += r["count"]
    assert counts == {k[0]: len(v) for k, v in by(rows, "student_id").items()}


def test_other_behaviours_stay_in_the_sums(spark):
    b = frame(spark, [record(i, behavior=x, duration=100) for i, x in
                      enumerate(["video_watch", "nap", None])])
    wide = metrics.student_behavior_duration(b, wide=True).first()
    assert (wide.video_watch, wide.other) == (100, 200)
    profile = metrics.student_profile(b).first()
    assert (profile.total_duration, profile.n_video_watch, profile.n_other) == (300, 1, 2)


def test_profile_and_course_sets(log):
    rows, b = log
    courses = by([r.asDict() for r in metrics.student_courses(b).collect()], "student_id")
    for r in metrics.student_profile(b).collect():
        mine = by(rows, "student_id")[(r.student_id,)]
        assert r.course_count == len(courses[(r.student_id,)])
        assert {c["course_id"] for c in courses[(r.student_id,)]} == {
            m["course_id"] for m in mine
        }
        assert sum(r[f"n_{c}"] for c in S.BEHAVIORS) == len(mine)


def test_mean_scores(log):
    rows, b = log
    got = {r.student_id: r.avg_score for r in metrics.student_avg_score(b).collect()}
    for (student,), mine in by(rows, "student_id").items():
        scores = [r["score"] for r in mine if r["score"] is not None]
        if scores:
            assert abs(got[student] - sum(scores) / len(scores)) < 1e-10
        else:
            assert student not in got


def test_course_metrics_and_rank(log):
    rows, b = log
    expected = {
        c: (len({r["student_id"] for r in v}), sum(r["duration"] for r in v), len(v))
        for (c,), v in by(rows, "course_id").items()
    }
    found = metrics.course_metrics(b)
    got = {r.course_id: r for r in found.collect()}
    assert {c: (r.student_count, r.total_duration, r.behavior_count) for c, r in got.items()} == (
        expected
    )
    assert all(abs(r.avg_duration - r.total_duration / r.student_count) < 0.01
               for r in got.values())
    for position, key in enumerate(["student_count", "total_duration"]):
        order = sorted(expected, key=lambda c: (-expected[c][position], c))
        ranked = ranking.rank_courses(found, key).collect()
        assert [r.course_id for r in sorted(ranked, key=lambda r: r.rank)] == order
        assert sorted(r.rank for r in ranked) == list(range(1, len(order) + 1))


def test_additivity_and_order_independence(log):
    rows, b = log
    half = len(rows) // 2
    parts = cleaning.union_logs([
        cleaning.select_b8(b.filter(F.col("record_id") < f"r{half:06d}")),
        b.filter(F.col("record_id") >= f"r{half:06d}").select(*S.B11.fieldNames()),
    ])
    whole = as_set(metrics.student_hours(b))
    assert as_set(metrics.student_hours(parts)) == whole
    assert as_set(metrics.student_hours(b.repartition(5))) == whole


def test_reconciliation_and_dates(log):
    rows, b = log
    total = sum(r["duration"] for r in rows)
    assert rows_of(metrics.reconcile_duration(b)) == [(total, total, total, True)]
    dates = metrics.partition_counts(b).collect()
    assert sum(r["count"] for r in dates) == len(rows)
    assert len(dates) == len({r["timestamp"][:10] for r in rows})
    assert metrics.row_count(b).first()[0] == len(rows)


def test_distributions(log):
    rows, b = log
    behaviors = metrics.behavior_distribution(b).collect()
    assert [r["count"] for r in behaviors] == sorted((r["count"] for r in behaviors), reverse=True)
    assert sum(r["count"] for r in behaviors) == len(rows)
    assert abs(sum(r.percentage for r in behaviors) - 100) < 0.5
    hours = metrics.time_distribution(b, zero_fill=True).collect()
    counts = by(rows, "timestamp")
    assert [r.hour for r in hours] == list(range(24))
    assert sum(r["count"] for r in hours) == sum(len(v) for v in counts.values())
    assert sum(r["count"] for r in metrics.device_distribution(b).collect()) == len(rows)
    assert sum(r["count"] for r in metrics.weekend_split(b).collect()) == len(rows)


@pytest.mark.parametrize("preset", [BATCH, REALTIME])
def test_rollup_gives_the_results_of_the_log(log, preset):
    _, b = log
    stored = stored_rollup(b)
    from_log, from_rollup = six_results(b, "now", preset), six_results(stored, "now", preset)
    for name in from_log:
        assert rows_of(from_log[name]) == rows_of(from_rollup[name]), name
    for metric in (metrics.student_activity, metrics.last_activity, metrics.course_metrics,
                   metrics.student_profile, metrics.student_avg_score, metrics.weekend_split,
                   metrics.device_distribution, metrics.partition_counts, metrics.latest_names,
                   metrics.reconcile_duration, metrics.row_count):
        assert as_set(metric(b)) == as_set(metric(stored)), metric.__name__


def test_rollups_merge(log):
    rows, b = log
    cut = f"r{len(rows) // 3:06d}"
    parts = rollup(b.filter(F.col("record_id") < cut)).unionAll(
        rollup(b.filter(F.col("record_id") >= cut))
    )
    assert as_set(merge(parts)) == as_set(rollup(b))


def test_empty_log(spark):
    b = frame(spark, [])
    assert rows_of(metrics.summary(b)) == [(0, 0, 0, 0.0, 0.0, 0.0)]
    assert rows_of(metrics.reconcile_duration(b)) == [(0, 0, 0, True)]
    results = six_results(b, "now", REALTIME)
    assert all(r["count"] == 0 for r in results["time_distribution"].collect())
    for name in ("student_ranking", "course_popularity", "behavior_distribution", "alerts"):
        assert rows_of(results[name]) == []


def test_null_durations_and_bad_timestamps(spark):
    b = frame(spark, [record(1, duration=None), record(2, ts="garbage", student="STU_2")])
    assert metrics.summary(b).first().total_study_hours == 0.0
    hours = {r.student_id: r.total_hours for r in metrics.student_hours(b).collect()}
    assert hours["STU_1"] == 0.0
    assert rows_of(metrics.time_distribution(b)) == [(8, 1)]
    activity = {r.student_id: r.last_activity for r in metrics.student_activity(b).collect()}
    assert activity == {"STU_1": "2024-01-10 08:00:00", "STU_2": None}


def test_one_id_with_two_names(spark):
    b = frame(spark, [
        record(1, name="old", ts="2024-01-10 08:00:00", duration=100),
        record(2, name="new", ts="2024-01-11 08:00:00", duration=200),
        record(3, name="old", ts="2024-01-09 08:00:00", duration=300, course="COURSE_002"),
    ])
    assert len(rows_of(metrics.student_hours(b))) == 2
    latest = metrics.student_hours(b, metrics.LATEST).collect()
    assert [(r.student_name, r.total_seconds, r.courses) for r in latest] == [("new", 600, 2)]
    assert metrics.summary(b).first().total_students == 1
    assert rows_of(metrics.latest_names(b)) == [("STU_1", "new")]
    with pytest.raises(ValueError):
        metrics.student_hours(b, "other")


def test_ranking_breaks_ties_by_id(spark):
    b = frame(spark, [record(i, student=f"STU_{9 - i}", duration=60) for i in range(9)])
    ranked = ranking.student_ranking(b, 3).collect()
    assert [(r["rank"], r.student_id) for r in ranked] == [
        (1, "STU_1"), (2, "STU_2"), (3, "STU_3")
    ]
    # Rounded, 3601 s equals 3600 s: the batch order is by id, the realtime order by seconds.
    close = frame(spark, [record(1, student="A", duration=3600),
                          record(2, student="B", duration=3601)])
    assert ranking.student_ranking(close).first().student_id == "A"
    assert ranking.student_ranking(close, preset=REALTIME).first().student_id == "B"


def test_active_rate_is_capped(spark):
    b = frame(spark, [record(i, student=f"STU_{i}") for i in range(6)])
    assert metrics.summary(b, roster_size=4).first().active_rate == 100.0
    assert metrics.summary(b, roster_size=7).first().active_rate == 85.7
    assert rows_of(metrics.distinct_count(b, "student_id")) == [(6,)]
