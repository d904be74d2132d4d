from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from coursepulse import fixtures, schema as S
from coursepulse.functions import draws as D, labels, rounding, timestamps as ts
from coursepulse.operators import quality


def half_up(x: Decimal, digits: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def test_hours_round_half_up(spark):
    df = spark.range(0, 40000, 7).select(
        "id", rounding.hours(F.col("id")).alias("h2"), rounding.hours(F.col("id"), 1).alias("h1")
    )
    for r in df.collect():
        exact = Decimal(r.id) / 3600
        assert r.h2 == half_up(exact, 2) and r.h1 == half_up(exact, 1)


def test_percent_and_mean(spark):
    df = spark.range(1, 200).select(
        "id",
        rounding.percent(F.col("id"), F.lit(199)).alias("p"),
        rounding.mean_of_tenths(F.col("id"), F.lit(7)).alias("m"),
        rounding.percent(F.lit(0), F.lit(0)).alias("none"),
        rounding.mean_of_tenths(F.lit(0), F.lit(0)).alias("no_one"),
    )
    for r in df.collect():
        assert r.p == half_up(Decimal(100 * r.id) / 199, 1)
        assert r.m == half_up(Decimal(r.id) / 70, 1)
        assert r.none == 0.0 and r.no_one == 0.0


def test_event_time_takes_one_format_only(spark):
    texts = ["2024-01-10 08:09:10", "garbage", "2024-01-10", "2024-01-10T08:09:10", "", None,
             "2024-13-10 08:09:10", "2024-02-30 08:09:10"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", ts.timestamp_text(ts.event_time(F.col("t"))).alias("p")).collect()
    assert [(r.t, r.p) for r in out if r.p is not None] == [(texts[0], texts[0])]


def test_times_do_not_depend_on_the_session_zone(spark):
    """02:30 does not exist on this day in New York; the log's clock does not care."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string")
        time = ts.event_time(F.col("t"))
        row = df.select(F.hour(time).alias("h"), ts.timestamp_text(time).alias("p")).first()
        assert (row.h, row.p) == (2, "2024-03-10 02:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_labels_and_levels(spark):
    df = spark.createDataFrame([("quiz_complete",), ("other",), (None,)], "c string")
    got = [r[0] for r in df.select(labels.label_behavior(F.col("c"))).collect()]
    assert got == ["测验完成", "other", None]
    days = spark.createDataFrame([(d,) for d in (7, 9, 10, 13, 14)], "d int")
    levels = [r[0] for r in days.select(labels.inactive_level(F.col("d"))).collect()]
    assert levels == ["低", "低", "中", "中", "高"]
    index = spark.range(-1, 7).select(labels.behavior_from_index(F.col("id")))
    assert [r[0] for r in index.collect()] == [S.BEHAVIORS[-1], *S.BEHAVIORS, *S.BEHAVIORS[-1:] * 2]


def test_draws_are_uniform_and_repeatable(spark):
    rows = spark.range(20000)
    u = D.draw(1, F.col("id"), 3)
    mean, lo, hi = rows.select(D.fraction(u).alias("x")).agg(
        F.avg("x"), F.min("x"), F.max("x")
    ).first()
    assert abs(mean - 0.5) < 0.01 and 0 <= lo < 0.001 and 0.999 < hi < 1
    once = rows.select("id", u.alias("u"))
    again = rows.repartition(7).select("id", u.alias("u"))
    assert once.exceptAll(again).isEmpty()
    columns = D.with_draws(rows, 1, F.col("id"), 6).select("id", "u3", "u5")
    single = rows.select("id", u.alias("u3"), D.draw(1, F.col("id"), 5).alias("u5"))
    assert columns.exceptAll(single).isEmpty()


def test_weights_and_shapes(spark):
    rows = spark.range(20000)
    u = D.draw(2, F.col("id"), 0)
    shares = {
        r[0]: r[1] / 20000
        for r in rows.groupBy(D.weighted(u, S.BEHAVIOR_WEIGHTS)).count().collect()
    }
    for code, weight in S.BEHAVIOR_WEIGHTS:
        assert abs(shares[code] - weight / 100) < 0.015
    mean, lo, hi = rows.select(D.triangular(u, 300, 7200, 2400).alias("x")).agg(
        F.avg("x"), F.min("x"), F.max("x")
    ).first()
    assert abs(mean - (300 + 7200 + 2400) / 3) < 50 and lo >= 300 and hi < 7200
    quiz = F.lit("quiz_complete")
    mark = D.score(quiz, u, D.draw(2, F.col("id"), 1))
    mean, sd, lo, hi = rows.select(mark.alias("x")).agg(
        F.avg("x"), F.stddev("x"), F.min("x"), F.max("x")
    ).first()
    assert abs(mean - 74.5) < 1 and abs(sd - 14.3) < 1 and lo >= 0 and hi <= 100
    assert rows.filter(D.score(F.lit("forum_post"), u, u).isNotNull()).isEmpty()


def test_ids_beyond_their_width_stay_apart(spark):
    users = spark.createDataFrame([(7,), (10_000_000,), (100_000_000,), (100_000_007,)], "u long")
    ids = [r[0] for r in users.select(fixtures.student_id(F.col("u"))).collect()]
    assert ids == ["STU_00000007", "STU_10000000", "STU_100000000", "STU_100000007"]


def test_only_whole_timestamps_are_read(spark):
    texts = [*fixtures.BROKEN_TIMES, "2024-01-10 08:00:00\n", "2024-01-10 08:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    read = [r[0] for r in df.select(ts.event_time(F.col("t"))).collect()]
    assert [x is not None for x in read] == [False] * 5 + [True, False]


def test_unknown_behaviours_have_their_default_range(spark):
    df = spark.range(200).withColumn("u", D.draw(1, F.col("id"), 0))
    nap = F.lit("nap")
    for drawn, low, high in (
        (D.inclusive_duration_for(nap, F.col("u")), 60, 600),
        (D.triangular_duration_for(nap, F.col("u")), 60, 3600),
    ):
        values = [r[0] for r in df.select(drawn).collect()]
        assert low <= min(values) and max(values) <= high and len(set(values)) > 100


def test_durations_that_are_no_integers_are_reported(spark):
    b = spark.createDataFrame([("1.5",), ("sixty",), ("60",), ("0",), (None,)], "duration string")
    rule = quality.default_rules(b)["duration_positive"]
    assert [r[0] for r in b.select(rule).collect()] == [True, True, False, True, True]
