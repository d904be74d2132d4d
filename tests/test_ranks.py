import os
import random

from pyspark.sql import functions as F

from coursepulse import session
from coursepulse.plans import ranks
from tests.conftest import plan_of


def test_global_numbers_match_a_sort(spark):
    rng = random.Random(3)
    # A third of the rows tie on the metric.
    rows = [(i, 1 if rng.random() < 0.34 else rng.randrange(1000)) for i in range(5000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id bigint, metric bigint").repartition(6)
    numbered = ranks.global_row_number(df, [F.desc("metric"), F.asc("id")])
    got = {r.id: r["rank"] for r in numbered.collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {r[0]: n for n, r in enumerate(order, 1)}


def test_ties_on_the_metric_spread_over_tasks(spark):
    df = spark.range(40000).select("id", F.lit(1).alias("metric"))
    numbered = ranks.global_row_number(df, [F.desc("metric"), F.asc("id")], "idx", first=0)
    assert numbered.filter("idx <> id").isEmpty()
    assert "BroadcastHashJoin" in plan_of(numbered)


def test_empty(spark):
    df = spark.range(0).withColumn("metric", F.lit(1))
    assert ranks.global_row_number(df, [F.asc("id")]).collect() == []


def test_top_k(spark):
    df = spark.range(100)
    top = ranks.ranked_top_k(df, [F.desc("id")], 3)
    assert [tuple(r) for r in top.collect()] == [(99, 1), (98, 2), (97, 3)]
    assert "TakeOrderedAndProject" in plan_of(ranks.top_k(df, [F.desc("id")], 3))


def test_a_scope_removes_its_scratch_data(spark):
    with session.scratch_scope(spark):
        kept = session.materialize(spark.range(3).toDF("x"), "scope")
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert kept.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)
