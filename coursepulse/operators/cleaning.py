"""Cleaning, deduplication and the relation between the raw and the cleaned layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from coursepulse import schema as S
from coursepulse.functions import timestamps as ts


def _filled(column: str) -> Column:
    return F.coalesce(F.length(column) > 0, F.lit(False))


def is_valid() -> Column:
    """Student, course and behaviour are filled in and some time was spent."""
    positive = F.coalesce(F.col("duration") > 0, F.lit(False))
    return _filled("student_id") & _filled("course_id") & _filled("behavior_type") & positive


def clean(b: DataFrame) -> DataFrame:
    """Valid records only."""
    return b.filter(is_valid())


def dedup(b: DataFrame, key: list[str] | None = None) -> DataFrame:
    """The first record of each business key, by record_id, then by a hash of the others.

    One number instead of all columns keeps the sort narrow; records that share it are equal
    but for a collision of 64 bits. ``row_number() = 1`` is planned with a group limit before the shuffle: a key that fills
    a third of the log sends one row per task.
    """
    key = S.BUSINESS_KEY if key is None else key
    rest = [c for c in b.columns if c not in key and c != "record_id"]
    order = [F.col("record_id")] if "record_id" in b.columns else []
    if rest:
        order.append(F.xxhash64(*rest))
    window = Window.partitionBy(*key).orderBy(*(order or key))
    return b.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def dwd(ods: DataFrame) -> DataFrame:
    """The cleaned layer of a raw layer."""
    return dedup(clean(ods))


def keys(b: DataFrame) -> DataFrame:
    """Distinct business keys."""
    return b.select(*S.BUSINESS_KEY).distinct()


def extra_keys(cleaned: DataFrame, raw: DataFrame) -> DataFrame:
    """Business keys of the cleaned layer that the raw layer does not have.

    One aggregation over both layers instead of an anti-join: nulls compare equal, and
    each task sends every key once, however often it occurs.
    """
    present = F.lit(True)
    absent = F.lit(False)
    tagged = cleaned.select(
        *S.BUSINESS_KEY, present.alias("_in_cleaned"), absent.alias("_in_raw")
    ).unionAll(raw.select(*S.BUSINESS_KEY, absent, present))
    return (
        tagged.groupBy(*S.BUSINESS_KEY)
        .agg(F.max("_in_cleaned").alias("_in_cleaned"), F.max("_in_raw").alias("_in_raw"))
        .filter(F.col("_in_cleaned") & ~F.col("_in_raw"))
        .select(*S.BUSINESS_KEY)
    )


def layer_counts(cleaned: DataFrame, raw: DataFrame) -> DataFrame:
    """Rows of both layers, and whether cleaning added none."""
    rows = raw.agg(F.count(F.lit(1)).alias("ods_rows")).withColumn(
        "dwd_rows", cleaned.agg(F.count(F.lit(1))).scalar()
    )
    return rows.withColumn("not_increased", F.col("dwd_rows") <= F.col("ods_rows"))


def union_logs(parts: list[DataFrame]) -> DataFrame:
    """All rows of several logs; columns a log lacks are null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def select_b8(b: DataFrame) -> DataFrame:
    """The eight standard columns, in order and with the standard types."""
    return b.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.B8])


def add_calendar(b: DataFrame, term_start: str, exam_weeks: tuple[int, ...] = S.EXAM_WEEKS):
    """Date, hour, weekday (Monday is 0), week of term, weekend and exam-week flags."""
    time = ts.event_time(F.col("timestamp"))
    day = time.cast("date")
    week = ts.week_number(day, term_start)
    return b.withColumns(
        {
            "date": ts.date_text(day),
            "hour": F.hour(time),
            "weekday": F.weekday(day),
            "week_number": week,
            "is_weekend": ts.is_weekend(day),
            "is_exam_week": week.isin(*exam_weeks).cast("int"),
        }
    )


def sort_logs(b: DataFrame) -> DataFrame:
    """The log in time order; the id splits records of the same second over tasks."""
    return b.orderBy("timestamp", "record_id")


def sample_rows(b: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` records by id, for a look at the data."""
    return b.orderBy("record_id").limit(k)


def json_lines(b: DataFrame) -> DataFrame:
    """Each record as a JSON line."""
    return b.select(F.to_json(F.struct(*b.columns)).alias("value"))


def json_roundtrip(b: DataFrame) -> DataFrame:
    """Encode every record as JSON and decode it again; nothing may change."""
    return json_lines(b).select(F.from_json("value", b.schema).alias("r")).select("r.*")
