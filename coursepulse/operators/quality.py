"""Data-quality rules: each is a boolean column that is true for a violating record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coursepulse import schema as S


def _unless(ok: Column) -> Column:
    """Violated unless ``ok`` holds; an unknown answer is a violation."""
    return ~F.coalesce(ok, F.lit(False))


def default_rules(b: DataFrame, ip_pattern: str = S.IP_PATTERN) -> dict[str, Column]:
    """The rules of a detailed record. A column the log lacks violates its rules throughout."""

    def col(name: str) -> Column:
        return F.col(name) if name in b.columns else F.lit(None)

    def text(name: str) -> Column:
        return col(name).cast("string")

    missing = [col(f).isNull() for f in S.REQUIRED_FIELDS if f != "score"]
    if "score" not in b.columns:
        missing.append(F.lit(True))
    score = col("score").try_cast("double")
    # A fraction or a text is no positive integer; neither may end the report.
    seconds = col("duration").try_cast("double")
    return {
        "required_fields": reduce(lambda x, y: x | y, missing),
        "behavior_enum": _unless(text("behavior_type").isin(S.BEHAVIORS)),
        "device_enum": _unless(text("device_type").isin(S.DEVICES)),
        "duration_positive": _unless((seconds > 0) & (seconds == F.floor(seconds))),
        "student_id_prefix": _unless(text("student_id").startswith(S.STUDENT_PREFIX)),
        "course_id_prefix": _unless(text("course_id").startswith(S.COURSE_PREFIX)),
        "timestamp_format": _unless(text("timestamp").rlike(S.TIMESTAMP_PATTERN)),
        "score_range": _unless(col("score").isNull() | score.between(0, 100)),
        "ip_format": _unless(text("ip_address").rlike(ip_pattern)),
    }


def quality_report(b: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Violations of each rule and rows checked: all rules in one scan."""
    rules = default_rules(b) if rules is None else rules
    counts = [F.count_if(violated).alias(name) for name, violated in rules.items()]
    totals = b.agg(F.count(F.lit(1)).alias("rows"), *counts)
    return totals.unpivot("rows", list(rules), "rule", "violations").select(
        "rule", "violations", "rows"
    )


def violations(b: DataFrame, rule: str, rules: dict[str, Column] | None = None) -> DataFrame:
    """The records that violate one rule."""
    rules = default_rules(b) if rules is None else rules
    return b.filter(rules[rule])


def compare_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a write, and whether they are equal."""
    rows = before.agg(F.count(F.lit(1)).alias("rows_before")).withColumn(
        "rows_after", after.agg(F.count(F.lit(1))).scalar()
    )
    return rows.withColumn("equal", F.col("rows_before") == F.col("rows_after"))


def csv_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Files and lines of a CSV folder; each file spends one line on its header."""
    per_file = (
        spark.read.text(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("lines"), F.lit(0).cast("bigint")).alias("lines"),
    ).withColumn("records", F.col("lines") - F.col("files"))
