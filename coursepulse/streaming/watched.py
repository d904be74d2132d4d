"""Quality of a stream, counted while its rows are written.

Each micro-batch is written once, and the rules are counted by an observation of that write: no
other scan. The counts are stored by batch before the batch is committed, and a repeated batch
replaces its rows and its counts, so their sums are those of ``quality_report`` over the stored rows
also after a lost driver. (A listener's events come later than the commit and go with the driver.)
Nothing is shuffled between the observation and the files, so a task that is run again counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from coursepulse.operators.quality import default_rules

COUNTS = "rule string, violations bigint, rows bigint, batch_id bigint"


def _replace(df: DataFrame, batch_id: int, path: str) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def write_watched(
    batch: DataFrame, batch_id: int, path: str, counts: str, rules: dict[str, Column] | None = None
) -> None:
    """Store one micro-batch and the violations of each rule in it."""
    rules = default_rules(batch) if rules is None else rules
    seen = Observation()
    # Column names of rules are the caller's; the observation has names of its own.
    names = {f"r{i}": rule for i, rule in enumerate(rules)}
    totals = [F.count_if(rules[rule]).alias(n) for n, rule in names.items()]
    _replace(batch.observe(seen, F.count(F.lit(1)).alias("rows"), *totals), batch_id, path)
    got = seen.get
    found = [(rule, got[n], got["rows"]) for n, rule in names.items()]
    told = batch.sparkSession.createDataFrame(found, "rule string, violations bigint, rows bigint")
    _replace(told.coalesce(1), batch_id, counts)


def watch_stream(
    df: DataFrame,
    path: str,
    counts: str,
    checkpoint: str,
    rules: dict[str, Column] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Store a stream at ``path`` and its violations, batch by batch, at ``counts``.

    Without ``interval`` everything available is taken and the query ends.
    """
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        df.writeStream.foreachBatch(lambda b, i: write_watched(b, i, path, counts, rules))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def batch_report(spark: SparkSession, counts: str) -> DataFrame:
    """Violations of each rule in each batch."""
    return spark.read.schema(COUNTS).parquet(counts)


def stream_report(spark: SparkSession, counts: str) -> DataFrame:
    """Violations of each rule over all batches, as ``quality_report`` gives them."""
    return batch_report(spark, counts).groupBy("rule").agg(
        F.sum("violations").alias("violations"), F.sum("rows").alias("rows")
    )
