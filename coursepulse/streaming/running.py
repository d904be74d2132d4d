"""Running statistics: each micro-batch adds its rollup, results are read from all of them.

Exact distinct counts need no state store that way. A batch writes only its own partition
and replaces it when retried, so every batch counts once. One checkpoint owns one path: a
new checkpoint may cut batches differently and has to start on a new path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from coursepulse import schema as S
from coursepulse.plans.results import REALTIME, six_results
from coursepulse.plans.rollup import ROLLUP_SCHEMA, merge, rollup
from coursepulse.sources.readers import good_records
from coursepulse.streaming.ingest import stream_logs, write_quarantine

FACT_SCHEMA = T.StructType([*ROLLUP_SCHEMA.fields, T.StructField("batch_id", T.LongType())])


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Store the rollup of one micro-batch, replacing an earlier attempt.

    Rebalanced by grain, a small batch makes a file for each grain.
    """
    (
        rollup(batch)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .hint("rebalance", "grain")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", "grain")
        .parquet(path)
    )


def running_fact(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    interval: str | None = None,
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Keep the fact at ``path`` up to date with a stream of log records.

    ``prepare`` is applied to each micro-batch, for instance to clean it. Lines that are no
    records are not counted but stored at ``quarantine_path``, by default ``_quarantine`` below
    ``path``, which readers of ``path`` pass over.
    """
    aside = f"{path.rstrip('/')}/_quarantine" if quarantine_path is None else quarantine_path

    def add(batch: DataFrame, batch_id: int) -> None:
        # Parsed once for both outcomes.
        held = batch.persist()
        try:
            records = held
            if S.CORRUPT in held.columns:
                write_quarantine(held, batch_id, aside)
                records = good_records(held)
            write_batch(prepare(records) if prepare else records, batch_id, path)
        finally:
            held.unpersist()

    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def snapshot(
    spark: SparkSession, path: str, compacted: str | None = None, upto: int | None = None
) -> DataFrame:
    """The rollups of all batches so far; empty before the first one.

    After ``compact`` pass its folder and result: batches up to there are read from it.
    """
    try:
        fact = spark.read.schema(FACT_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        fact = spark.createDataFrame([], FACT_SCHEMA)
    if compacted is None or upto is None:
        return fact
    old = spark.read.schema(FACT_SCHEMA).parquet(compacted)
    return old.filter(F.col("batch_id") == upto).unionByName(
        fact.filter(F.col("batch_id") > upto)
    )


def compact(
    spark: SparkSession,
    path: str,
    compacted: str,
    previous: int | None = None,
) -> int | None:
    """Merge all batches so far into one partition of ``compacted``; returns its batch id.

    The partition counts only once the caller has this id, so an interrupted run is void.
    """
    fact = snapshot(spark, path, compacted if previous is not None else None, previous)
    upto = fact.agg(F.max("batch_id")).first()[0]
    if upto is None or upto == previous:
        return previous
    (
        merge(fact.filter(F.col("batch_id") <= upto))
        .withColumn("batch_id", F.lit(upto).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", "grain")
        .parquet(compacted)
    )
    return upto


def drop_merged(spark: SparkSession, path: str, upto: int | None) -> None:
    """Remove the batches that ``compact`` has merged, up to its result.

    To be called once the caller has stored that result; a refresh then lists and reads the
    merged partition and the batches since.
    """
    if upto is None:
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for entry in fs.globStatus(hadoop.Path(folder, "batch_id=*")) or []:
        batch = entry.getPath()
        if int(batch.getName().partition("=")[2]) <= upto:
            fs.delete(batch, True)


def snapshot_results(
    spark: SparkSession,
    path: str,
    as_of: str,
    preset: str = REALTIME,
    compacted: str | None = None,
    upto: int | None = None,
    **options,
) -> dict[str, DataFrame]:
    """All six results as of now; ``compacted`` and ``upto`` as in ``snapshot``."""
    return six_results(snapshot(spark, path, compacted, upto), as_of, preset, **options)


def incremental_refresh(
    spark: SparkSession,
    landing: str,
    path: str,
    checkpoint: str,
    as_of: str,
    preset: str = REALTIME,
    max_files: int | None = None,
    quarantine_path: str | None = None,
    compacted: str | None = None,
    upto: int | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Take in the files that are new since the last call, then give all six results.

    Batches up to ``upto`` are read from ``compacted``; see ``compact`` and ``drop_merged``.
    """
    stream = stream_logs(spark, landing, max_files=max_files)
    running_fact(stream, path, checkpoint, quarantine_path=quarantine_path).awaitTermination()
    return snapshot_results(spark, path, as_of, preset, compacted, upto, **options)
