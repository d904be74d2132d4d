"""Deduplication across batches by a store of the business keys seen so far.

The store is hash-bucketed: a batch reads only the buckets that its own keys fall into, and only keys,
never the log. The first batch that has a key keeps its record; within a batch the record of least
id. Where batches come in order of record ids, this is the deduplication of all of them together.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from coursepulse import schema as S
from coursepulse.operators.cleaning import dedup
from coursepulse.session import materialize

BUCKETS = 64
STORE = T.StructType(
    [T.StructField(k, T.StringType()) for k in S.BUSINESS_KEY]
    + [T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.LongType())]
)


def seen_keys(spark: SparkSession, store: str, before: int) -> DataFrame:
    """Keys of the batches before ``before``; none if there is no store yet."""
    try:
        found = spark.read.schema(STORE).parquet(store)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], STORE)
    return found.filter(F.col("batch_id") < before)


def unseen(batch: DataFrame, batch_id: int, store: str, buckets: int = BUCKETS) -> DataFrame:
    """The first record of each key of ``batch`` that no batch before had, with its bucket.

    Batches after ``batch_id`` are passed over, so that a repeated batch gives the same rows.
    """
    bucket = F.pmod(F.xxhash64(*S.BUSINESS_KEY), F.lit(buckets)).cast("int")
    fresh = materialize(dedup(batch).withColumn("bucket", bucket), "unseen")
    # At most one number for each bucket reaches the driver; others' folders are not listed.
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    seen = seen_keys(batch.sparkSession, store, batch_id).filter(F.col("bucket").isin(touched))
    names = {k: f"_{k}" for k in ("bucket", *S.BUSINESS_KEY)}
    seen = seen.select(*(F.col(k).alias(v) for k, v in names.items()))
    same = [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()]
    return fresh.join(seen, same, "left_anti")


def dedup_batch(batch: DataFrame, batch_id: int, store: str, path: str, buckets: int = BUCKETS) -> None:
    """Add to ``path`` the rows of a batch whose keys are new, and to ``store`` these keys.

    Both replace their own partition of the batch, so a repeated batch counts once.
    """
    rows = materialize(unseen(batch, batch_id, store, buckets), "unseen-rows")
    numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    overwrite = lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    overwrite(numbered.drop("bucket")).partitionBy("batch_id").parquet(path)
    keys = numbered.select(*S.BUSINESS_KEY, "bucket", "batch_id").hint("rebalance", "bucket")
    overwrite(keys).partitionBy("bucket", "batch_id").parquet(store)
