"""The key difference of two stored layers by a hash tree, reading only what differs.

A layer's distinct business keys are stored by day and bucket, with a tree above them: for each
bucket the number of its keys and the sum of their hashes, which does not depend on their order; a
day's node is the sum of its buckets'. Layers that agree on a day are done with it after one
comparison; of other days the unequal buckets are read, and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from coursepulse import schema as S
from coursepulse.functions.timestamps import date_text, event_date
from coursepulse.operators.cleaning import extra_keys, keys
from coursepulse.session import materialize

BUCKETS = 16
NO_DAY = "none"
KEYS = ", ".join(f"`{k}` string" for k in S.BUSINESS_KEY) + ", node string"
TREE = "day string, node string, n bigint, total decimal(38,0)"


def write_layer(b: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store the distinct business keys of a log and the tree above them; unreadable dates are a day."""
    hashed = F.xxhash64(*S.BUSINESS_KEY)
    day = F.coalesce(date_text(event_date(F.col("timestamp"))), F.lit(NO_DAY))
    node = F.concat_ws(".", day, F.pmod(hashed, F.lit(buckets)).cast("string"))
    placed = keys(b).withColumn("node", node).hint("rebalance", "node")
    placed.write.mode("overwrite").partitionBy("node").parquet(f"{path}/keys")
    nodes = read_keys(b.sparkSession, path).groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.sum(hashed.cast("decimal(38,0)")).alias("total")
    )
    nodes.withColumn("day", F.substring_index("node", ".", 1)).select("day", "node", "n", "total").write.mode("overwrite").parquet(f"{path}/tree")


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KEYS).parquet(f"{path}/keys")


def _unequal(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """The nodes of one level that differ, or that one side lacks."""
    one = left.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    other = right.groupBy(*by).agg(F.sum("n").alias("m"), F.sum("total").alias("sum"))
    differ = ~(F.col("n").eqNullSafe(F.col("m")) & F.col("total").eqNullSafe(F.col("sum")))
    return one.join(other, by, "full").filter(differ).select(*by)


def unequal_buckets(spark: SparkSession, left: str, right: str) -> DataFrame:
    """The nodes (day.bucket) that two layers do not share, found level by level."""
    a, b = (spark.read.schema(TREE).parquet(f"{p}/tree") for p in (left, right))
    days = _unequal(a, b, ["day"])
    return _unequal(a.join(days, "day", "left_semi"), b.join(days, "day", "left_semi"), ["node"])


def missing_keys(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Business keys of the layer at ``left`` that the one at ``right`` does not have.

    The unequal buckets are stored, so that their size is known: small, they prune the folders
    of the keys (the comparison tells the optimizer that they select); large, they are joined.
    """
    differ = materialize(unequal_buckets(spark, left, right), "unequal").filter("node > ''")
    a, b = (read_keys(spark, p).join(differ, "node", "left_semi") for p in (left, right))
    return extra_keys(a, b)
