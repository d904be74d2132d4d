"""Positions in a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from coursepulse import session

# monotonically_increasing_id() keeps the row's position in its partition in the low 33 bits.
POSITION_BITS = 33


def global_row_number(
    df: DataFrame, order: list[Column], name: str = "rank", first: int = 1
) -> DataFrame:
    """Number all rows in ``order``, which must be a total order.

    The rows are range-partitioned on the whole order, so that ties on the leading column
    split as well, and stored once with their partition and position. A row's number is its
    position plus the sizes of the partitions before it; there is one size per partition,
    which bounds both the window and the broadcast.
    """
    placed = session.materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranks",
    )
    part = F.shiftright("_at", POSITION_BITS)
    position = F.col("_at").bitwiseAND((1 << POSITION_BITS) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + position + F.lit(first).cast("bigint"))
        .drop("_part", "_start", "_at")
    )


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows: each task keeps its own ``k``, one merges them."""
    return df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows with their positions; the window sees ``k`` rows only."""
    return top_k(df, order, k).withColumn(name, F.row_number().over(Window.orderBy(*order)))
