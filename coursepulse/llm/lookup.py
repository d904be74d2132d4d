"""A row of constant tables that higher-order functions read by position."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def constants(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """One row of constants as a frame with the single column ``tables``."""
    row = spark.createDataFrame(pa.table(columns))
    return row.select(F.struct(*columns).alias("tables"))


def unused(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until no column that is there has it; case does not count."""
    there = {t.lower() for t in taken}
    while name.lower() in there:
        name += "_"
    return name


def with_constants(
    df: DataFrame, out: str, tables: DataFrame, body: Callable[[Column], Column]
) -> DataFrame:
    """``df`` with the column ``out``: ``body`` over the one row of constants.

    The row is a scalar subquery used once, so that the optimizer inlines it as a constant.
    """
    inside = unused("_tables", [*df.columns, out])
    held = df.withColumn(inside, tables.scalar())
    value = F.transform(F.array(F.col(inside)), body)[0]
    return held.withColumn(out, value).drop(inside)
