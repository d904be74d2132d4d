"""Writers. Results go to distributed storage, one folder per frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coursepulse.functions.timestamps import date_text, event_date
from coursepulse.sources.extra import EXTRA, as_lines

FORMATS = ("json", "csv")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; ``append`` adds a batch to the folder."""
    df.write.mode(mode).json(path)


def write_logs(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """JSON lines or CSV with a header."""
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    writer = df.write.mode(mode)
    if fmt == "json":
        writer.json(path)
    else:
        writer.option("header", True).csv(path)


def with_partition_columns(df: DataFrame, day: Column) -> DataFrame:
    """Adds zero-padded ``year``, ``month`` and ``day``."""
    text = date_text(day)
    return df.withColumns(
        {
            "year": F.substring(text, 1, 4),
            "month": F.substring(text, 6, 2),
            "day": F.substring(text, 9, 2),
        }
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    date_col: str = "timestamp",
    fmt: str = "json",
    mode: str = "append",
    day: Column | None = None,
) -> None:
    """Land rows under the ``year=/month=/day=`` of their event time, or of ``day``.

    Rebalancing brings the rows of a day together, which avoids a file per task and day,
    and lets Spark split a day that is too large for one task.
    """
    dated = with_partition_columns(df, event_date(F.col(date_col)) if day is None else day)
    dated.hint("rebalance", "year", "month", "day").write.mode(mode).partitionBy(
        "year", "month", "day"
    ).format(fmt).save(path)


def batch_name(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def write_batch(df: DataFrame, path: str, batch_id: int, day: Column, fmt: str = "json") -> None:
    """Land a micro-batch: a folder of its own below each of its days.

    Spark's dynamic partition overwrite commits it. It replaces the folders of this batch and no
    others, so that a batch that is repeated, or was killed half way, gives its rows once. Fields in
    a column of variants are written beside the others.
    """
    dated = with_partition_columns(df, day).withColumn("batch", F.lit(batch_name(batch_id)))
    folders = ["year", "month", "day", "batch"]
    if EXTRA in df.columns and fmt == "json":
        dated, fmt = as_lines(dated, folders), "text"
    (
        dated.hint("rebalance", "year", "month", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .format(fmt)
        .save(path)
    )


def write_bundle(results: dict[str, DataFrame], path: str) -> None:
    """Each named result as JSON lines in its own folder."""
    for name, df in results.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def read_bundle(spark: SparkSession, path: str, results: dict[str, DataFrame]) -> dict:
    """The results written by ``write_bundle``, with the schemas of ``results``."""
    return {
        name: spark.read.schema(df.schema).json(f"{path}/{name}") for name, df in results.items()
    }


def bundle(results: dict[str, DataFrame]) -> DataFrame:
    """All results in one frame: the name and each row as a JSON object."""
    rows = [
        df.select(F.lit(name).alias("result"), F.to_json(F.struct(*df.columns)).alias("row"))
        for name, df in results.items()
    ]
    return reduce(DataFrame.unionAll, rows)
