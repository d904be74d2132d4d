"""Readers. Schemas are always given, so no job runs to infer one."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from coursepulse import schema as S
from coursepulse.sources.extra import EXTRA, unknown_fields

PARTITIONS = ["year", "month", "day"]
DATED_LINES = "value string, year int, month int, day int, batch string"
# The folder of a landed batch, and every visible name that is none.
BATCH = "batch"
NO_BATCH = "{[^b_.]*,b[^a]*,ba[^t]*,bat[^c]*,batc[^h]*,batch[^=]*}"


def parse_records(lines: DataFrame, extra: bool = False) -> DataFrame:
    """The record in each ``value``, beside the other columns of ``lines``.

    With ``extra`` fields that the schema lacks are kept in a map of variants; see ``sources.extra``.

    A line that is no record is kept in ``_corrupt_record``. Whether it is one depends on
    the whole line here; the JSON file source judges by the columns a query happens to read.
    ``explode`` over the single record keeps later filters from parsing the line again.
    """
    others = [c for c in lines.columns if c != "value"]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT}
    record = F.from_json("value", S.LOG_WITH_CORRUPT, options)
    parsed = lines.filter(F.trim("value") != "").withColumn("_record", F.explode(F.array(record)))
    unread = F.when(F.col("_record").isNull(), F.col("value")).otherwise(
        F.col(f"_record.{S.CORRUPT}")
    )
    fields = [F.col(f"_record.{c}").alias(c) for c in S.LOG.fieldNames()]
    if extra:
        fields.append(unknown_fields(F.col("value")).alias(EXTRA))
    return parsed.select(*fields, *others, unread.alias(S.CORRUPT))


def read_json_logs(spark: SparkSession, path: str, extra: bool = False) -> DataFrame:
    """JSON lines anywhere below ``path``, of either record form.

    The recursive lookup also finds files of a folder that mixes dated sub-folders with
    files at its root; plain partition discovery would lose the latter.
    """
    return parse_records(spark.read.option("recursiveFileLookup", True).text(path), extra)


def read_csv_logs(spark: SparkSession, path: str, schema: T.StructType = S.B22) -> DataFrame:
    """CSV files with a header; an empty score is null, a byte-order mark is skipped.

    Columns are read by position, so a header in another order is an error. A row that does
    not fit the schema is kept in ``_corrupt_record``; see ``good_records``, ``quarantine``.
    """
    corrupt = T.StructField(S.CORRUPT, T.StringType())
    rows = (
        spark.read.schema(T.StructType([*schema.fields, corrupt]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", S.CORRUPT)
        .csv(path)
    )
    # As in parse_records: the whole row decides, not the columns that a query reads.
    whole = rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("_row"))
    return whole.select("_row.*")


def _any(spark: SparkSession, pattern: str) -> bool:
    """Whether there is a path of this pattern."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = glob.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(fs.globStatus(glob))


def dated_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, year, month, day, batch) of the lines under ``year=/month=/day=``.

    Landed batches are a folder each below their day; files of a day itself have no batch. Partition
    discovery takes one depth only, so where both are met they are read apart.
    """
    days = f"{path}/year=*/month=*/day=*"
    folders = [F.col(p).cast("int").alias(p) for p in PARTITIONS]
    batch = F.col(BATCH).cast("string").alias(BATCH)
    none = F.lit(None).cast("string").alias(BATCH)
    landed, flat = _any(spark, f"{days}/{BATCH}=*"), _any(spark, f"{days}/{NO_BATCH}")
    if not landed and not flat:
        return spark.createDataFrame([], DATED_LINES)
    if not landed:
        return spark.read.text(path).select("value", *folders, none)
    if not flat:
        return spark.read.text(path).select("value", *folders, batch)
    reader = spark.read.option("basePath", path)
    return (
        reader.text(f"{days}/{BATCH}=*")
        .select("value", *folders, batch)
        .unionAll(reader.text(f"{days}/{NO_BATCH}").select("value", *folders, none))
    )


def read_partitioned_logs(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    extra: bool = False,
) -> DataFrame:
    """JSON lines under ``year=/month=/day=``, only the folders from ``start`` to ``end``.

    The condition uses partition columns alone, so other folders are not opened. Without a
    condition files beside the dated folders are read too, with null dates: partition
    discovery alone would leave them out.
    """
    lines = dated_lines(spark, path).drop(BATCH)
    if start is None and end is None:
        every = spark.read.option("recursiveFileLookup", True).text(path)
        undated = every.filter(~F.col("_metadata.file_path").contains(f"/{PARTITIONS[0]}="))
        lines = lines.unionByName(
            undated.select("value", *(F.lit(None).cast("int").alias(p) for p in PARTITIONS))
        )
    day = F.make_date(*PARTITIONS)
    if start is not None:
        lines = lines.filter(day >= F.lit(start).cast("date"))
    if end is not None:
        lines = lines.filter(day <= F.lit(end).cast("date"))
    return parse_records(lines, extra)


def dim(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A dimension held in memory, with a dense ``idx`` in the order given.

    Made from an Arrow table, the frame has a known size in bytes, by which Spark decides
    whether to broadcast it.
    """
    fields = _with_index(schema)
    indexed = [(i, *row) for i, row in enumerate(rows)]
    arrow = to_arrow_schema(fields)
    columns = [
        pa.array([row[k] for row in indexed], kind.type) for k, kind in enumerate(arrow)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), fields)


def _with_index(schema: str | T.StructType) -> T.StructType:
    fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    return T.StructType([T.StructField("idx", T.LongType(), False), *fields])


def batch_frame(
    spark: SparkSession, rows: list, schema: T.StructType = S.B8
) -> DataFrame:
    """A small batch of records the caller holds; a missing mandatory field is an error."""
    return spark.createDataFrame(rows, schema)


def conform(df: DataFrame, schema: T.StructType = S.B8) -> DataFrame:
    """The same check for a distributed frame: cast to ``schema``, fail on missing fields.

    The check is a filter over all mandatory fields, so it holds whatever columns are read.
    """
    cast = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
    checked = F.lit(True)
    for field in schema:
        if not field.nullable:
            missing = F.raise_error(F.lit(f"{field.name} must not be null")).cast("boolean")
            checked = F.when(F.col(field.name).isNull(), missing).otherwise(checked)
    return cast.filter(checked)


def good_records(logs: DataFrame) -> DataFrame:
    """Records that could be read."""
    return logs.filter(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)


def quarantine(logs: DataFrame) -> DataFrame:
    """The text of lines that could not be read."""
    return logs.filter(F.col(S.CORRUPT).isNotNull()).select(F.col(S.CORRUPT).alias("line"))
