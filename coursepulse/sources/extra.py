"""Fields of a record beyond the known ones, kept as variants and written back beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from coursepulse import schema as S

EXTRA = "extra"


def unknown_fields(line: Column) -> Column:
    """Map of the fields of a JSON object that the record schema lacks; null if it is none.

    Values are variants: whatever they are, nothing of them is lost, and ``field`` takes a path
    out of them without parsing the line again.
    """
    every = F.from_json(line, "map<string,variant>")
    return F.map_filter(every, lambda name, _: ~name.isin(S.LOG.fieldNames()))


def field(name: str, path: str, kind: str) -> Column:
    """The value at ``path`` (such as ``$.device.os``) of an unknown field; null if it is not there."""
    return F.try_variant_get(F.col(EXTRA)[name], path, kind)


def as_lines(records: DataFrame, also: list[str]) -> DataFrame:
    """JSON lines with unknown fields beside the known ones, and the columns ``also``.

    Read again, a line gives the same record with the same unknown fields. Objects are joined as
    text: a name that occurs twice in a line stays as it was.
    """
    known = F.to_json(F.struct(*(c for c in records.columns if c not in (EXTRA, *also))))
    more = F.coalesce(F.to_json(EXTRA), F.lit("{}"))
    joined = F.concat(F.expr("left(_known, length(_known) - 1)"), F.lit(","), F.substring("_more", 2, 1 << 30))
    line = F.when(F.col("_more") == "{}", F.col("_known")).when(F.col("_known") == "{}", F.col("_more"))
    return records.select(*also, known.alias("_known"), more.alias("_more")).select(
        line.otherwise(joined).alias("value"), *also
    )
