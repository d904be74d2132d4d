"""Parsing and calendar expressions for the log's text timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from coursepulse import schema as S


def event_time(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a zone-free timestamp; null when malformed.

    The cast parser is several times faster than a pattern formatter; the pattern pins the
    fixed-width format it would otherwise be lenient about. (The length keeps out a line
    break, which the pattern's end would let pass.)
    """
    fixed_width = (F.length(ts) == 19) & ts.rlike(S.TIMESTAMP_PATTERN)
    return F.when(fixed_width, ts.try_cast("timestamp_ntz"))


def event_date(ts: Column) -> Column:
    return event_time(ts).cast("date")


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a zone-free timestamp, whatever the session's zone.

    ``date_format`` would pass through the session zone and shift hours its clock skips.
    """
    return F.substring(ts.cast("string"), 1, 19)


def compact_text(ts: Column) -> Column:
    """``yyyyMMddHHmmss`` text of a zone-free timestamp."""
    return F.translate(timestamp_text(ts), "-: ", "")


def date_text(day: Column) -> Column:
    """``yyyy-MM-dd`` text of a date."""
    return day.cast("string")


def week_number(day: Column, term_start: str) -> Column:
    """Week of the term, counted from 1."""
    return (F.floor(F.datediff(day, F.lit(term_start).cast("date")) / F.lit(7)) + 1).cast("int")


def is_weekend(day: Column) -> Column:
    return F.when(F.weekday(day) >= 5, 1).otherwise(F.when(day.isNotNull(), 0))


def at_second(start: str, second: Column) -> Column:
    """Midnight of ``start`` plus a number of seconds, zone-free.

    ``timestamp_add`` counts in integers; an interval would be built from decimals.
    """
    return F.timestamp_add("SECOND", second.cast("int"), F.lit(start).cast("timestamp_ntz"))


def at_offset(start: str, days: Column, hours: Column, minutes: Column, seconds: Column) -> Column:
    """Midnight of ``start`` plus days, hours, minutes and seconds, zone-free."""
    return at_second(start, ((days * 24 + hours) * 60 + minutes) * 60 + seconds)
