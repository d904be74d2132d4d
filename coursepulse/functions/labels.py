"""Code-to-label expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from coursepulse import schema as S


def label_behavior(code: Column) -> Column:
    """Display label of a behaviour code; an unknown code is its own label."""
    labels = F.create_map(*[F.lit(v) for v in chain.from_iterable(S.BEHAVIOR_LABELS.items())])
    return F.coalesce(F.try_element_at(labels, code), code)


def behavior_from_index(idx: Column) -> Column:
    """Behaviour by position; every other index is the last behaviour."""
    case = F
    for i, name in enumerate(S.BEHAVIORS[:-1]):
        case = case.when(idx == i, F.lit(name))
    return case.otherwise(F.lit(S.BEHAVIORS[-1]))


def zero_padded(number: Column, width: int) -> Column:
    """A number with at least ``width`` digits; ``lpad`` alone would cut longer ones."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def inactive_level(days: Column) -> Column:
    """Severity of an absence of ``days`` days."""
    case = F
    for floor, level in S.INACTIVE_LEVELS:
        case = case.when(days >= floor, F.lit(level))
    return case.otherwise(F.lit(S.INACTIVE_LEVEL_DEFAULT))
