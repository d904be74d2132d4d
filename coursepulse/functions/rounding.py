"""HALF_UP rounding by integer arithmetic: exact, and the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _ratio_half_up(num: Column, den: Column | int, digits: int) -> Column:
    """``num / den`` rounded HALF_UP to ``digits`` decimals; inputs are non-negative integers."""
    scale = 10**digits
    den = F.lit(den).cast("bigint") if isinstance(den, int) else den.cast("bigint")
    units = F.call_function(
        "div", F.lit(2 * scale).cast("bigint") * num + den, F.lit(2).cast("bigint") * den
    )
    return units.cast("double") / F.lit(float(scale))


def hours(seconds: Column, digits: int = 2) -> Column:
    """Seconds as hours with one or two decimals."""
    return _ratio_half_up(seconds, 3600, digits)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with one decimal; 0 for an empty whole."""
    return _ratio_half_up(F.lit(100).cast("bigint") * part, F.greatest(whole, F.lit(1)), 1)


def tenths(seconds: Column) -> Column:
    """Hours in whole tenths, so that a mean of the rounded total stays in integers."""
    return F.call_function(
        "div", F.lit(20).cast("bigint") * seconds + F.lit(3600), F.lit(7200).cast("bigint")
    )


def mean_of_tenths(total_tenths: Column, n: Column) -> Column:
    """Mean of a total given in tenths over ``max(n, 1)``, one decimal."""
    den = F.greatest(n, F.lit(1)).cast("bigint")
    units = F.call_function(
        "div", F.lit(2).cast("bigint") * total_tenths + den, F.lit(2).cast("bigint") * den
    )
    return units.cast("double") / F.lit(10.0)
