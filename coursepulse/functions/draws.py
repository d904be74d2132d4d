"""Reproducible random draws as column expressions.

A draw is a 32-bit slice of ``md5(seed:row:block)``: it depends on nothing but the row, so
a retried task, another partitioning or another engine gives the same value. One digest
serves four salts, and all arithmetic up to the final value stays in integers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from coursepulse import schema as S
from coursepulse.functions.labels import zero_padded

TWO_32 = 2**32


def _digest(seed: int, row: Column, block: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), row.cast("string"), F.lit(str(block))))


def _slice(digest: Column, part: int) -> Column:
    return F.conv(F.substring(digest, part * 8 + 1, 8), 16, 10).cast("bigint")


def draw(seed: int, row: Column, salt: int) -> Column:
    """Uniform integer in [0, 2**32)."""
    block, part = divmod(salt, 4)
    return _slice(_digest(seed, row, block), part)


def with_draws(df: DataFrame, seed: int, row: Column, n: int) -> DataFrame:
    """Adds the draws of salts 0 to ``n - 1`` as columns ``u0``, ``u1``, ...

    As columns they are computed once each, however often an expression refers to them.
    """
    blocks = [f"_digest{i}" for i in range((n + 3) // 4)]
    digests = {name: _digest(seed, row, i) for i, name in enumerate(blocks)}
    slices = {f"u{i}": _slice(F.col(blocks[i // 4]), i % 4) for i in range(n)}
    return df.withColumns(digests).withColumns(slices).drop(*blocks)


def below(u: Column, n: Column | int) -> Column:
    """Integer in [0, n)."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.shiftright(u * n.cast("bigint"), 32)


def fraction(u: Column) -> Column:
    """Double in [0, 1)."""
    return u.cast("double") / F.lit(float(TWO_32))


def uniform_int(u: Column, low: Column | int, high: Column | int) -> Column:
    """Integer in [low, high)."""
    low = F.lit(low).cast("bigint")
    return low + below(u, F.lit(high).cast("bigint") - low)


def pick(u: Column, values: Sequence) -> Column:
    """One of the values, all equally likely."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (below(u, len(values)) + 1).cast("int"))


def weighted(u: Column, choices: Sequence[tuple[str, int]]) -> Column:
    """One of the values with probability proportional to its integer weight."""
    k = below(u, sum(w for _, w in choices))
    case, upto = F, 0
    for value, weight in choices[:-1]:
        upto += weight
        case = case.when(k < upto, F.lit(value))
    return case.otherwise(F.lit(choices[-1][0]))


def triangular(
    u: Column, low: Column | int, high: Column | int, mode: Column | int
) -> Column:
    """Integer part of a triangular variable, by its inverse distribution function."""
    x = fraction(u)
    low, high, mode = (F.lit(v).cast("double") for v in (low, high, mode))
    left = low + F.sqrt(x * ((high - low) * (mode - low)))
    right = high - F.sqrt((1 - x) * ((high - low) * (high - mode)))
    return F.floor(F.when(x < (mode - low) / (high - low), left).otherwise(right))


def _by_behavior(
    behavior: Column, table: dict[str, tuple[int, ...]], default: tuple[int, ...] | None = None
) -> list[Column]:
    """The figures a table has for each behaviour, one column per position.

    Looking figures up by position and computing once keeps the generated code small; a
    formula per branch would outgrow what the JVM compiles. An unknown behaviour has the
    figures of ``default``, or else of the last one.
    """
    last = next(reversed(table.values())) if default is None else default
    names = F.array(*[F.lit(name) for name in table])
    found = F.coalesce(F.array_position(names, behavior), F.lit(0).cast("bigint"))
    position = F.when(found == 0, len(table) + 1).otherwise(found).cast("int")
    return [
        F.element_at(F.array(*[F.lit(v) for v in figures]), position)
        for figures in zip(*table.values(), last)
    ]


def duration_for(behavior: Column, u: Column, ranges=None, default=None) -> Column:
    """Uniform seconds in the behaviour's [low, high) range, ``default`` for unknown ones."""
    ranges = S.BATCH_DURATIONS if ranges is None else ranges
    return uniform_int(u, *_by_behavior(behavior, ranges, default))


def inclusive_duration_for(behavior: Column, u: Column) -> Column:
    """Uniform seconds in the behaviour's [low, high] range."""
    ranges = {b: (lo, hi + 1) for b, (lo, hi) in S.LOG_DURATIONS.items()}
    low, high = S.LOG_DURATION_DEFAULT
    return duration_for(behavior, u, ranges, (low, high + 1))


def triangular_duration_for(behavior: Column, u: Column) -> Column:
    """Triangular seconds with the behaviour's low, high and mode; uniform for unknown ones."""
    known = F.coalesce(behavior.isin(list(S.TRIANGULAR_DURATIONS)), F.lit(False))
    drawn = triangular(u, *_by_behavior(behavior, S.TRIANGULAR_DURATIONS))
    low, high = S.DATASET_DURATION_DEFAULT
    return F.when(known, drawn).otherwise(uniform_int(u, F.lit(low), F.lit(high + 1)))


def gaussian(u1: Column, u2: Column, mean: float, sd: float) -> Column:
    """Normal variable from two draws (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(1 - fraction(u1)))
    return F.lit(mean) + F.lit(sd) * radius * F.cos(F.lit(2 * math.pi) * fraction(u2))


def score(
    behavior: Column,
    u1: Column,
    u2: Column,
    sd: float = 15.0,
    fail_draws: tuple[Column, Column] | None = None,
) -> Column:
    """Mark of a quiz or homework, one decimal in 0..100; null for other behaviours.

    With ``fail_draws`` five percent of the marks are uniform in 40..59 instead.
    """
    mark = gaussian(u1, u2, 75.0, sd)
    if fail_draws is not None:
        failed, low = fail_draws
        mark = F.when(below(failed, 100) < 5, F.lit(40.0) + fraction(low) * 19).otherwise(mark)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), mark))
    rounded = F.floor(clamped * 10 + 0.5).cast("double") / F.lit(10.0)
    return F.when(behavior.isin(S.SCORED_BEHAVIORS), rounded)


def chapter(chapters: Column, week: Column, u: Column) -> Column:
    """Chapter reached in a week of the term, up to two ahead or behind."""
    chapters = chapters.cast("bigint")
    expected = F.least(
        chapters, F.call_function("div", week.cast("bigint") * chapters, F.lit(S.TERM_WEEKS))
    )
    number = F.greatest(F.lit(1), F.least(chapters, expected + below(u, 5) - 2))
    return F.concat(F.lit("CH_"), zero_padded(number, 3))


def campus_ip(u_prefix: Column, u_third: Column, u_fourth: Column) -> Column:
    """Address as the dataset generator writes it: some prefixes give five octets."""
    return F.concat(
        pick(u_prefix, S.CAMPUS_IP_PREFIXES),
        uniform_int(u_third, 1, 255).cast("string"),
        F.lit("."),
        uniform_int(u_fourth, 1, 255).cast("string"),
    )


def private_ip(u_third: Column, u_fourth: Column) -> Column:
    """A ``192.168.x.y`` address."""
    return F.concat(
        F.lit("192.168."),
        uniform_int(u_third, 1, 255).cast("string"),
        F.lit("."),
        uniform_int(u_fourth, 1, 255).cast("string"),
    )
