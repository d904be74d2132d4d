"""Operational log text: parsing, search, newest lines, and counts of a running job."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from coursepulse import schema as S

# Fixed value: the form of a log line, [time] [level] [module] message.
LINE = r"\[([^\]]+)\]\s*\[([^\]]+)\]\s*\[([^\]]+)\]\s*(.*)"


def parse_oplog(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Time, level, module and message of each line; a line of another form is all message.

    Columns named in ``keep`` stay in front.
    """
    line = F.col("value")
    # One run of the pattern: its groups between marks, split at them.
    marked = F.regexp_replace(line, LINE, "\u0001$1\u0001$2\u0001$3\u0001$4\u0001")
    plain = F.array(line)
    parts = F.when(F.contains(line, F.lit("\u0001")), _groups(line)).otherwise(F.split(marked, "\u0001", 7))
    split = lines.select(*keep, line.alias("line"), F.explode(F.array(F.coalesce(parts, plain))).alias("_parts"))
    found = F.size("_parts") > 1
    fields = {n: F.when(found, F.get("_parts", i)) for i, n in enumerate(["ts", "level", "module"], start=1)}
    message = F.when(found, F.get("_parts", 4)).otherwise(F.col("line"))
    return split.select(*keep, "line", *[c.alias(n) for n, c in fields.items()], message.alias("message"))


def _groups(line: Column) -> Column:
    """The same of a line that holds the mark itself: a run for each group."""
    groups = [F.regexp_extract(line, LINE, i) for i in range(1, 5)]
    return F.when(line.rlike(LINE), F.array(F.lit(""), *groups))


def search_oplog(
    parsed: DataFrame, component: str = "all", level: str | None = None, keyword: str | None = None
) -> DataFrame:
    """Lines of a component, a level and containing a keyword."""
    found = parsed
    if component != "all":
        if component not in S.LOG_COMPONENTS:
            raise ValueError(f"unknown component {component!r}: all, {', '.join(S.LOG_COMPONENTS)}")
        found = found.filter(F.col("module").isin(S.LOG_COMPONENTS[component]))
    if level:
        found = found.filter(F.col("level") == level)
    if keyword:
        found = found.filter(F.contains("line", F.lit(keyword)))
    return found


def latest(parsed: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` lines."""
    return parsed.orderBy(F.desc("ts"), F.desc("line")).limit(n)


@dataclass(frozen=True)
class JobReport:
    """What one run of a job did."""

    name: str
    records: int
    seconds: float
    status: str
    error: str | None = None


class JobFailed(RuntimeError):
    """A job that was reported and then given up; the failure itself is the cause."""

    def __init__(self, report: JobReport) -> None:
        super().__init__(f"{report.name}: {report.error}")
        self.report = report


def observe_job(df: DataFrame, name: str, run: Callable[[DataFrame], None]) -> JobReport:
    """Run ``run(df)`` and report rows, elapsed time and status; a failure is raised with it.

    The rows are counted while they pass through the job, not in a scan of their own.
    """
    seen = Observation(name)
    start = time.monotonic()
    try:
        run(df.observe(seen, F.count(F.lit(1)).alias("records")))
    except Exception as failure:
        report = JobReport(name, 0, time.monotonic() - start, "failed", str(failure))
        raise JobFailed(report) from failure
    return JobReport(name, seen.get["records"], time.monotonic() - start, "succeeded")
