"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs twice and the better time counts. ``six_scans`` takes the six results
from a JSON landing folder with a scan each, ``six_rollup`` builds the rollup from the same
folder in one scan and takes the results from it.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from coursepulse import catalog, fixtures
from coursepulse.plans.results import six_results
from coursepulse.plans.rollup import stored_rollup
from coursepulse.session import local_session, scratch_path, scratch_scope
from coursepulse.sources import readers, writers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2
QUERIES = [
    "summary",
    "student_ranking",
    "course_popularity",
    "behavior_distribution",
    "time_distribution",
    "low_engagement",
    "low_engagement_realtime",
    "student_profile",
    "student_avg_score",
    "inactive_level",
    "reconcile_duration",
    "rank_courses",
    "dwd",
    "extra_keys",
    "quality_report",
    "write_partitioned",
    "incremental_refresh",
    "synth_b8",
    "compact",
    "parse_oplog",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action: Callable[[], None]) -> float:
    times = []
    for _ in range(RUNS):
        start = time.monotonic()
        action()
        times.append(time.monotonic() - start)
    return round(min(times), 3)


def main() -> None:
    spark = local_session(CPUS, "bench")
    landing = scratch_path(spark, "bench")
    log = fixtures.behavior(spark, SF_DIR)
    # In as many files as there are cores, as a landing folder would have.
    writers.write_json(log.repartition(int(CPUS)), landing)

    def all_results(of: Callable[[DataFrame], DataFrame]) -> None:
        source = of(readers.good_records(readers.read_json_logs(spark, landing)))
        for df in six_results(source, catalog.AS_OF, roster_size=catalog.ROSTER).values():
            df.collect()

    queries = {
        "six_scans": best(lambda: all_results(lambda b: b)),
        "six_rollup": best(lambda: all_results(stored_rollup)),
    }
    for name in QUERIES:
        with scratch_scope(spark):
            queries[name] = best(lambda: run(catalog.QUERIES[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
