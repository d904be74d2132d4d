import pytest

from coursepulse.operators import oplog
from coursepulse.sources import writers
from tests.conftest import frame, random_log

LINES = [
    "[2024-01-01 10:00:00] [INFO] [HDFS] block copied",
    "[2024-01-01 10:00:02] [WARN] [YARN] slow [node 3]",
    "[2024-01-01 10:00:01] [INFO] [Web] started",
    "no brackets here",
]


def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_parse(spark):
    parsed = {r.line: r for r in oplog.parse_oplog(lines(spark)).collect()}
    r = parsed[LINES[1]]
    assert (r.ts, r.level, r.module, r.message) == (
        "2024-01-01 10:00:02", "WARN", "YARN", "slow [node 3]"
    )
    r = parsed[LINES[3]]
    assert (r.ts, r.level, r.module, r.message) == (None, None, None, LINES[3])


def test_search_and_latest(spark):
    parsed = oplog.parse_oplog(lines(spark))

    def found(*args):
        return sorted(r.line for r in oplog.search_oplog(parsed, *args).collect())

    assert found() == sorted(LINES)
    assert found("hadoop") == sorted(LINES[:2])
    assert found("hadoop", "INFO") == [LINES[0]]
    assert found("all", None, "start") == [LINES[2]]
    newest = [r.line for r in oplog.latest(parsed, 2).collect()]
    assert newest == [LINES[1], LINES[2]]


def test_observed_job(spark, tmp_path):
    b = frame(spark, random_log(25, 1))
    path = str(tmp_path / "out")
    report = oplog.observe_job(b, "land", lambda df: writers.write_json(df, path))
    assert (report.name, report.records, report.status) == ("land", 25, "succeeded")
    assert report.seconds > 0

    def fail(df):
        raise RuntimeError("disk gone")

    with pytest.raises(oplog.JobFailed, match="disk gone") as raised:
        oplog.observe_job(b, "land", fail)
    report = raised.value.report
    assert (report.records, report.status, report.error) == (0, "failed", "disk gone")
    with pytest.raises(ValueError, match="unknown component"):
        oplog.search_oplog(oplog.parse_oplog(b.selectExpr("student_id AS value")), "moon")
