import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from coursepulse import schema as S
from coursepulse.operators import cleaning, metrics
from coursepulse.plans.results import BATCH, REALTIME, six_results
from coursepulse.plans.rollup import rollup
from coursepulse.sources import readers, writers
from coursepulse.streaming import ingest, running
from tests.conftest import as_set, frame, random_log, record, rows_of

AS_OF = "2024-01-31 00:00:00"


def land(spark, rows, path, files):
    for i in range(files):
        writers.write_json(frame(spark, rows[i::files]).coalesce(1), path, mode="append")


def same_results(left, right):
    return all(rows_of(left[n]) == rows_of(right[n]) for n in right)


@pytest.mark.parametrize("files", [1, 2, 5])
def test_running_results_equal_the_batch(spark, tmp_path, files):
    landing, fact, ck = (str(tmp_path / d) for d in ("landing", "fact", "ck"))
    rows = random_log(200, files)
    land(spark, rows, landing, files)
    stream = ingest.stream_logs(spark, landing, max_files=1)
    running.running_fact(stream, fact, ck).awaitTermination()
    assert len(glob.glob(f"{fact}/batch_id=*")) == files
    b = frame(spark, rows)
    for preset in (REALTIME, BATCH):
        assert same_results(
            running.snapshot_results(spark, fact, AS_OF, preset), six_results(b, AS_OF, preset)
        )


def test_a_retried_batch_counts_once(spark, tmp_path):
    fact = str(tmp_path / "fact")
    rows = random_log(90, 8)
    parts = [frame(spark, rows[i::3]) for i in range(3)]
    for i in (0, 1, 1, 2, 0):
        running.write_batch(parts[i], i, fact)
    whole = as_set(metrics.student_hours(frame(spark, rows)))
    assert as_set(metrics.student_hours(running.snapshot(spark, fact))) == whole


def test_compaction_changes_no_result(spark, tmp_path):
    fact, small = str(tmp_path / "fact"), str(tmp_path / "compacted")
    rows = random_log(120, 9)
    assert running.compact(spark, fact, small) is None
    for i in range(2):
        running.write_batch(frame(spark, rows[i::4]), i, fact)
    upto = running.compact(spark, fact, small)
    assert upto == 1 and running.compact(spark, fact, small, upto) == 1
    for i in range(2, 4):
        running.write_batch(frame(spark, rows[i::4]), i, fact)
    whole = as_set(metrics.student_hours(frame(spark, rows)))
    now = running.snapshot(spark, fact, small, upto)
    assert as_set(metrics.student_hours(now)) == whole
    upto = running.compact(spark, fact, small, upto)
    now = running.snapshot(spark, fact, small, upto)
    assert upto == 3 and as_set(metrics.student_hours(now)) == whole
    assert now.count() == rollup(frame(spark, rows)).count()


def test_snapshot_before_the_first_batch(spark, tmp_path):
    results = running.snapshot_results(spark, str(tmp_path / "none"), AS_OF)
    assert results["summary"].first().total_behaviors == 0


def test_refresh_reads_new_files_only(spark, tmp_path):
    landing, fact, ck = (str(tmp_path / d) for d in ("landing", "fact", "ck"))
    rows = random_log(150, 10)
    for upto in (50, 100, 150):
        land(spark, rows[upto - 50:upto], landing, 1)
        results = running.incremental_refresh(spark, landing, fact, ck, AS_OF, BATCH)
        assert same_results(results, six_results(frame(spark, rows[:upto]), AS_OF, BATCH))
        assert running.snapshot(spark, fact).select("batch_id").distinct().count() == upto // 50


def test_lines_that_are_no_records_are_not_counted_but_kept(spark, tmp_path):
    landing, fact, ck, bad = (str(tmp_path / d) for d in ("landing", "fact", "ck", "bad"))
    rows = random_log(30, 16)
    land(spark, rows, landing, 1)
    (tmp_path / "landing" / "more.json").write_text("{broken\nnoise\n", encoding="utf-8")
    results = running.incremental_refresh(
        spark, landing, fact, ck, AS_OF, BATCH, quarantine_path=bad
    )
    assert same_results(results, six_results(frame(spark, rows), AS_OF, BATCH))
    kept = spark.read.schema("line string, batch_id bigint").json(bad)
    assert sorted(rows_of(kept)) == [("noise", 0), ("{broken", 0)]


def test_a_batch_can_be_cleaned_first(spark, tmp_path):
    landing, fact, ck = (str(tmp_path / d) for d in ("landing", "fact", "ck"))
    rows = random_log(50, 11)
    rows += [dict(r, record_id="x" + r["record_id"]) for r in rows] + [record(900, student=None)]
    land(spark, rows, landing, 1)
    stream = readers.good_records(ingest.stream_logs(spark, landing))
    running.running_fact(stream, fact, ck, prepare=cleaning.dwd).awaitTermination()
    assert metrics.row_count(running.snapshot(spark, fact)).first()[0] == 50


def test_repeated_keys_across_batches(spark, tmp_path):
    landing, out, ck = (str(tmp_path / d) for d in ("landing", "out", "ck"))
    rows = random_log(40, 12)
    land(spark, rows, landing, 1)
    land(spark, [dict(r, record_id="x" + r["record_id"]) for r in rows], landing, 1)
    stream = readers.good_records(ingest.stream_logs(spark, landing, max_files=1))
    query = (
        ingest.dedup_stream(stream, "40 days").writeStream.format("parquet")
        .option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 40


def test_finished_files_move_to_the_archive(spark, tmp_path):
    landing, archive, out, ck = (str(tmp_path / d) for d in ("landing", "done", "out", "ck"))
    for i in range(3):
        land(spark, random_log(10, i), landing, 1)
        stream = readers.good_records(ingest.stream_logs(spark, landing, archive=archive))
        stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(
            availableNow=True
        ).start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 30
    assert glob.glob(f"{archive}/**/*.json", recursive=True)


@pytest.mark.parametrize("by", ["ingest", "event"])
def test_landing_in_dated_folders(spark, tmp_path, by):
    landing, out, ck = (str(tmp_path / d) for d in ("landing", "out", "ck"))
    rows = random_log(40, 13)
    land(spark, rows, landing, 2)
    stream = ingest.stream_logs(spark, landing, max_files=1)
    with open(f"{landing}/broken.json", "w") as broken:
        broken.write("this is no record\n")
    ingest.land_stream(stream, out, ck, by).awaitTermination()
    logs = readers.read_partitioned_logs(spark, out)
    assert logs.count() == 40 and not os.path.exists(f"{out}/_spark_metadata")
    aside = spark.read.json(f"{out}/_quarantine")
    assert [r.line for r in aside.collect()] == ["this is no record"]
    # A retried batch replaces its files; a batch job may append.
    files = sorted(glob.glob(f"{out}/year=*/**/*.json", recursive=True))
    assert files and all("batch-" in f for f in files)
    writers.write_partitioned(frame(spark, random_log(10, 14)), str(tmp_path / "copy"))
    writers.write_partitioned(frame(spark, random_log(10, 14)), out)
    assert readers.read_partitioned_logs(spark, out).count() == 50
    days = {(r.year, r.month, r.day) for r in logs.select("year", "month", "day").collect()}
    if by == "event":
        assert days == {(2024, 1, int(r["timestamp"][8:10])) for r in rows}
    else:
        assert len(days) <= 2
    text = open(files[0], encoding="utf-8").readline()
    assert {"ingest_time", "filename", "basename"} <= set(json.loads(text))
    with pytest.raises(ValueError):
        ingest.land_stream(stream, out, ck, "moon")


def test_ingest_time_is_the_wall_clock_of_its_zone(spark, tmp_path):
    path = str(tmp_path / "json")
    land(spark, random_log(3, 14), path, 1)
    lines = spark.read.text(path)
    zone = spark.conf.get("spark.sql.session.timeZone")
    gaps = []
    for session_zone in ("UTC", "America/New_York"):
        try:
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            utc = F.convert_timezone(
                F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
            )
            gap = F.timestamp_diff("SECOND", utc, F.col("ingest_time"))
            gaps.append(ingest.with_ingest_meta(lines).select(gap).first()[0])
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    assert gaps == [8 * 3600, 8 * 3600]


def test_lines_that_are_no_records(spark, tmp_path):
    good = json.dumps(record(1), ensure_ascii=False).encode()
    record_2 = json.dumps(record(2, name="长" * 11_000), ensure_ascii=False)
    long = "noise " + "长" * 1000
    broken = good.replace(b'"Ann"', b'"An\xff\xfen"')
    (tmp_path / "a.log").write_bytes(b"\n".join([good, broken, b"noise", long.encode(), record_2.encode()]))
    lines = spark.read.text(str(tmp_path))
    parsed = ingest.parse_lines(lines, max_len=400)
    read = readers.good_records(parsed).collect()
    assert sorted((r.record_id, r.student_name) for r in read) == [
        ("r000001", "Ann"), ("r000001", "Ann"), ("r000002", "长" * 11_000)
    ]
    aside = [r[0] for r in readers.quarantine(parsed).collect()]
    assert "noise" in aside
    pieces = [p for p in aside if p != "noise"]
    assert all(len(p) <= 400 for p in pieces)
    assert sum(len(p) for p in pieces) == len(long)
    whole = ingest.parse_lines(lines)
    assert readers.good_records(whole).filter("record_id = 'r000002'").count() == 1
    assert {r[0] for r in readers.quarantine(whole).collect()} == {"noise", long}


def test_append_batches(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = random_log(30, 15)
    done = ingest.append_batches(lambda i: frame(spark, rows[10 * i:10 * i + 10]), path, 3)
    assert done == 3 and readers.read_json_logs(spark, path).count() == 30
    assert not os.path.exists(str(tmp_path / "other"))
    shutil.rmtree(path)
