import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from coursepulse import schema as S
from coursepulse.operators import quality
from coursepulse.plans.results import six_results
from coursepulse.sources import readers, writers
from tests.conftest import as_set, frame, plan_of, random_log, record, rows_of


def test_mixed_folder_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    b = frame(spark, random_log(60, 1))
    writers.write_partitioned(b.limit(30), path)
    writers.write_json(b, path, mode="append")
    logs = readers.read_json_logs(spark, path)
    assert logs.count() == 90
    assert readers.quarantine(logs).isEmpty()


def test_both_record_forms_in_one_folder(spark, tmp_path):
    b = frame(spark, random_log(20, 2))
    path = str(tmp_path / "raw")
    writers.write_json(b.select(*S.B8_COLUMNS), path)
    writers.write_json(b.select(*S.B11.fieldNames()), path, mode="append")
    logs = readers.good_records(readers.read_json_logs(spark, path))
    assert logs.columns == S.LOG.fieldNames()
    assert logs.filter("record_id is null").count() == 20
    assert logs.filter("device_type is null").count() == 20


def test_broken_lines_are_kept_aside(spark, tmp_path):
    lines = [json.dumps(record(1), ensure_ascii=False), "{broken", '{"duration": "x"}']
    (tmp_path / "a.json").write_text("\n".join(lines), encoding="utf-8")
    logs = readers.read_json_logs(spark, str(tmp_path))
    assert [r.record_id for r in readers.good_records(logs).collect()] == ["r000001"]
    assert {r[0] for r in readers.quarantine(logs).collect()} == set(lines[1:])
    # Whether a line is a record must not depend on the columns a query reads.
    assert readers.good_records(logs).select("student_id").count() == 1
    assert readers.good_records(logs).count() == 1
    assert plan_of(readers.good_records(logs)).count("from_json") == 1


def test_csv_with_byte_order_mark_and_empty_score(spark, tmp_path):
    columns = S.B11.fieldNames()
    text = ",".join(columns) + "\nSTU_1,张三,COURSE_001,数据库原理,quiz_complete,60," \
        "2024-01-10 08:00:00,192.168.1.2,PC,CH_001,\n"
    (tmp_path / "a.csv").write_text(text, encoding="utf-8-sig")
    row = readers.read_csv_logs(spark, str(tmp_path), S.B11).first()
    assert (row.student_id, row.student_name, row.duration, row.score) == (
        "STU_1", "张三", 60, None
    )


def test_csv_lines_and_counts(spark, tmp_path):
    path = str(tmp_path / "csv")
    b = frame(spark, random_log(50, 3))
    writers.write_logs(b, path, "CSV")
    logs = readers.good_records(readers.read_csv_logs(spark, path, S.LOG))
    assert as_set(logs) == as_set(b)
    counts = quality.csv_line_counts(spark, path).first()
    assert counts.records == 50 and counts.lines == 50 + counts.files
    files = glob.glob(f"{path}/*.csv")
    assert sum(len(open(f, encoding="utf-8").readlines()) for f in files) == counts.lines
    same = quality.compare_counts(b, readers.read_csv_logs(spark, path, S.LOG)).first()
    assert same["equal"] and same.rows_after == 50


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        writers.write_logs(frame(spark, []), str(tmp_path / "x"), "xml")


def test_dated_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = random_log(80, 4) + [record(900, ts="garbage")]
    writers.write_partitioned(frame(spark, rows), path)
    assert os.path.isdir(f"{path}/year=2024/month=01")
    days = glob.glob(f"{path}/year=2024/month=01/day=0*")
    assert days and all(len(os.path.basename(d)) == len("day=01") for d in days)
    part = readers.read_partitioned_logs(spark, path, "2024-01-05", "2024-01-09")
    expected = {r["record_id"] for r in rows if "2024-01-05" <= r["timestamp"][:10] <= "2024-01-09"}
    assert {r.record_id for r in part.collect()} == expected
    filters = plan_of(part).split("PartitionFilters: [")[1].split("]")[0]
    assert "make_date" in filters
    assert readers.read_partitioned_logs(spark, path).count() == 81


def test_a_day_is_not_scattered_over_files(spark, tmp_path):
    path = str(tmp_path / "dated")
    b = frame(spark, random_log(300, 5)).repartition(8)
    writers.write_partitioned(b, path)
    assert all(len(glob.glob(f"{day}/*.json")) == 1
               for day in glob.glob(f"{path}/year=*/month=*/day=*"))


def test_overwrite_and_append(spark, tmp_path):
    path = str(tmp_path / "json")
    b = frame(spark, random_log(10, 6))
    for mode, rows in [("overwrite", 10), ("append", 20), ("overwrite", 10)]:
        writers.write_json(b, path, mode)
        assert spark.read.text(path).count() == rows


def test_bundle(spark, tmp_path):
    results = six_results(frame(spark, random_log(100, 7, students=40)), "2024-01-31 00:00:00")
    path = str(tmp_path / "bundle")
    writers.write_bundle(results, path)
    assert sorted(os.listdir(path)) == sorted(results)
    for name, df in writers.read_bundle(spark, path, results).items():
        assert as_set(df) == as_set(results[name])
    lines = writers.bundle(results).collect()
    assert {r.result for r in lines} == set(results)
    summary = next(json.loads(r.row) for r in lines if r.result == "summary")
    assert summary["total_behaviors"] == 100


def test_batches_held_by_the_caller(spark):
    rows = [tuple(record(i)[c] for c in S.B8_COLUMNS) for i in range(3)]
    assert readers.batch_frame(spark, rows).schema == S.B8
    with pytest.raises(Exception):
        readers.batch_frame(spark, [(None, *rows[0][1:])])
    bad = frame(spark, [record(1, student=None)])
    with pytest.raises(Exception, match="student_id must not be null"):
        readers.conform(bad).collect()
    assert readers.conform(frame(spark, [record(1)])).columns == S.B8_COLUMNS


def test_dimension_index_is_dense(spark):
    d = readers.dim(spark, [("a", 1), ("b", 2)], "name string, size int")
    assert rows_of(d) == [(0, "a", 1), (1, "b", 2)]
    joined = spark.range(3).join(d, F.col("id") == d["idx"], "left")
    assert sorted((r.id, r.name) for r in joined.collect()) == [(0, "a"), (1, "b"), (2, None)]


def test_mandatory_fields_are_checked_whatever_is_read(spark):
    bad = readers.conform(frame(spark, [record(1, student=None)]))
    for action in (bad.count, bad.select("duration").collect):
        with pytest.raises(Exception, match="student_id must not be null"):
            action()


def test_mixed_folder_is_read_in_full(spark, tmp_path):
    path = str(tmp_path / "mixed")
    writers.write_partitioned(frame(spark, random_log(100, 1)), path)
    writers.write_json(frame(spark, random_log(50, 2)), path, mode="append")
    logs = readers.read_partitioned_logs(spark, path)
    assert logs.count() == 150 and logs.filter("year IS NULL").count() == 50


def test_csv_header_and_malformed_rows(spark, tmp_path):
    columns = S.B11.fieldNames()
    good = "STU_1,A,COURSE_001,B,quiz_complete,60,2024-01-10 08:00:00,192.168.1.2,PC,CH_001,1.5"
    bad = good.replace(",60,", ",sixty,")
    (tmp_path / "a.csv").write_text("\n".join([",".join(columns), good, bad]) + "\n")
    logs = readers.read_csv_logs(spark, str(tmp_path), S.B11)
    assert readers.good_records(logs).count() == 1
    assert [r.line for r in readers.quarantine(logs).collect()] == [bad]
    other = tmp_path / "other"
    other.mkdir()
    (other / "b.csv").write_text(",".join(reversed(columns)) + "\n" + good + "\n")
    with pytest.raises(Exception):
        readers.read_csv_logs(spark, str(other), S.B11).collect()
