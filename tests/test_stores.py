"""Entries of several lines, the trigram index, the space-filling order and watched streams."""

import glob
import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from coursepulse.operators import log_entries, log_index, oplog, quality
from coursepulse.sources import clustered, readers, writers
from coursepulse.streaming import ingest, watched
from tests.conftest import as_set, frame, random_log, record

HEAD = "[2024-01-01 10:00:00] [ERROR] [Web] broke"


# --- entries of several lines ---------------------------------------------------------------


def write_lines(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines), encoding="utf-8")


def brute_entries(files):
    found = []
    for lines in files:
        entry = None
        for line in lines:
            if line.startswith("["):
                entry = [line, 0, 0]
                found.append(entry)
            elif entry is None:
                entry = [None, 0, 0]
                found.append(entry)
            entry[1] += 1
            entry[2] += len(line)
    return sorted((repr(e[0] and e[0].split("] ")[-1]), e[1], e[2]) for e in found)


@pytest.mark.parametrize("split", [37, 200, 1 << 20])
def test_entries_cross_splits(spark, tmp_path, split):
    rng = random.Random(5)
    files = []
    for f in range(3):
        lines = [f"  at orphan {i}" for i in range(f * 4)]
        for i in range(30):
            lines.append(f"[2024-01-01 10:00:{i:02d}] [ERROR] [Web] file {f} event {i}")
            lines += ["" if rng.random() < 0.1 else f"\tat é line {j}" for j in range(rng.choice([0, 0, 1, 25]))]
        files.append(lines + ["last"])
        write_lines(tmp_path / "logs", f"{f}.log", files[-1])
    (tmp_path / "logs" / "empty.log").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        grouped = log_entries.group_lines(log_entries.read_oplog(spark, str(tmp_path / "logs")))
        got = log_entries.entries(grouped).collect()
        assert sorted((repr(r.message), r.n_lines, r.n_chars) for r in got) == brute_entries(files)
        blocks = {(r.file, r.block) for r in grouped.select("file", "block").collect()}
        # Small files are split further, to give every core some.
        assert len(blocks) > (20 if split < 1000 else 0)
        heads = sum(line.startswith("[") for lines in files for line in lines)
        rest = log_entries.continuations(grouped)
        assert rest.count() == sum(map(len, files)) - heads
        assert rest.filter("head_at IS NULL").count() == 4 + 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_trace_is_found_with_its_entry(spark, tmp_path):
    write_lines(tmp_path / "logs", "a.log", [HEAD, "  at deep.down", "[t] [INFO] [Web] fine"])
    grouped = log_entries.group_lines(log_entries.read_oplog(spark, str(tmp_path / "logs")))
    found = log_entries.entries(grouped, "deep.down").collect()
    assert [(r.level, r.message, r.n_lines) for r in found] == [("ERROR", "broke", 2)]
    assert log_entries.entries(grouped, "nowhere").count() == 0
    assert log_entries.entries(grouped, "").count() == 2


# --- trigram index --------------------------------------------------------------------------

SPECIAL = [
    "no brackets here", "", "ab", "abc", "über 日本語 🙂🙂🙂 text", "a$1\\d[x", HEAD, HEAD,
    "[2024-01-01 11:00:00] [INFO] [HDFS] block copied", "[not a time] [INFO] [YARN] odd ]",
    "z" * 100_000 + "needle", "aXbcd bcdXa",
]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    rows = [(x,) for x in SPECIAL] + [(None,)]
    raw = spark.createDataFrame([(bytearray(b"good\xffkeyword\xe3\x81end"),)], "b binary")
    lines = spark.createDataFrame(rows, "value string").unionAll(raw.select(F.col("b").cast("string")))
    log_index.write_index(lines, path, by="hour")
    return path, lines.filter("value IS NOT NULL")


@pytest.mark.parametrize(
    "keyword",
    ["bra", "block copied", "日本語", "🙂🙂", "🙂🙂🙂", "$1\\", "needle", "zzz", "keyword", "end", "abcd", "aXbcdXa",
     "bcd bcd", "ab", "a", "", "broke", "nowhere", "good"],
)
def test_index_finds_what_a_scan_finds(spark, indexed, keyword):
    path, lines = indexed
    scan = oplog.search_oplog(oplog.parse_oplog(lines), "all", None, keyword)
    assert as_set(log_index.search_index(spark, path, keyword)) == as_set(scan)


def test_index_reads_candidates_only(spark, indexed):
    path, _ = indexed
    every = log_index.read_lines(spark, path).select("block").distinct().count()
    found = [r.block for r in log_index.candidates(spark, path, "block copied").collect()]
    assert len(found) == 1 < every and found[0].startswith("2024-01-01-11.")
    assert log_index.search_index(spark, path, "block", "hadoop", "INFO").count() == 1
    empty = spark.createDataFrame([], "value string")
    log_index.write_index(empty, path + "/none")
    assert log_index.search_index(spark, path + "/none", "block").count() == 0


# --- space-filling order --------------------------------------------------------------------


def groups_met(path, student):
    """Row groups, and those whose least and greatest student let a filter on one in."""
    total = met = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().names.index("student_id")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            met += stats.min <= student <= stats.max
    return total, met


def test_clustered_log_skips_groups(spark, tmp_path):
    rows = random_log(3000, 31, students=90)
    b = frame(spark, [dict(r, student_id=f"STU_{int(r['student_id'][4:]):04d}") for r in rows])
    by_time, by_both = str(tmp_path / "time"), str(tmp_path / "both")
    b.repartitionByRange(32, "timestamp").sortWithinPartitions("timestamp").write.parquet(by_time)
    clustered.write_clustered(b, by_both, tasks=32)
    assert as_set(clustered.read_clustered(spark, by_both)) == as_set(b)
    student = "STU_0041"
    total, met = groups_met(by_time, student)
    assert met == total
    total, met = groups_met(by_both, student)
    assert total >= 24 and met <= total / 3
    part = clustered.read_clustered(spark, by_both, student, "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    wanted = b.filter(f"student_id = '{student}' AND timestamp >= '2024-01-10' AND timestamp < '2024-01-20'")
    assert as_set(part) == as_set(wanted)
    assert "PushedFilters" in part._jdf.queryExecution().toString()


def test_clustering_odd_rows(spark, tmp_path):
    """Null, malformed, hot and repeated values; an empty log."""
    hot = [record(i, student="STU_1") for i in range(40)] + [record(1, student="STU_1")]
    odd = [record(90, student=None), record(91, ts=None), record(92, ts="garbage"), record(93, student="")]
    for name, rows in (("odd", hot + odd), ("none", [])):
        b = frame(spark, rows)
        path = str(tmp_path / name)
        clustered.write_clustered(b, path)
        assert as_set(clustered.read_clustered(spark, path)) == as_set(b)


def test_buckets_and_order(spark):
    bounds = [3, 5, 9]
    values = spark.range(12).select("id", clustered.bucket_of(F.col("id"), bounds).alias("n"))
    assert [r.n for r in values.orderBy("id").collect()] == [sum(b <= i for b in bounds) for i in range(12)]
    cells = spark.range(64).select(clustered.interleave(F.expr("int(id) % 8"), F.expr("int(id div 8)"), 3).alias("z"))
    assert sorted(r.z for r in cells.collect()) == list(range(64))


# --- watched streams ------------------------------------------------------------------------


def test_watched_stream_sums_to_the_report(spark, tmp_path):
    landing, out, counts, ck = (str(tmp_path / d) for d in ("landing", "out", "counts", "ck"))
    rows = random_log(60, 41) + [record(70, student=None), record(71, ip_address="x"), record(72, ts="never")]
    for part in (rows[:30], rows[30:]):
        writers.write_json(frame(spark, part).coalesce(1), landing, mode="append")
    with open(f"{landing}/broken.json", "w") as f:
        f.write("{broken\n" + json.dumps(rows[0]) + "\n")
    meta = ("ingest_time", "filename", "basename")
    stream = ingest.stream_logs(spark, landing, max_files=1).drop(*meta)
    watched.watch_stream(stream, out, counts, ck).awaitTermination()
    report = quality.quality_report(readers.read_json_logs(spark, landing))
    assert as_set(watched.stream_report(spark, counts)) == as_set(report)
    assert watched.batch_report(spark, counts).select("batch_id").distinct().count() == 3
    assert spark.read.parquet(out).count() == len(rows) + 2


def test_a_repeated_watched_batch_counts_once(spark, tmp_path):
    out, counts = str(tmp_path / "out"), str(tmp_path / "counts")
    b = frame(spark, random_log(20, 42) + [record(50, ip_address="x")])
    rules = {"a rule, with (marks)": F.col("ip_address") == "x", "rows": F.lit(True)}
    for batch_id in (0, 1, 1, 0):
        watched.write_watched(b, batch_id, out, counts, rules)
    found = {r.rule: (r.violations, r.rows) for r in watched.stream_report(spark, counts).collect()}
    assert found == {"a rule, with (marks)": (2, 42), "rows": (42, 42)}
    watched.write_watched(b.limit(0), 2, out, counts, rules)
    assert watched.batch_report(spark, counts).filter("batch_id = 2 AND rows = 0").count() == 2
    assert spark.read.parquet(out).count() == 42
