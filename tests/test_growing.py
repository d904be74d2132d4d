"""What grows batch by batch: unknown fields, landed folders, key stores, bitmaps, hash trees."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from coursepulse import schema as S
from coursepulse.operators import cleaning, layer_tree, metrics
from coursepulse.sources import extra, readers, writers
from coursepulse.streaming import distinct, ingest, roll, seen
from tests.conftest import as_set, frame, plan_of, random_log, record, rows_of

def day():
    return F.to_date(F.substring("timestamp", 1, 10))


# --- unknown fields -------------------------------------------------------------------------

LINES = [
    dict(record(1), seat=7, big=2**60, half=1.5, flags=[True, None, {"a": "ü\n\"x\""}], none=None),
    dict(record(2), **{"": "empty name", "a b": {"c": [1, 2]}}),
    {"only": "unknown"},
    record(3),
]


def test_unknown_fields_survive_landing(spark, tmp_path):
    landing, out, ck = (str(tmp_path / d) for d in ("landing", "out", "ck"))
    os.makedirs(landing)
    with open(f"{landing}/a.json", "w", encoding="utf-8") as f:
        f.write("\n".join([*(json.dumps(x, ensure_ascii=False) for x in LINES), "{broken", "[1]"]))
    logs = readers.read_json_logs(spark, landing, extra=True)
    plain = readers.read_json_logs(spark, landing)
    assert as_set(logs.drop(extra.EXTRA)) == as_set(plain)
    stream = ingest.stream_logs(spark, landing, extra=True)
    ingest.land_stream(stream, out, ck).awaitTermination()
    again = readers.good_records(readers.read_partitioned_logs(spark, out, extra=True))
    names = ("seat", "big", "half", "flags", "none", "", "a b", "only")
    values = lambda df: as_set(
        readers.good_records(df).select("record_id", *(F.to_json(F.col(extra.EXTRA)[n]).alias(f"x{i}") for i, n in enumerate(names)))
    ) if S.CORRUPT in df.columns else as_set(
        df.select("record_id", *(F.to_json(F.col(extra.EXTRA)[n]).alias(f"x{i}") for i, n in enumerate(names)))
    )
    assert values(again) == values(logs)
    row = again.filter("record_id = 'r000001'").select(
        extra.field("big", "$", "bigint").alias("big"),
        extra.field("flags", "$[2].a", "string").alias("a"),
        extra.field("flags", "$[2].b", "string").alias("b"),
        extra.field("seat", "$.x", "int").alias("x"),
    ).first()
    assert tuple(row) == (2**60, "ü\n\"x\"", None, None)


# --- landing and rolling --------------------------------------------------------------------


def test_a_repeated_batch_gives_the_same_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = random_log(60, 21)
    for batch_id, part in ((0, rows[:20]), (1, rows[20:40]), (1, rows[20:40]), (2, rows[40:]), (0, rows[:20])):
        writers.write_batch(frame(spark, part), out, batch_id, day())
    assert as_set(readers.good_records(readers.read_partitioned_logs(spark, out)).select("record_id")) == as_set(
        frame(spark, rows).select("record_id")
    )
    # A killed attempt leaves an uncommitted folder, which no reader sees.
    staged = f"{out}/.spark-staging-1/year=2024/month=01/day=01/batch=batch-000000000003"
    os.makedirs(staged)
    with open(f"{staged}/part-0.json", "w") as f:
        f.write(json.dumps(rows[0]))
    assert readers.read_partitioned_logs(spark, out).count() == 60
    part = readers.read_partitioned_logs(spark, out, "2024-01-05", "2024-01-09")
    assert part.count() == sum("2024-01-05" <= r["timestamp"][:10] <= "2024-01-09" for r in rows)
    assert "make_date" in plan_of(part).split("PartitionFilters: [")[1].split("]")[0]


def small_batches(spark, path, rows, batches, first=0):
    """As a stream would leave them, written by hand to be quick: a file for each batch and day."""
    for i in range(batches):
        by_day = {}
        for r in rows[i::batches]:
            by_day.setdefault(r["timestamp"][8:10], []).append(json.dumps(r, ensure_ascii=False))
        for day, lines in by_day.items():
            folder = f"{path}/year=2024/month=01/day={day}/batch={writers.batch_name(first + i)}"
            os.makedirs(folder)
            with open(f"{folder}/part-0.json", "w", encoding="utf-8") as f:
                f.write("\n".join(lines) + "\n")


def test_many_small_files_become_few(spark, tmp_path):
    path, rolled = str(tmp_path / "landed"), str(tmp_path / "rolled")
    rows = random_log(1600, 22)
    for r in rows:
        r["timestamp"] = f"2024-01-0{1 + int(r['record_id'][1:]) % 3}{r['timestamp'][10:]}"
    small_batches(spark, path, rows[:1200], 400)
    before = glob.glob(f"{path}/**/part-*", recursive=True)
    total, bound = sum(map(os.path.getsize, before)), 16 << 10
    ids = lambda upto: sorted(r.record_id for r in roll.read_rolled(spark, path, rolled, upto).collect())
    every = lambda n: sorted(r["record_id"] for r in rows[:n])
    assert len(before) >= 1000 and ids(None) == every(1200)
    upto = roll.roll(spark, path, rolled, bound=bound)
    assert upto == 399 and ids(None) == ids(upto) == every(1200)
    after = glob.glob(f"{rolled}/**/part-*", recursive=True)
    assert len(after) <= 4 * total // bound + 3 and max(map(os.path.getsize, after)) <= bound
    roll.drop_rolled(spark, path, upto)
    assert ids(upto) == every(1200) and not glob.glob(f"{path}/**/part-*", recursive=True)
    # What lands later is read beside the roll; an interrupted roll does not count, nor do batch files get lost.
    small_batches(spark, path, rows[1200:1400], 5, first=400)
    assert ids(upto) == every(1400)
    stale = f"{rolled}/roll=402/year=2024/month=01/day=01/bin=s0-0"
    os.makedirs(stale)
    with open(f"{stale}/part-0.txt", "w") as f:
        f.write(json.dumps(rows[0]))
    assert ids(upto) == every(1400)
    again = roll.roll(spark, path, rolled, upto, bound)
    assert again == 404 and ids(again) == every(1400) and roll.roll(spark, path, rolled, again) == again
    writers.write_partitioned(frame(spark, rows[1400:]), path)
    assert ids(again) == every(1600)
    roll.drop_rolled(spark, path, again)
    assert ids(again) == every(1600)


def test_a_file_above_the_bound_is_split(spark, tmp_path):
    path, rolled = str(tmp_path / "landed"), str(tmp_path / "rolled")
    rows = [record(i) for i in range(400)]
    small_batches(spark, path, rows, 1)
    bound = 40000
    assert os.path.getsize(glob.glob(f"{path}/**/part-*", recursive=True)[0]) > 2 * bound
    upto = roll.roll(spark, path, rolled, bound=bound)
    assert max(map(os.path.getsize, glob.glob(f"{rolled}/**/part-*", recursive=True))) <= bound
    assert roll.read_rolled(spark, path, rolled, upto).count() == 400
    assert roll.roll(spark, str(tmp_path / "none"), rolled, None) is None


# --- keys seen before -----------------------------------------------------------------------


def test_three_batches_are_deduplicated_like_their_union(spark, tmp_path):
    store, path = str(tmp_path / "store"), str(tmp_path / "unique")
    rows = random_log(90, 23)
    rows += [dict(r, record_id=f"s{r['record_id'][1:]}") for r in rows[::2]]
    rows += [record(900 + i, student=None, ts=None) for i in range(3)]
    rows.sort(key=lambda r: r["record_id"])
    parts = [rows[:50], rows[50:100], rows[100:]]
    for i in (0, 1, 1, 2, 0, 2):
        seen.dedup_batch(frame(spark, parts[i]), i, store, path, buckets=8)
    got = spark.read.parquet(path).drop("batch_id")
    want = cleaning.dedup(frame(spark, rows))
    assert as_set(got.select(*want.columns)) == as_set(want)
    assert len(glob.glob(f"{store}/bucket=*")) == 8
    # A batch reads the buckets of its own keys only.
    one = seen.unseen(frame(spark, [record(1)]), 9, store, buckets=8)
    filters = [x.split("PushedFilters")[0] for x in plan_of(one).split("PartitionFilters: [")[1:]]
    assert any("bucket" in x and "batch_id" in x for x in filters)


# --- distinct counts ------------------------------------------------------------------------


def test_bitmaps_count_like_the_log(spark, tmp_path):
    path, numbers = str(tmp_path / "bits"), str(tmp_path / "numbers")
    rows = random_log(300, 24, students=60) + [record(999, student=None), record(998, course=None)]
    parts = [rows[i::3] for i in range(3)]
    for i in (0, 1, 1, 2, 2):
        distinct.add_batch(frame(spark, parts[i]), i, path, numbers)
    fact, log = distinct.merged(spark, path), frame(spark, rows)
    assert rows_of(distinct.summary(fact)) == rows_of(metrics.summary(log))
    assert rows_of(distinct.course_popularity(fact)) == rows_of(metrics.course_popularity(log))
    found = spark.read.parquet(numbers)
    assert sorted(r.number for r in found.collect()) == list(range(1, 1 + len({r["student_id"] for r in rows} - {None})))
    empty = distinct.merged(spark, str(tmp_path / "none"))
    assert distinct.summary(empty).first().total_students == 0


# --- hash trees -----------------------------------------------------------------------------


def test_only_unequal_buckets_are_read(spark, tmp_path):
    left, right = str(tmp_path / "left"), str(tmp_path / "right")
    rows = random_log(400, 25) + [record(900, ts="garbage"), record(901, student=None)]
    gone = {rows[5]["record_id"], rows[77]["record_id"], "r000900"}
    layer_tree.write_layer(frame(spark, rows + rows[:9]), left, 4)
    layer_tree.write_layer(frame(spark, [r for r in rows if r["record_id"] not in gone]), right, 4)
    want = as_set(cleaning.extra_keys(frame(spark, rows), frame(spark, [r for r in rows if r["record_id"] not in gone])))
    differ = {r.node for r in layer_tree.unequal_buckets(spark, left, right).collect()}
    assert 1 <= len(differ) <= 3 and want
    for root in (left, right):
        for file in glob.glob(f"{root}/keys/node=*/*.parquet"):
            if file.split("/")[-2].split("=")[1] not in differ:
                with open(file, "wb") as f:
                    f.write(b"not to be read")
                for check in glob.glob(os.path.join(os.path.dirname(file), ".*.crc")):
                    os.remove(check)
    assert as_set(layer_tree.missing_keys(spark, left, right)) == want
    assert layer_tree.missing_keys(spark, right, right).collect() == []


@pytest.mark.parametrize("text", ["[a] [b] [c] d\u0001e", "x [t] [l] [m]", "\u0001", "", "[a][b][c]\nnext [d] [e] [f] g"])
def test_marks_in_a_line_do_not_matter(spark, text):
    import re

    from coursepulse.operators import oplog

    found = re.search(oplog.LINE, text)
    r = oplog.parse_oplog(spark.createDataFrame([(text,)], "value string")).first()
    assert tuple(r) == (text, *(found.groups() if found else (None, None, None, text)))
