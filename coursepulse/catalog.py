"""One query per operator, over the log derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from coursepulse import fixtures as X, schema as S
from coursepulse.functions import draws as D
from coursepulse.functions.labels import behavior_from_index, label_behavior
from coursepulse.functions.timestamps import timestamp_text
from coursepulse.operators import (
    alerts,
    cleaning,
    layer_tree,
    log_entries,
    log_index,
    metrics,
    oplog,
    quality,
    ranking,
    synth,
)
from coursepulse.plans import ranks
from coursepulse.plans.results import BATCH, six_results
from coursepulse.plans.rollup import ENROLMENT, merge, stored_rollup
from coursepulse.session import scratch_path
from coursepulse.sources import clustered, extra, readers, writers
from coursepulse.streaming import distinct, ingest, roll, running, seen, watched

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that separate something on the given tables; the oracle uses the same.
AS_OF = "2024-01-31 00:00:00"
AS_OF_DATE = "2024-01-31"
TERM_START = "2024-01-01"
EXAM_WEEKS = (3, 4)
ROSTER = 200
BATCH_ROWS = 100
SECOND_HALF = "2024-01-16 00:00:00"
RANGE = ("2024-01-05", "2024-01-20")
ONE_STUDENT = "STU_00000007"
KEYWORD = "event 1"
PAIR = ("student_id", "course_id")
SEED = 7
TIGHT_RULE = alerts.EngagementRule(
    lt=3.0,
    high_lt=2.5,
    k=20,
    filter_first=True,
    compare_rounded=True,
    digits=2,
    name_policy=metrics.GROUP,
    message=S.BATCH_ALERT_MESSAGE,
)


def _on_log(operator: Callable[[DataFrame], DataFrame], names: bool = False) -> Query:
    return lambda spark, sf: operator(X.behavior(spark, sf, names))


def _on_raw(operator: Callable[[DataFrame], DataFrame], names: bool = False) -> Query:
    return lambda spark, sf: operator(X.behavior_raw(spark, sf, names))


def _text_date(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def _halves(b: DataFrame) -> list[DataFrame]:
    """The log as it arrives: what came before the middle of the month, then the rest."""
    early = F.col("timestamp") < SECOND_HALF
    return [b.filter(early), b.filter(~early)]


def _landed(spark: SparkSession, sf: str) -> str:
    """A landing folder with the whole log, appended in two batches."""
    path = scratch_path(spark, "landing")
    halves = _halves(X.behavior(spark, sf))
    ingest.append_batches(lambda i: halves[i], path, len(halves))
    return path


def flat_results(results: dict[str, DataFrame]) -> DataFrame:
    """The six results in one shape, to compare them in one go."""

    def rows(name: str, key, label, amount, value) -> DataFrame:
        return results[name].select(
            F.lit(name).alias("result"),
            key.cast("string").alias("key"),
            label.alias("label"),
            amount.cast("bigint").alias("amount"),
            value.cast("double").alias("value"),
        )

    col, lit = F.col, F.lit
    totals = ["total_students", "total_courses", "total_behaviors"]
    figures = ["total_study_hours", "avg_study_hours", "active_rate"]
    parts = [
        rows("summary", lit(f"{i}"), lit(t), col(t), col(f))
        for i, (t, f) in enumerate(zip(totals, figures))
    ]
    parts += [
        rows("student_ranking", col("student_id"), col("student_name"),
             col("rank") * 1000 + col("courses"), col("total_hours")),
        rows("course_popularity", col("course_id"), col("course_name"),
             col("student_count"), col("total_hours")),
        rows("behavior_distribution", col("type"), col("name"), col("count"), col("percentage")),
        rows("time_distribution", col("hour"), lit(""), col("count"), lit(0.0)),
        rows("alerts", col("student_id"), col("alert_message"),
             F.when(col("level") == "high", 2).otherwise(1), col("total_hours")),
    ]
    return reduce(DataFrame.unionAll, parts)


# --- sources -----------------------------------------------------------------------------


def read_json_logs(spark: SparkSession, sf: str) -> DataFrame:
    """A folder that mixes dated sub-folders with files at its root."""
    path = scratch_path(spark, "mixed")
    early, late = _halves(X.behavior(spark, sf))
    writers.write_partitioned(early, path)
    writers.write_json(late, path, mode="append")
    return readers.good_records(readers.read_json_logs(spark, path))


def read_csv_logs(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    writers.write_logs(synth_b22(spark, sf), path, "csv")
    return readers.good_records(readers.read_csv_logs(spark, path))


def read_partitioned_logs(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "dated")
    writers.write_partitioned(X.behavior(spark, sf), path)
    return readers.good_records(readers.read_partitioned_logs(spark, path, *RANGE))


def dim(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the log per member of an in-memory dimension."""
    codes = readers.dim(
        spark, list(S.BEHAVIOR_LABELS.items()), "behavior_type string, label string"
    )
    counts = X.behavior(spark, sf, names=False).groupBy("behavior_type").count()
    return codes.join(counts, "behavior_type", "left")


def batch_frame(spark: SparkSession, sf: str) -> DataFrame:
    """The first records of the log, held by the caller, as a frame of mandatory fields."""
    first = X.behavior(spark, sf).select(*S.B8.fieldNames()).orderBy("record_id").limit(BATCH_ROWS)
    return readers.batch_frame(spark, [tuple(r) for r in first.collect()])


def dense_index(spark: SparkSession, sf: str) -> DataFrame:
    students = X.behavior(spark, sf).select("student_id", "student_name").distinct()
    return synth.dense_index(students, [F.asc("student_id"), F.asc("student_name")])


def sequence_rows(spark: SparkSession, sf: str) -> DataFrame:
    """As many numbered rows as there are events."""
    return synth.sequence_rows(spark, X.events(spark, sf).count())


# --- sinks -------------------------------------------------------------------------------


def write_json(spark: SparkSession, sf: str) -> DataFrame:
    """Overwriting twice leaves one copy."""
    path = scratch_path(spark, "json")
    log = X.behavior(spark, sf)
    writers.write_json(log, path)
    writers.write_json(log, path)
    return readers.good_records(readers.read_json_logs(spark, path))


def append_batches(spark: SparkSession, sf: str) -> DataFrame:
    return readers.good_records(readers.read_json_logs(spark, _landed(spark, sf)))


def write_logs(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "logs")
    log = X.behavior(spark, sf)
    writers.write_logs(log, path, "csv")
    return readers.good_records(readers.read_csv_logs(spark, path, log.schema))


def write_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per dated folder, the unreadable dates in one of their own."""
    path = scratch_path(spark, "dated")
    writers.write_partitioned(X.behavior_raw(spark, sf, names=False), path)
    logs = readers.read_partitioned_logs(spark, path)
    return logs.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("count"))


def clustered_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A student's rows of the second half of the month, from the log in space-filling order."""
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(X.behavior(spark, sf), path)
    return clustered.read_clustered(spark, path, ONE_STUDENT, SECOND_HALF)


def clustered_log(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log as it lands, damaged times and missing students included, stored in that order."""
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(X.behavior_raw(spark, sf), path)
    return clustered.read_clustered(spark, path)


def write_bundle(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "bundle")
    results = six_results(stored_rollup(X.behavior(spark, sf)), AS_OF, BATCH, ROSTER)
    writers.write_bundle(results, path)
    return flat_results(writers.read_bundle(spark, path, results))


def compare_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json")
    log = X.behavior(spark, sf)
    writers.write_json(log, path)
    return quality.compare_counts(log, readers.read_json_logs(spark, path))


def csv_line_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    writers.write_logs(X.behavior(spark, sf), path, "csv")
    return quality.csv_line_counts(spark, path).select(
        "records", (F.col("lines") - F.col("files") == F.col("records")).alias("one_header_each")
    )


# --- projections -------------------------------------------------------------------------


def behavior_from_index_query(spark: SparkSession, sf: str) -> DataFrame:
    events = X.events(spark, sf)
    return events.select("event_id", behavior_from_index(F.col("user_id") % 7).alias("behavior"))


def duration_for(spark: SparkSession, sf: str) -> DataFrame:
    u = D.draw(SEED, F.col("record_id"), 0)
    code = F.col("behavior_type")
    return X.behavior(spark, sf, names=False).select(
        "record_id",
        D.duration_for(code, u).alias("batch_seconds"),
        D.inclusive_duration_for(code, u).alias("log_seconds"),
        D.triangular_duration_for(code, u).alias("triangular_seconds"),
    )


def label_behavior_query(spark: SparkSession, sf: str) -> DataFrame:
    """Event types are not behaviour codes, so they label themselves."""
    codes = X.behavior(spark, sf, names=False).select(F.col("behavior_type").alias("code"))
    types = X.events(spark, sf).select(F.col("event_type").alias("code"))
    counts = codes.unionAll(types).groupBy("code").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("label", label_behavior(F.col("code")))


def alert_columns(spark: SparkSession, sf: str) -> DataFrame:
    hours = metrics.student_hours(X.behavior(spark, sf))
    high = F.col("total_hours") < 2.5
    return alerts.alert_columns(hours, AS_OF, high, S.REALTIME_ALERT_MESSAGE)


# --- joins -------------------------------------------------------------------------------


def _indexed_students(spark: SparkSession, sf: str) -> DataFrame:
    """Customer keys are dense from 0, so they serve as the index."""
    return X.students(spark, sf).withColumnRenamed("user_id", "idx")


def _indexed_courses(spark: SparkSession, sf: str) -> DataFrame:
    return X.courses(spark, sf).withColumnRenamed("course_no", "idx")


def join_students(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.events(spark, sf).select("event_id", F.col("user_id").alias("student_idx"))
    return synth.join_students(rows, _indexed_students(spark, sf))


def join_courses(spark: SparkSession, sf: str) -> DataFrame:
    """User ids from 8 on meet no course."""
    rows = X.events(spark, sf).select("event_id", F.col("user_id").alias("course_idx"))
    return synth.join_courses(rows, _indexed_courses(spark, sf))


def zero_fill_hours(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.time_distribution(X.behavior(spark, sf, names=False), zero_fill=True)


def extra_keys(spark: SparkSession, sf: str) -> DataFrame:
    raw = X.behavior_raw(spark, sf, names=False)
    # Deduplication keeps every key, so the keys of the cleaned rows are those of the layer.
    return cleaning.extra_keys(cleaning.clean(raw), raw)


def lost_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The other direction: keys that cleaning removed."""
    raw = X.behavior_raw(spark, sf, names=False)
    return cleaning.extra_keys(raw, cleaning.clean(raw))


def tree_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The keys that cleaning removed, from the hash trees of both layers."""
    raw = X.behavior_raw(spark, sf, names=False)
    left, right = scratch_path(spark, "layer"), scratch_path(spark, "layer")
    layer_tree.write_layer(raw, left)
    layer_tree.write_layer(cleaning.clean(raw), right)
    return layer_tree.missing_keys(spark, left, right)


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw = X.behavior_raw(spark, sf, names=False)
    return cleaning.layer_counts(cleaning.dwd(raw), raw)


def union_logs(spark: SparkSession, sf: str) -> DataFrame:
    """The early half in standard form, the late half in detailed form."""
    early, late = _halves(X.behavior(spark, sf))
    return cleaning.union_logs([cleaning.select_b8(early), late.select(*S.B11.fieldNames())])


# --- quality -----------------------------------------------------------------------------


def violations(spark: SparkSession, sf: str) -> DataFrame:
    raw = X.behavior_raw(spark, sf, names=False)
    return quality.violations(raw, "ip_format").select("record_id", "ip_address")


# --- streaming ---------------------------------------------------------------------------


def stream_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over one folder; the second takes only the files that are new."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "consumed")
    checkpoint = scratch_path(spark, "checkpoint")
    for half in _halves(X.behavior(spark, sf)):
        writers.write_json(half, landing, mode="append")
        records = readers.good_records(ingest.stream_logs(spark, landing))
        records = records.select(*S.LOG.fieldNames())
        query = (
            records.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(out)
        )
        query.awaitTermination()
    return spark.read.parquet(out)


def split_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as lines; the long ones become several."""
    docs = X.table(spark, sf, "documents")
    pieces = ingest.split_lines(docs.select("doc_id", F.col("text").alias("value")), S.MAX_LINE_LENGTH)
    return pieces.select(
        "doc_id", F.length("value").cast("bigint").alias("chars"), F.md5("value").alias("digest")
    )


def parse_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Records as JSON lines between lines of another kind, which are kept aside."""
    records = cleaning.json_lines(X.behavior(spark, sf, names=False))
    lines = records.unionAll(X.oplog_lines(spark, sf))
    return ingest.parse_lines(lines).select(
        "record_id", "student_id", "course_id", "duration", "timestamp", "score",
        F.col(S.CORRUPT).alias("unread"),
    )


def with_ingest_meta(spark: SparkSession, sf: str) -> DataFrame:
    lines = ingest.with_ingest_meta(spark.read.text(_landed(spark, sf)))
    return readers.parse_records(lines).select(
        "record_id",
        F.col("ingest_time").isNotNull().alias("stamped"),
        F.col("filename").endswith(F.col("basename")).alias("named"),
    )


def land_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream = ingest.stream_logs(spark, _landed(spark, sf))
    out = scratch_path(spark, "dated")
    ingest.land_stream(stream, out, scratch_path(spark, "checkpoint"), by="event").awaitTermination()
    return readers.good_records(readers.read_partitioned_logs(spark, out))


def extra_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that no schema has, after reading, landing and reading again."""
    log = X.behavior(spark, sf, names=False)
    unknown = {
        "seat": F.col("record_id").cast("bigint") % 1000,
        "context": F.struct(F.col("chapter_id").alias("unit"), (F.col("duration") * 2).alias("ticks")),
        "tags": F.array("device_type", "behavior_type"),
    }
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "dated")
    writers.write_json(log.withColumns(unknown), landing)
    stream = ingest.stream_logs(spark, landing, extra=True)
    ingest.land_stream(stream, out, scratch_path(spark, "checkpoint"), by="event").awaitTermination()
    return readers.good_records(readers.read_partitioned_logs(spark, out, extra=True)).select(
        "record_id",
        "duration",
        extra.field("seat", "$", "bigint").alias("seat"),
        extra.field("context", "$.unit", "string").alias("unit"),
        extra.field("context", "$.ticks", "bigint").alias("ticks"),
        extra.field("tags", "$[1]", "string").alias("tag"),
        extra.field("context", "$.absent", "string").alias("absent"),
    )


def roll_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The log landed in small batches, rolled, and landed on."""
    landing, out, rolled = (scratch_path(spark, n) for n in ("landing", "dated", "rolled"))
    checkpoint, upto = scratch_path(spark, "checkpoint"), None
    for half in _halves(X.behavior(spark, sf)):
        writers.write_json(half.repartition(3), landing, mode="append")
        stream = ingest.stream_logs(spark, landing, max_files=1)
        ingest.land_stream(stream, out, checkpoint, by="event").awaitTermination()
        if upto is None:
            upto = roll.roll(spark, out, rolled)
            roll.drop_rolled(spark, out, upto)
    return readers.good_records(roll.read_rolled(spark, out, rolled, upto))


def dedup_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned layer of three batches in order of record ids, one after the other."""
    raw = cleaning.clean(X.behavior_raw(spark, sf))
    store, path = scratch_path(spark, "seen"), scratch_path(spark, "unique")
    number, half = F.col("record_id").try_cast("bigint"), X.events(spark, sf).count() // 2
    third = F.when(number.isNull(), 2).when(number >= half, 1).otherwise(0)
    for i in range(3):
        seen.dedup_batch(raw.filter(third == i), i, store, path)
    return spark.read.parquet(path).drop("batch_id")


def watch_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Violations counted while a stream of several micro-batches is written."""
    landing, out, counts = (scratch_path(spark, n) for n in ("landing", "watched", "counts"))
    writers.write_json(X.behavior_raw(spark, sf).repartition(4), landing)
    stream = ingest.stream_logs(spark, landing, max_files=2).drop("ingest_time", "filename", "basename")
    watched.watch_stream(stream, out, counts, scratch_path(spark, "checkpoint")).awaitTermination()
    return watched.stream_report(spark, counts)


def _bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    path, numbers = scratch_path(spark, "bitmaps"), scratch_path(spark, "numbers")
    for i, half in enumerate(_halves(X.behavior(spark, sf))):
        distinct.add_batch(half, i, path, numbers)
    return distinct.merged(spark, path)


def summary_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    return distinct.summary(_bitmaps(spark, sf), ROSTER)


def popularity_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    return distinct.course_popularity(_bitmaps(spark, sf))


def _run_in_two(spark: SparkSession, sf: str, path: str) -> None:
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    for half in _halves(X.behavior(spark, sf)):
        writers.write_json(half, landing, mode="append")
        stream = ingest.stream_logs(spark, landing)
        running.running_fact(stream, path, checkpoint).awaitTermination()


def running_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The student x course grain of the running fact, batches merged."""
    path = scratch_path(spark, "fact")
    _run_in_two(spark, sf, path)
    merged = merge(running.snapshot(spark, path).filter(F.col("grain") == ENROLMENT))
    return merged.select(
        "student_id", "student_name", "course_id", "course_name",
        "n", "seconds", "score_tenths", "score_n",
        timestamp_text(F.col("last_ts")).alias("last_activity"),
    )


def snapshot_results(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    _run_in_two(spark, sf, path)
    return flat_results(running.snapshot_results(spark, path, AS_OF, roster_size=ROSTER))


def incremental_refresh(spark: SparkSession, sf: str) -> DataFrame:
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    checkpoint = scratch_path(spark, "checkpoint")
    results: dict[str, DataFrame] = {}
    for half in _halves(X.behavior(spark, sf)):
        writers.write_json(half, landing, mode="append")
        results = running.incremental_refresh(
            spark, landing, path, checkpoint, AS_OF, BATCH, roster_size=ROSTER
        )
    return flat_results(results)


def compact(spark: SparkSession, sf: str) -> DataFrame:
    """Results from a fact whose first batch was merged and removed before the second came."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    checkpoint, merged = scratch_path(spark, "checkpoint"), scratch_path(spark, "merged")
    upto, results = None, {}
    for half in _halves(X.behavior(spark, sf)):
        writers.write_json(half, landing, mode="append")
        results = running.incremental_refresh(
            spark, landing, path, checkpoint, AS_OF, BATCH,
            compacted=merged, upto=upto, roster_size=ROSTER,
        )
        if upto is None:
            upto = running.compact(spark, path, merged)
            running.drop_merged(spark, path, upto)
    return flat_results(results)


# --- generation --------------------------------------------------------------------------


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return X.events(spark, sf).select(F.col("event_id").alias("row_id"))


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return synth.course_catalogue(spark)


def synth_b8(spark: SparkSession, sf: str) -> DataFrame:
    dims = _indexed_students(spark, sf), _indexed_courses(spark, sf)
    return synth.synth_b8(_rows(spark, sf), *dims, seed=SEED)


def synth_b11(spark: SparkSession, sf: str) -> DataFrame:
    dims = _indexed_students(spark, sf), _catalogue(spark, sf)
    return synth.synth_b11(_rows(spark, sf), *dims, seed=SEED)


def synth_b22(spark: SparkSession, sf: str) -> DataFrame:
    students = synth.dataset_students(_indexed_students(spark, sf), seed=SEED)
    return synth.synth_b22(_rows(spark, sf), students, _catalogue(spark, sf), seed=SEED)


def _u(salt: int):
    return D.draw(SEED, F.col("row_id"), salt)


def draws(spark: SparkSession, sf: str) -> DataFrame:
    """Five salts: four slices of one digest and the first of the next."""
    return _rows(spark, sf).select("row_id", *[_u(i).alias(f"u{i}") for i in range(5)])


def weighted(spark: SparkSession, sf: str) -> DataFrame:
    return _rows(spark, sf).select(
        "row_id",
        D.weighted(_u(0), S.BEHAVIOR_WEIGHTS).alias("behavior_type"),
        D.weighted(_u(1), S.DEVICE_WEIGHTS).alias("device_type"),
    )


def triangular(spark: SparkSession, sf: str) -> DataFrame:
    return _rows(spark, sf).select("row_id", D.triangular(_u(0), 300, 7200, 2400).alias("seconds"))


def pick(spark: SparkSession, sf: str) -> DataFrame:
    return _rows(spark, sf).select(
        "row_id",
        D.pick(_u(0), S.BROWSERS).alias("browser"),
        D.pick(_u(1), S.OPERATING_SYSTEMS).alias("os"),
        D.pick(_u(2), S.MAJORS).alias("major"),
        D.campus_ip(_u(3), _u(4), _u(5)).alias("campus_ip"),
        D.private_ip(_u(6), _u(7)).alias("private_ip"),
    )


def chapter(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.events(spark, sf).select(F.col("event_id").alias("row_id"), "user_id")
    week, chapters = F.col("user_id") % 17 + 1, F.col("user_id") % 8 + 9
    return rows.select("row_id", D.chapter(chapters, week, _u(0)).alias("chapter_id"))


def score(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("behavior_type")
    rows = X.behavior(spark, sf, names=False).withColumn("row_id", F.col("record_id"))
    return rows.select(
        "record_id",
        D.score(code, _u(0), _u(1)).alias("score"),
        D.score(code, _u(0), _u(1), 12.0, (_u(2), _u(3))).alias("score_with_fails"),
    )


def weighted_ts(spark: SparkSession, sf: str) -> DataFrame:
    timed = synth.weighted_ts(_rows(spark, sf), _u(0), _u(1))
    return timed.select("row_id", timestamp_text(F.col("event_ts")).alias("event_ts"))


# --- operational log ---------------------------------------------------------------------


def parse_oplog(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines and, as lines of another form, the JSON properties of the events."""
    other = X.events(spark, sf).select(F.col("props").alias("value"))
    return oplog.parse_oplog(X.oplog_lines(spark, sf).unionAll(other))


def search_oplog(spark: SparkSession, sf: str) -> DataFrame:
    parsed = oplog.parse_oplog(X.oplog_lines(spark, sf))
    return oplog.search_oplog(parsed, "hadoop", "INFO", KEYWORD)


def latest(spark: SparkSession, sf: str) -> DataFrame:
    return oplog.latest(oplog.parse_oplog(X.oplog_lines(spark, sf)), 100)


def _entry_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The log written as text, each error followed by up to three lines of a trace; grouped."""
    path, events = scratch_path(spark, "oplog"), X.events(spark, sf)
    props = events.select("event_id", "event_type", "props")
    number = F.col("event_id").cast("string")
    n = F.when(F.col("event_type") == "error", (F.col("event_id") % 4).cast("int")).otherwise(0)
    frame = lambda i: F.concat(F.lit("\n  at step "), i.cast("string"), F.lit(" of "), F.col("props"))
    trace = F.array_join(F.transform(F.slice(F.array(*map(F.lit, (1, 2, 3))), 1, n), frame), "")
    numbered = X.oplog_lines(spark, sf).withColumn("number", F.regexp_extract("value", r"(\d+)$", 1))
    whole = numbered.join(props.select(number.alias("number"), trace.alias("trace")), "number")
    whole.select(F.concat("value", "trace").alias("value")).write.text(path)
    return log_entries.group_lines(log_entries.read_oplog(spark, path))


ENTRY_COLUMNS = ("ts", "level", "module", "message", "n_lines", "n_chars")


def log_entries_query(spark: SparkSession, sf: str) -> DataFrame:
    return log_entries.entries(_entry_lines(spark, sf)).select(*ENTRY_COLUMNS)


def search_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries whose trace, not only whose first line, holds the keyword."""
    return log_entries.entries(_entry_lines(spark, sf), "at step 3").select(*ENTRY_COLUMNS)


def search_index(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "index")
    log_index.write_index(X.oplog_lines(spark, sf), path)
    return log_index.search_index(spark, path, KEYWORD, "hadoop", "INFO")


def observe_job(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "observed")
    log = X.behavior(spark, sf)
    report = oplog.observe_job(log, "land", lambda df: writers.write_json(df, path))
    return spark.createDataFrame(
        [(report.name, report.records, report.status)], "job string, records bigint, status string"
    )


QUERIES: dict[str, Query] = {
    # sources
    "read_json_logs": read_json_logs,
    "read_csv_logs": read_csv_logs,
    "read_partitioned_logs": read_partitioned_logs,
    "dim": dim,
    "dense_index": dense_index,
    "batch_frame": batch_frame,
    "conform": _on_log(readers.conform, names=True),
    "sequence_rows": sequence_rows,
    # sinks
    "write_json": write_json,
    "append_batches": append_batches,
    "write_logs": write_logs,
    "write_partitioned": write_partitioned,
    "clustered_scan": clustered_scan,
    "clustered_log": clustered_log,
    "write_bundle": write_bundle,
    # projections and filters
    "select_b8": _on_log(cleaning.select_b8, names=True),
    "behavior_from_index": behavior_from_index_query,
    "duration_for": duration_for,
    "label_behavior": label_behavior_query,
    "alert_columns": alert_columns,
    "add_calendar": _on_raw(
        lambda b: cleaning.add_calendar(b, TERM_START, EXAM_WEEKS).select(
            "record_id", "date", "hour", "weekday", "week_number", "is_weekend", "is_exam_week"
        )
    ),
    "clean": _on_raw(cleaning.clean, names=True),
    "student_total": _on_log(lambda b: metrics.student_total(b, ONE_STUDENT)),
    # joins and set operations
    "join_students": join_students,
    "join_courses": join_courses,
    "zero_fill_hours": zero_fill_hours,
    "extra_keys": extra_keys,
    "lost_keys": lost_keys,
    "keys": _on_raw(cleaning.keys),
    "threshold_diff": _on_log(
        lambda b: _text_date(
            alerts.threshold_diff(b, AS_OF_DATE, 7, 10, PAIR), "last_activity"
        )
    ),
    "union_logs": union_logs,
    # aggregations
    "summary": _on_log(lambda b: metrics.summary(b, ROSTER)),
    "student_hours": _on_log(metrics.student_hours, names=True),
    "student_hours_latest": _on_log(
        lambda b: metrics.student_hours(b, metrics.LATEST), names=True
    ),
    "course_popularity": _on_log(metrics.course_popularity, names=True),
    "behavior_distribution": _on_log(metrics.behavior_distribution),
    "time_distribution": _on_raw(metrics.time_distribution),
    "student_activity": _on_raw(metrics.student_activity, names=True),
    "last_activity": _on_raw(lambda b: _text_date(metrics.last_activity(b), "last_activity")),
    "course_metrics": _on_log(metrics.course_metrics),
    "student_profile": _on_raw(metrics.student_profile),
    "student_courses": _on_log(metrics.student_courses),
    "student_avg_score": _on_log(metrics.student_avg_score),
    "student_behavior_duration": _on_log(metrics.student_behavior_duration),
    "student_behavior_duration_wide": _on_raw(
        lambda b: metrics.student_behavior_duration(b, wide=True)
    ),
    "student_behavior_counts": _on_log(metrics.student_behavior_counts),
    "distinct_count": _on_raw(lambda b: metrics.distinct_count(b, "student_id")),
    "device_distribution": _on_log(metrics.device_distribution),
    "weekend_split": _on_raw(metrics.weekend_split),
    "reconcile_duration": _on_raw(metrics.reconcile_duration),
    "partition_counts": _on_raw(
        lambda b: _text_date(metrics.partition_counts(b), "event_date")
    ),
    "latest_names": _on_log(
        lambda b: metrics.latest_names(b, "course_id", "student_name"), names=True
    ),
    "row_count": _on_raw(metrics.row_count),
    # rankings
    "student_ranking": _on_log(ranking.student_ranking, names=True),
    "student_ranking_realtime": _on_log(
        lambda b: ranking.student_ranking(b, preset=ranking.REALTIME), names=True
    ),
    "rank_courses": _on_log(lambda b: ranking.rank_courses(metrics.course_metrics(b))),
    "rank_courses_by_time": _on_log(
        lambda b: ranking.rank_courses(metrics.course_metrics(b), "total_duration")
    ),
    "dedup": _on_raw(cleaning.dedup, names=True),
    "dwd": _on_raw(cleaning.dwd, names=True),
    "sort_logs": _on_raw(lambda b: cleaning.sort_logs(b).select("record_id", "timestamp")),
    "top_k": _on_log(
        lambda b: ranks.top_k(
            metrics.student_hours(b), [F.asc("total_seconds"), F.asc("student_id")], 20
        ),
        names=True,
    ),
    "sample_rows": _on_log(cleaning.sample_rows, names=True),
    # alerts
    "low_engagement": _on_log(lambda b: alerts.low_engagement(b, AS_OF), names=True),
    "low_engagement_tight": _on_log(
        lambda b: alerts.low_engagement(b, AS_OF, TIGHT_RULE), names=True
    ),
    "low_engagement_realtime": _on_log(
        lambda b: alerts.low_engagement(b, AS_OF, alerts.REALTIME_RULE), names=True
    ),
    "inactive_students": _on_log(
        lambda b: _text_date(
            alerts.inactive_students(b, "2024-02-05", S.INACTIVE_DAYS), "last_activity"
        )
    ),
    "inactive_level": _on_log(
        lambda b: _text_date(
            alerts.with_inactive_level(
                alerts.inactive_students(b, AS_OF_DATE, S.INACTIVE_DAYS, PAIR)
            ),
            "last_activity",
        )
    ),
    "low_duration": _on_log(lambda b: alerts.low_duration(b, by=PAIR)),
    "low_score": _on_log(alerts.low_score),
    # quality
    "quality_report": _on_raw(quality.quality_report, names=True),
    "violations": violations,
    "compare_counts": compare_counts,
    "csv_line_counts": csv_line_counts,
    "layer_counts": layer_counts,
    "tree_diff": tree_diff,
    "json_roundtrip": _on_log(cleaning.json_roundtrip, names=True),
    # streaming
    "stream_logs": stream_logs,
    "split_lines": split_lines,
    "parse_lines": parse_lines,
    "with_ingest_meta": with_ingest_meta,
    "land_stream": land_stream,
    "extra_fields": extra_fields,
    "roll_landed": roll_landed,
    "dedup_batches": dedup_batches,
    "watch_stream": watch_stream,
    "summary_bitmaps": summary_bitmaps,
    "popularity_bitmaps": popularity_bitmaps,
    "running_fact": running_fact,
    "snapshot_results": snapshot_results,
    "incremental_refresh": incremental_refresh,
    "compact": compact,
    # generation
    "synth_b8": synth_b8,
    "synth_b11": synth_b11,
    "synth_b22": synth_b22,
    "draws": draws,
    "weighted": weighted,
    "triangular": triangular,
    "score": score,
    "weighted_ts": weighted_ts,
    "chapter": chapter,
    "pick": pick,
    # operational log
    "parse_oplog": parse_oplog,
    "search_oplog": search_oplog,
    "search_index": search_index,
    "log_entries": log_entries_query,
    "search_entries": search_entries,
    "latest": latest,
    "observe_job": observe_job,
}
