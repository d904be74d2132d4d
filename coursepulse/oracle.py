"""The queries of the catalog in plain SQL, to be run by another engine on the same tables."""

from __future__ import annotations

from coursepulse import fixtures as X, schema as S

SEED = 7


# --- expressions -------------------------------------------------------------------------


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _hours(seconds: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"(({scale} * {_big(seconds)} + 1800) // 3600) / CAST({scale} AS DOUBLE)"


def _percent(part: str, whole: str) -> str:
    return f"((2000 * {_big(part)} + {_big(whole)}) // (2 * {_big(whole)})) / CAST(10 AS DOUBLE)"


def _case(subject: str, table: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {subject} = '{k}' THEN {v}" for k, v in table.items())
    return f"CASE {whens} ELSE {default} END"


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _label(code: str) -> str:
    return _case(code, {k: f"'{v}'" for k, v in S.BEHAVIOR_LABELS.items()}, code)


def _u(row: str, salt: int, seed: int = SEED) -> str:
    block, part = divmod(salt, 4)
    digest = f"md5('{seed}:' || CAST({row} AS VARCHAR) || ':{block}')"
    return f"CAST(('0x' || substr({digest}, {part * 8 + 1}, 8)) AS BIGINT)"


def _below(u: str, n: int | str) -> str:
    return f"(({u} * {n}) // 4294967296)"


def _fraction(u: str) -> str:
    return f"({u} / CAST(4294967296 AS DOUBLE))"


def _pick(u: str, values: list[str]) -> str:
    return f"list_extract([{_quoted(values)}], {_below(u, len(values))} + 1)"


def _weighted(u: str, choices: list[tuple[str, int]]) -> str:
    k = _below(u, sum(w for _, w in choices))
    whens, upto = [], 0
    for value, weight in choices[:-1]:
        upto += weight
        whens.append(f"WHEN {k} < {upto} THEN '{value}'")
    return f"CASE {' '.join(whens)} ELSE '{choices[-1][0]}' END"


def _uniform_by_behavior(code: str, u: str, ranges: dict, extra: int = 0) -> str:
    draws = {b: f"{lo} + {_below(u, hi + extra - lo)}" for b, (lo, hi) in ranges.items()}
    last = list(draws)[-1]
    return _case(code, {b: e for b, e in draws.items() if b != last}, draws[last])


def _triangular(u: str, low: int, high: int, mode: int) -> str:
    x = _fraction(u)
    left = f"CAST({low} AS DOUBLE) + sqrt({x} * CAST({(high - low) * (mode - low)} AS DOUBLE))"
    right = (
        f"CAST({high} AS DOUBLE) - "
        f"sqrt((1 - {x}) * CAST({(high - low) * (high - mode)} AS DOUBLE))"
    )
    cut = f"CAST({(mode - low) / (high - low)!r} AS DOUBLE)"
    return _big(f"floor(CASE WHEN {x} < {cut} THEN {left} ELSE {right} END)")


def _triangular_by_behavior(code: str, u: str) -> str:
    draws = {b: _triangular(u, *shape) for b, shape in S.TRIANGULAR_DURATIONS.items()}
    last = list(draws)[-1]
    return _case(code, {b: e for b, e in draws.items() if b != last}, draws[last])


def _score(code: str, u1: str, u2: str, sd: int, fails: tuple[str, str] | None = None) -> str:
    mark = (
        f"75 + CAST({sd} AS DOUBLE) * sqrt(CAST(-2 AS DOUBLE) * ln(1 - {_fraction(u1)})) "
        f"* cos(2 * pi() * {_fraction(u2)})"
    )
    if fails:
        failed, low = fails
        mark = (
            f"CASE WHEN {_below(failed, 100)} < 5 THEN 40 + {_fraction(low)} * 19 ELSE {mark} END"
        )
    clamped = f"greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE), {mark}))"
    return (
        f"CASE WHEN {code} IN ({_quoted(S.SCORED_BEHAVIORS)}) "
        f"THEN floor({clamped} * CAST(10 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(10 AS DOUBLE) END"
    )


def _chapter(chapters: str, week: str, u: str) -> str:
    number = (
        f"greatest(1, least({chapters}, least({chapters}, ({week} * {chapters}) // {S.TERM_WEEKS})"
        f" + {_below(u, 5)} - 2))"
    )
    return f"'CH_' || {_zero_padded(number, 3)}"


def _octet(u: str) -> str:
    return f"CAST(1 + {_below(u, 254)} AS VARCHAR)"


def _campus_ip(u1: str, u2: str, u3: str) -> str:
    return f"{_pick(u1, S.CAMPUS_IP_PREFIXES)} || {_octet(u2)} || '.' || {_octet(u3)}"


def _private_ip(u1: str, u2: str) -> str:
    return f"'192.168.' || {_octet(u1)} || '.' || {_octet(u2)}"


def _zero_padded(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"(CASE WHEN {number} < {10**width} THEN lpad({text}, {width}, '0') ELSE {text} END)"


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


# --- the log derived from the given tables ------------------------------------------------

BEHAVIOR = f"""
events_k AS (
  SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents,
         CASE event_type WHEN 'view' THEN 'video_watch' WHEN 'purchase' THEN 'homework_submit'
              WHEN 'signup' THEN 'quiz_complete' WHEN 'click' THEN 'forum_post'
              ELSE 'material_download' END AS behavior_type
  FROM events
),
behavior AS (
  SELECT {_zero_padded('event_id', 12)} AS record_id,
         'STU_' || {_zero_padded('user_id', 8)} AS student_id,
         c_name AS student_name,
         'COURSE_' || {_zero_padded('(k % 8 + 1)', 3)} AS course_id,
         p_name AS course_name,
         behavior_type,
         cents * 36 // 1000 AS duration,
         {_text('ts')} AS "timestamp",
         '192.168.' || CAST(user_id % 254 + 1 AS VARCHAR) || '.'
           || CAST(event_id % 254 + 1 AS VARCHAR) AS ip_address,
         CASE event_id % 3 WHEN 0 THEN 'PC' WHEN 1 THEN 'Mobile' ELSE 'Tablet' END AS device_type,
         'CH_' || {_zero_padded('(k % 12 + 1)', 3)} AS chapter_id,
         CASE WHEN behavior_type IN ('quiz_complete', 'homework_submit')
              THEN (cents % 1001) / CAST(10 AS DOUBLE) END AS score
  FROM events_k
  LEFT JOIN customer ON c_custkey = user_id
  LEFT JOIN part ON p_partkey = k % 8
)"""

RAW = f"""{BEHAVIOR},
damaged AS (
  SELECT record_id,
         CASE WHEN CAST(record_id AS BIGINT) % 101 = 0 THEN NULL ELSE student_id END AS student_id,
         student_name,
         CASE WHEN CAST(record_id AS BIGINT) % 107 = 0 THEN '' ELSE course_id END AS course_id,
         course_name,
         CASE WHEN CAST(record_id AS BIGINT) % 103 = 0 THEN NULL ELSE behavior_type END
           AS behavior_type,
         duration,
         CASE WHEN CAST(record_id AS BIGINT) % 113 = 0
              THEN [{_quoted(X.BROKEN_TIMES)}][CAST(record_id AS BIGINT) // 113 % {len(X.BROKEN_TIMES)} + 1]
              ELSE "timestamp" END
           AS "timestamp",
         CASE WHEN CAST(record_id AS BIGINT) % 109 = 0 THEN ip_address || '.1' ELSE ip_address END
           AS ip_address,
         device_type, chapter_id, score
  FROM behavior
),
raw AS (
  SELECT * FROM damaged
  UNION ALL
  SELECT 'dup' || record_id, student_id, student_name, course_id, course_name, behavior_type,
         duration, "timestamp", ip_address, device_type, chapter_id, score
  FROM damaged WHERE CAST(record_id AS BIGINT) % 50 = 0
)"""

VALID = (
    "student_id IS NOT NULL AND student_id <> '' AND course_id IS NOT NULL AND course_id <> '' "
    "AND behavior_type IS NOT NULL AND behavior_type <> '' AND duration > 0"
)
KEY = 'student_id, course_id, "timestamp", behavior_type'
PARSED = (
    f"CASE WHEN regexp_full_match(\"timestamp\", '{S.TIMESTAMP_PATTERN}') "
    "THEN try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S') END"
)
LEVELS = {"error": "'ERROR'", "signup": "'WARN'", "click": "'DEBUG'"}
OPLOG = f"""
oplog AS (
  SELECT '[' || {_text('ts')} || '] [' || {_case('event_type', LEVELS, "'INFO'")} || '] ['
         || list_extract(['Web', 'HDFS', 'YARN', 'Spark', 'Flume'], event_id % 5 + 1)
         || '] event ' || CAST(event_id AS VARCHAR) AS line
  FROM events
)"""
LINE = r"\[([^\]]+)\]\s*\[([^\]]+)\]\s*\[([^\]]+)\]\s*(.*)"
COURSE_ROWS = ", ".join(
    f"({i}, '{cid}', '{name}', {chapters}, CAST({credits} AS DOUBLE))"
    for i, (cid, name, chapters, credits) in enumerate(S.COURSES)
)
CATALOGUE = f"""
catalogue(idx, course_id, course_name, chapters, credits) AS (VALUES {COURSE_ROWS})"""


def _log(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([BEHAVIOR, *ctes]) + "\n" + body


def _raw(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([RAW, *ctes]) + "\n" + body


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _distribution(source: str, key: str, alias: str, where: str = "") -> str:
    share = _percent("count(*)", "sum(count(*)) OVER ()")
    return (
        f"SELECT {key} AS {alias}, count(*) AS count, {share} AS percentage "
        f"FROM {source} {where} GROUP BY 1"
    )


def _first_per_key(source: str, where: str = "") -> str:
    return f"""
SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY record_id) AS nth
  FROM {source} {where})
WHERE nth = 1"""


def _latest_name(key: str, name: str, source: str = "behavior") -> str:
    return f"""
SELECT {key}, {name} FROM (
  SELECT {key}, {name},
         row_number() OVER (PARTITION BY {key} ORDER BY "timestamp" DESC, {name} DESC) AS nth
  FROM {source})
WHERE nth = 1"""


# --- the six results ---------------------------------------------------------------------


def _summary() -> str:
    tenths = f"((20 * {_big('sum(duration)')} + 3600) // 7200)"
    students = "count(DISTINCT student_id)"
    return f"""
SELECT {students} AS total_students, count(DISTINCT course_id) AS total_courses,
       count(*) AS total_behaviors, {_hours('sum(duration)', 1)} AS total_study_hours,
       ((2 * {tenths} + {students}) // (2 * {students})) / CAST(10 AS DOUBLE) AS avg_study_hours,
       {_percent(f'least({students}, 200)', '200')} AS active_rate
FROM behavior"""


def _hours_by_student() -> str:
    return f"""
SELECT student_id, student_name, {_big('sum(duration)')} AS total_seconds,
       {_hours('sum(duration)')} AS total_hours, count(DISTINCT course_id) AS courses
FROM behavior GROUP BY 1, 2"""


def _ranking(order: str) -> str:
    return f"""
SELECT row_number() OVER (ORDER BY {order}) AS rank,
       student_id, student_name, total_hours, courses
FROM ({_hours_by_student()})
ORDER BY rank LIMIT 10"""


def _popularity() -> str:
    return f"""
SELECT course_id, course_name, count(DISTINCT student_id) AS student_count,
       {_hours('sum(duration)')} AS total_hours
FROM behavior GROUP BY 1, 2"""


def _behaviors() -> str:
    return f"""
SELECT type, {_label('type')} AS name, count, percentage
FROM ({_distribution('behavior', 'behavior_type', 'type')})"""


def _time(source: str = "behavior", zero_fill: bool = False) -> str:
    hour = f"CAST(hour({PARSED}) AS INTEGER)"
    counts = (
        f"SELECT {hour} AS hour, count(*) AS count FROM {source} "
        f"WHERE {PARSED} IS NOT NULL GROUP BY 1"
    )
    if not zero_fill:
        return counts
    return f"""
SELECT CAST(h.range AS INTEGER) AS hour, coalesce(c.count, 0) AS count
FROM range(24) h LEFT JOIN ({counts}) c ON c.hour = h.range"""


def _low(lt: float, high: float, suffix: str = "，低于平均水平") -> str:
    return f"""
SELECT student_id, student_name, 'low_engagement' AS alert_type,
       CASE WHEN total_hours < {high} THEN 'high' ELSE 'medium' END AS level,
       '学习时长仅 ' || CAST(total_hours AS VARCHAR) || ' 小时{suffix}' AS alert_message,
       '2024-01-31 00:00:00' AS alert_time, total_hours
FROM ({_hours_by_student()})
WHERE total_hours < {lt} ORDER BY total_hours, student_id, student_name LIMIT 20"""


def _low_realtime() -> str:
    return f"""
SELECT student_id, student_name, 'low_engagement' AS alert_type,
       CASE WHEN total_seconds < 180000 THEN 'high' ELSE 'medium' END AS level,
       '学习时长仅 ' || CAST({_hours('total_seconds', 1)} AS VARCHAR) || ' 小时' AS alert_message,
       '2024-01-31 00:00:00' AS alert_time, {_hours('total_seconds', 1)} AS total_hours
FROM (SELECT * FROM ({_hours_by_student()}) ORDER BY total_seconds, student_id LIMIT 5)
WHERE total_seconds < 360000"""


def _flat(ranking: str, low: str, zero_fill: bool) -> str:
    level = "CASE WHEN level = 'high' THEN 2 ELSE 1 END"
    amount = f"CAST({level} AS BIGINT)"
    return _log(
        f"""
SELECT 'summary' AS result, '0' AS key, 'total_students' AS label,
       total_students AS amount, total_study_hours AS value FROM s
UNION ALL SELECT 'summary', '1', 'total_courses', total_courses, avg_study_hours FROM s
UNION ALL SELECT 'summary', '2', 'total_behaviors', total_behaviors, active_rate FROM s
UNION ALL SELECT 'student_ranking', student_id, student_name, rank * 1000 + courses, total_hours
          FROM ({_ranking(ranking)})
UNION ALL SELECT 'course_popularity', course_id, course_name, student_count, total_hours
          FROM ({_popularity()})
UNION ALL SELECT 'behavior_distribution', type, name, count, percentage FROM ({_behaviors()})
UNION ALL SELECT 'time_distribution', CAST(hour AS VARCHAR), '', count, CAST(0 AS DOUBLE)
          FROM ({_time(zero_fill=zero_fill)})
UNION ALL SELECT 'alerts', student_id, alert_message, {amount}, total_hours FROM ({low})""",
        f"\ns AS ({_summary()})",
    )


FLAT_BATCH = ("total_hours DESC, student_id, student_name", _low(5.0, 2.0), False)
FLAT_REALTIME = ("total_seconds DESC, student_id", _low_realtime(), True)


# --- generated logs ----------------------------------------------------------------------


def _course_count() -> str:
    return "(SELECT count(*) FROM part WHERE p_partkey BETWEEN 0 AND 7)"


def _synth_b8() -> str:
    r = "event_id"
    digest = f"md5('{SEED}:' || CAST({r} AS VARCHAR) || ':id')"
    uuid = " || '-' || ".join(
        f"substr({digest}, {at}, {n})" for at, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    )
    offset = " + ".join(
        f"{_below(_u(r, salt), n)} * {unit}"
        for salt, n, unit in [(3, 115, 86400), (4, 24, 3600), (5, 60, 60), (6, 60, 1)]
    )
    duration = _uniform_by_behavior("behavior_type", "u7", S.BATCH_DURATIONS)
    return f"""
WITH drawn AS (
  SELECT {uuid} AS record_id,
         {_below(_u(r, 0), '(SELECT count(*) FROM customer)')} AS student_idx,
         {_below(_u(r, 1), _course_count())} AS course_idx,
         {_pick(_u(r, 2), S.BEHAVIORS)} AS behavior_type,
         {_u(r, 7)} AS u7,
         {_text(f"TIMESTAMP '2025-09-01' + to_seconds({offset})")} AS "timestamp"
  FROM events)
SELECT record_id, 'STU_' || {_zero_padded('student_idx', 8)} AS student_id,
       c_name AS student_name,
       'COURSE_' || {_zero_padded('(course_idx + 1)', 3)} AS course_id,
       p_name AS course_name, behavior_type, {duration} AS duration, "timestamp"
FROM drawn LEFT JOIN customer ON c_custkey = student_idx
LEFT JOIN part ON p_partkey = course_idx"""


def _synth_b11() -> str:
    r = "event_id"
    duration = _uniform_by_behavior("behavior_type", "u7", S.LOG_DURATIONS, extra=1)
    return _with(
        f"""
SELECT 'STU_' || {_zero_padded('student_idx', 8)} AS student_id,
       c_name AS student_name, course_id, course_name, behavior_type, {duration} AS duration,
       {_text("TIMESTAMP '2025-09-01' + to_seconds(second)")} AS "timestamp",
       {_private_ip(_u(r, 8), _u(r, 9))} AS ip_address, device_type,
       'CH_' || {_zero_padded('(' + _below(_u(r, 10), 'chapters') + ' + 1)', 3)} AS chapter_id,
       {_score('behavior_type', _u(r, 11), _u(r, 12), 15)} AS score
FROM moved LEFT JOIN customer ON c_custkey = student_idx
LEFT JOIN catalogue ON idx = course_idx""",
        CATALOGUE,
        f"""
drawn AS (
  SELECT event_id, {_below(_u(r, 0), '(SELECT count(*) FROM customer)')} AS student_idx,
         {_below(_u(r, 1), len(S.COURSES))} AS course_idx,
         {_below(_u(r, 2), 7 * 86400)} AS first, {_below(_u(r, 3), 7 * 86400)} AS again,
         {_pick(_u(r, 5), S.BEHAVIORS)} AS behavior_type,
         {_pick(_u(r, 6), S.DEVICES)} AS device_type, {_u(r, 7)} AS u7
  FROM events),
moved AS (
  SELECT *, CASE WHEN (first % 86400) // 3600 BETWEEN 8 AND 22
                  AND {_below(_u(r, 4), 100)} < 30 THEN again ELSE first END AS second
  FROM drawn)""",
    )


def _hour_weight(table: list) -> str:
    whens = " ".join(f"WHEN h BETWEEN {lo} AND {hi} THEN {w}" for (lo, hi), w in table)
    return f"CASE {whens} ELSE 1.0 END"


# Hours of the term, their acceptance in units of 1/80, and the draw over all units.
SLOTS = f"""
hours AS (
  SELECT range AS slot, range % 24 AS h, range // 24 AS d,
         isodow(DATE '2025-09-01' + CAST(range // 24 AS INTEGER)) AS dow
  FROM range(115 * 24)),
weights AS (
  SELECT slot, CAST(least(80, round(
           (CASE WHEN dow <= 5 THEN {_hour_weight(S.WEEKDAY_HOUR_WEIGHTS)}
                 ELSE {_hour_weight(S.WEEKEND_HOUR_WEIGHTS)} END)
           * (CASE WHEN d // 7 + 1 IN (15, 16) THEN 1.5 ELSE 1.0 END) * 20)) AS BIGINT) AS w
  FROM hours),
members AS (
  SELECT slot, w, row_number() OVER (PARTITION BY w ORDER BY slot) - 1 AS member FROM weights),
classes AS (
  SELECT w, CAST(sum(w * n) OVER (ORDER BY w) - w * n AS BIGINT) AS lo,
         CAST(sum(w * n) OVER (ORDER BY w) AS BIGINT) AS hi
  FROM (SELECT w, count(*) AS n FROM weights GROUP BY w)),
units AS (SELECT CAST(sum(w) AS BIGINT) AS total FROM weights)"""


def _timed(u_slot: str, u_second: str) -> str:
    unit = _below(u_slot, "(SELECT total FROM units)")
    return f"""
placed AS (SELECT event_id, {unit} AS unit, {_below(u_second, 3600)} AS second FROM events),
timed AS (
  SELECT placed.event_id,
         TIMESTAMP '2025-09-01' + to_seconds(members.slot * 3600 + second) AS event_ts
  FROM placed JOIN classes ON unit >= lo AND unit < hi
  JOIN members ON members.w = classes.w AND members.member = (unit - lo) // classes.w)"""


def _synth_b22() -> str:
    r = "e.event_id"
    year = _below(_u("student_idx", 0), 3)
    week = "(date_diff('day', DATE '2025-09-01', CAST(event_ts AS DATE)) // 7 + 1)"
    fails = (_u("event_id", 15), _u("event_id", 16))
    return _with(
        f"""
SELECT 'REC_' || strftime(event_ts, '%Y%m%d%H%M%S') || '_'
         || {_zero_padded('event_id', 4)} AS record_id,
       'STU_202' || CAST({year} AS VARCHAR) || {_zero_padded('student_idx', 4)} AS student_id,
       c_name AS student_name, {_pick(_u('student_idx', 1), S.MAJORS)} AS student_major,
       course_id, course_name, credits AS course_credits, behavior_type,
       {_triangular_by_behavior('behavior_type', _u('event_id', 11))} AS duration,
       {_text('event_ts')} AS "timestamp", strftime(event_ts, '%Y-%m-%d') AS date,
       CAST(hour(event_ts) AS INTEGER) AS hour,
       CAST(isodow(event_ts) - 1 AS INTEGER) AS weekday, CAST({week} AS INTEGER) AS week_number,
       {_campus_ip(_u('event_id', 4), _u('event_id', 5), _u('event_id', 6))} AS ip_address,
       device_type, {_pick(_u('event_id', 7), S.BROWSERS)} AS browser,
       {_pick(_u('event_id', 8), S.OPERATING_SYSTEMS)} AS os,
       {_chapter('chapters', week, _u('event_id', 12))} AS chapter_id,
       {_score('behavior_type', _u('event_id', 13), _u('event_id', 14), 12, fails)} AS score,
       CASE WHEN isodow(event_ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN {week} IN (15, 16) THEN 1 ELSE 0 END AS is_exam_week
FROM drawn LEFT JOIN customer ON c_custkey = student_idx
LEFT JOIN catalogue ON idx = course_idx""",
        CATALOGUE,
        SLOTS,
        _timed(_u("event_id", 9), _u("event_id", 10)),
        f"""
drawn AS (
  SELECT e.event_id, event_ts,
         {_below(_u(r, 0), '(SELECT count(*) FROM customer)')} AS student_idx,
         {_below(_u(r, 1), len(S.COURSES))} AS course_idx,
         {_weighted(_u(r, 2), S.BEHAVIOR_WEIGHTS)} AS behavior_type,
         {_weighted(_u(r, 3), S.DEVICE_WEIGHTS)} AS device_type
  FROM events e JOIN timed USING (event_id))""",
    )


# --- all queries -------------------------------------------------------------------------


def all_sql() -> dict[str, str]:
    u = [_u("event_id", i) for i in range(8)]
    u_record = [_u("record_id", i) for i in range(4)]
    day = f"CAST({PARSED} AS DATE)"
    inactive = """
SELECT {keys}, CAST(max(CAST("timestamp" AS TIMESTAMP))::DATE AS VARCHAR) AS last_activity,
       date_diff('day', max(CAST("timestamp" AS TIMESTAMP))::DATE, DATE '{as_of}')
         AS inactive_days
FROM behavior GROUP BY {keys}"""
    pair_inactive = inactive.format(keys="student_id, course_id", as_of="2024-01-31")
    whole_log = _log("SELECT * FROM behavior")
    b8_columns = ", ".join(f'"{c}"' for c in S.B8_COLUMNS)
    course_metrics = """
SELECT course_id, count(DISTINCT student_id) AS student_count,
       CAST(sum(duration) AS BIGINT) AS total_duration, count(*) AS behavior_count,
       CAST(sum(duration) AS BIGINT) / CAST(count(DISTINCT student_id) AS DOUBLE) AS avg_duration
FROM behavior GROUP BY 1"""
    ranked = "SELECT *, row_number() OVER (ORDER BY {key} DESC, course_id) AS rank FROM ({m})"
    avg_score = """
SELECT student_id, count(score) AS n_scores,
       CAST(sum(CAST(round(score * 10) AS BIGINT)) AS BIGINT)
         / CAST(count(score) * 10 AS DOUBLE) AS avg_score
FROM behavior WHERE score IS NOT NULL GROUP BY 1"""
    profile_counts = ", ".join(
        f"count(*) FILTER (WHERE behavior_type = '{c}') AS n_{c}" for c in S.BEHAVIORS
    )
    other = f"NOT coalesce(behavior_type IN ({_quoted(S.BEHAVIORS)}), false)"
    profile_counts += f", count(*) FILTER (WHERE {other}) AS n_other"
    parts = {c: f"behavior_type = '{c}'" for c in S.BEHAVIORS} | {"other": other}
    wide = ", ".join(
        f"CAST(coalesce(sum(duration) FILTER (WHERE {part}), 0) AS BIGINT) AS {c}"
        for c, part in parts.items()
    )
    rules = {
        "required_fields": " OR ".join(
            f'"{f}" IS NULL' for f in S.REQUIRED_FIELDS if f != "score"
        ),
        "behavior_enum": f"NOT coalesce(behavior_type IN ({_quoted(S.BEHAVIORS)}), false)",
        "device_enum": f"NOT coalesce(device_type IN ({_quoted(S.DEVICES)}), false)",
        "duration_positive": "NOT coalesce(duration > 0, false)",
        "student_id_prefix": "NOT coalesce(starts_with(student_id, 'STU_'), false)",
        "course_id_prefix": "NOT coalesce(starts_with(course_id, 'COURSE_'), false)",
        "timestamp_format": (
            f"NOT coalesce(regexp_matches(\"timestamp\", '{S.TIMESTAMP_PATTERN}'), false)"
        ),
        "score_range": "NOT (score IS NULL OR score BETWEEN 0 AND 100)",
        "ip_format": f"NOT coalesce(regexp_matches(ip_address, '{S.IP_PATTERN}'), false)",
    }
    report = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {violated}) AS violations, "
        "count(*) AS rows FROM raw"
        for name, violated in rules.items()
    )
    clean = f"SELECT * FROM raw WHERE {VALID}"
    dwd = _first_per_key("raw", f"WHERE {VALID}")
    parsed_line = f"""
SELECT line,
       CASE WHEN regexp_matches(line, '{LINE}') THEN regexp_extract(line, '{LINE}', 1) END AS ts,
       CASE WHEN regexp_matches(line, '{LINE}') THEN regexp_extract(line, '{LINE}', 2) END AS level,
       CASE WHEN regexp_matches(line, '{LINE}') THEN regexp_extract(line, '{LINE}', 3) END
         AS module,
       CASE WHEN regexp_matches(line, '{LINE}') THEN regexp_extract(line, '{LINE}', 4)
            ELSE line END AS message
FROM oplog"""
    fact = f"""
SELECT student_id, student_name, course_id, course_name, count(*) AS n,
       CAST(sum(duration) AS BIGINT) AS seconds,
       CAST(sum(CAST(round(score * 10) AS BIGINT)) AS BIGINT) AS score_tenths,
       count(score) AS score_n, max("timestamp") AS last_activity
FROM behavior GROUP BY ALL"""
    numbered_students = (
        "SELECT DISTINCT student_id, student_name FROM behavior"
    )
    calendar_week = f"(date_diff('day', DATE '2024-01-01', {day}) // 7 + 1)"
    found = {
        # sources
        "read_json_logs": whole_log,
        "read_csv_logs": _synth_b22(),
        "read_partitioned_logs": _log(
            f"""
SELECT *, CAST(year({day}) AS INTEGER) AS year, CAST(month({day}) AS INTEGER) AS month,
       CAST(day({day}) AS INTEGER) AS day
FROM behavior WHERE {day} BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""
        ),
        "dim": _log(
            "SELECT CAST(d.idx AS BIGINT) AS idx, d.behavior_type, d.label, c.count FROM (VALUES "
            + ", ".join(
                f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(S.BEHAVIOR_LABELS.items())
            )
            + ") d(idx, behavior_type, label) LEFT JOIN (SELECT behavior_type, count(*) AS count "
            "FROM behavior GROUP BY 1) c USING (behavior_type)"
        ),
        "dense_index": _log(
            "SELECT student_id, student_name, row_number() OVER (ORDER BY student_id, "
            f"student_name) - 1 AS idx FROM ({numbered_students})"
        ),
        "batch_frame": _log(f"SELECT {b8_columns} FROM behavior ORDER BY record_id LIMIT 100"),
        "conform": _log(f"SELECT {b8_columns} FROM behavior"),
        "sequence_rows": "SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_id FROM events",
        # sinks
        "write_json": whole_log,
        "append_batches": whole_log,
        "write_logs": whole_log,
        "write_partitioned": _raw(
            f"""
SELECT CAST(year({day}) AS INTEGER) AS year, CAST(month({day}) AS INTEGER) AS month,
       CAST(day({day}) AS INTEGER) AS day, count(*) AS count
FROM raw GROUP BY 1, 2, 3"""
        ),
        "write_bundle": _flat(*FLAT_BATCH),
        # projections and filters
        "select_b8": _log(f"SELECT {b8_columns} FROM behavior"),
        "behavior_from_index": (
            "SELECT event_id, CASE user_id % 7 "
            + " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(S.BEHAVIORS[:-1]))
            + f" ELSE '{S.BEHAVIORS[-1]}' END AS behavior FROM events"
        ),
        "duration_for": _log(
            "SELECT record_id, "
            + _uniform_by_behavior("behavior_type", u_record[0], S.BATCH_DURATIONS)
            + " AS batch_seconds, "
            + _uniform_by_behavior("behavior_type", u_record[0], S.LOG_DURATIONS, extra=1)
            + " AS log_seconds, "
            + _triangular_by_behavior("behavior_type", u_record[0])
            + " AS triangular_seconds FROM behavior"
        ),
        "label_behavior": _log(
            f"""
SELECT code, count(*) AS count, {_label('code')} AS label
FROM (SELECT behavior_type AS code FROM behavior UNION ALL SELECT event_type FROM events)
GROUP BY 1"""
        ),
        "alert_columns": _log(
            f"""
SELECT *, 'low_engagement' AS alert_type,
       CASE WHEN total_hours < 2.5 THEN 'high' ELSE 'medium' END AS level,
       '学习时长仅 ' || CAST(total_hours AS VARCHAR) || ' 小时' AS alert_message,
       '2024-01-31 00:00:00' AS alert_time
FROM ({_hours_by_student()})"""
        ),
        "add_calendar": _raw(
            f"""
SELECT record_id, CAST({day} AS VARCHAR) AS date, CAST(hour({PARSED}) AS INTEGER) AS hour,
       CAST(isodow({day}) - 1 AS INTEGER) AS weekday,
       CAST({calendar_week} AS INTEGER) AS week_number,
       CASE WHEN isodow({day}) >= 6 THEN 1 WHEN {day} IS NOT NULL THEN 0 END AS is_weekend,
       CAST({calendar_week} IN (3, 4) AS INTEGER) AS is_exam_week
FROM raw"""
        ),
        "clean": _raw(clean),
        "student_total": _log(
            "SELECT CAST(coalesce(sum(duration), 0) AS BIGINT) AS total_duration FROM behavior "
            "WHERE student_id = 'STU_00000007'"
        ),
        # joins and set operations
        "join_students": f"""
SELECT event_id, 'STU_' || {_zero_padded('user_id', 8)} AS student_id,
       c_name AS student_name
FROM events LEFT JOIN customer ON c_custkey = user_id""",
        "join_courses": f"""
SELECT event_id, 'COURSE_' || {_zero_padded('(p_partkey + 1)', 3)} AS course_id,
       p_name AS course_name
FROM events
LEFT JOIN (SELECT * FROM part WHERE p_partkey BETWEEN 0 AND 7) ON p_partkey = user_id""",
        "zero_fill_hours": _log(_time(zero_fill=True)),
        "extra_keys": _raw(f"SELECT {KEY} FROM ({dwd}) EXCEPT SELECT {KEY} FROM raw"),
        "lost_keys": _raw(f"SELECT {KEY} FROM raw EXCEPT SELECT {KEY} FROM ({clean})"),
        "keys": _raw(f"SELECT DISTINCT {KEY} FROM raw"),
        "threshold_diff": _log(
            f"SELECT *, inactive_days >= 10 AS also_at_hi FROM ({pair_inactive}) "
            "WHERE inactive_days >= 7"
        ),
        "union_logs": _log(
            """
SELECT CASE WHEN early THEN record_id END AS record_id, student_id, student_name, course_id,
       course_name, behavior_type, duration, "timestamp",
       CASE WHEN NOT early THEN ip_address END AS ip_address,
       CASE WHEN NOT early THEN device_type END AS device_type,
       CASE WHEN NOT early THEN chapter_id END AS chapter_id,
       CASE WHEN NOT early THEN score END AS score
FROM (SELECT *, "timestamp" < '2024-01-16 00:00:00' AS early FROM behavior)"""
        ),
        # aggregations
        "summary": _log(_summary()),
        "student_hours": _log(_hours_by_student()),
        "student_hours_latest": _log(
            f"""
SELECT h.student_id, n.student_name, total_seconds, total_hours, courses
FROM (SELECT student_id, {_big('sum(duration)')} AS total_seconds,
             {_hours('sum(duration)')} AS total_hours, count(DISTINCT course_id) AS courses
      FROM behavior GROUP BY 1) h
JOIN ({_latest_name('student_id', 'student_name')}) n USING (student_id)"""
        ),
        "course_popularity": _log(_popularity()),
        "behavior_distribution": _log(_behaviors()),
        "time_distribution": _raw(_time("raw")),
        "student_activity": _raw(
            f"""
SELECT student_id, student_name, {_hours('sum(duration)')} AS total_hours,
       {_text(f'max({PARSED})')} AS last_activity
FROM raw GROUP BY 1, 2"""
        ),
        "last_activity": _raw(
            f"SELECT student_id, CAST(max({day}) AS VARCHAR) AS last_activity FROM raw GROUP BY 1"
        ),
        "course_metrics": _log(course_metrics),
        "student_profile": _raw(
            f"""
SELECT student_id, CAST(sum(duration) AS BIGINT) AS total_duration,
       count(DISTINCT course_id) AS course_count, {profile_counts}
FROM raw GROUP BY 1"""
        ),
        "student_courses": _log("SELECT DISTINCT student_id, course_id FROM behavior"),
        "student_avg_score": _log(avg_score),
        "student_behavior_duration": _log(
            "SELECT student_id, behavior_type, CAST(sum(duration) AS BIGINT) AS duration "
            "FROM behavior GROUP BY 1, 2"
        ),
        "student_behavior_duration_wide": _raw(
            f"SELECT student_id, {wide} FROM raw GROUP BY 1"
        ),
        "student_behavior_counts": _log(
            "SELECT student_id, behavior_type, count(*) AS count FROM behavior GROUP BY 1, 2"
        ),
        "distinct_count": _raw(
            "SELECT count(*) AS distinct_values FROM (SELECT DISTINCT student_id FROM raw)"
        ),
        "device_distribution": _log(_distribution("behavior", "device_type", "device_type")),
        "weekend_split": _raw(
            _distribution(
                "raw",
                f"CASE WHEN isodow({day}) >= 6 THEN 1 ELSE 0 END",
                "is_weekend",
                f"WHERE {day} IS NOT NULL",
            )
        ),
        "reconcile_duration": _raw(
            """
SELECT *, total_duration = student_total AND total_duration = course_total AS consistent FROM (
  SELECT (SELECT CAST(sum(duration) AS BIGINT) FROM raw) AS total_duration,
         (SELECT CAST(sum(s) AS BIGINT) FROM (SELECT sum(duration) AS s FROM raw
          GROUP BY student_id)) AS student_total,
         (SELECT CAST(sum(s) AS BIGINT) FROM (SELECT sum(duration) AS s FROM raw
          GROUP BY course_id)) AS course_total)"""
        ),
        "partition_counts": _raw(
            f"SELECT CAST({day} AS VARCHAR) AS event_date, count(*) AS count FROM raw GROUP BY 1"
        ),
        "latest_names": _log(_latest_name("course_id", "student_name")),
        "row_count": _raw("SELECT count(*) AS total_records FROM raw"),
        # rankings
        "student_ranking": _log(_ranking("total_hours DESC, student_id, student_name")),
        "student_ranking_realtime": _log(_ranking("total_seconds DESC, student_id")),
        "rank_courses": _log(ranked.format(key="student_count", m=course_metrics)),
        "rank_courses_by_time": _log(ranked.format(key="total_duration", m=course_metrics)),
        "dedup": _raw(_first_per_key("raw")),
        "dwd": _raw(dwd),
        "sort_logs": _raw(
            'SELECT record_id, "timestamp" FROM raw ORDER BY "timestamp", record_id'
        ),
        "top_k": _log(
            f"SELECT * FROM ({_hours_by_student()}) ORDER BY total_seconds, student_id LIMIT 20"
        ),
        "sample_rows": _log("SELECT * FROM behavior ORDER BY record_id LIMIT 5"),
        # alerts
        "low_engagement": _log(_low(5.0, 2.0)),
        "low_engagement_tight": _log(_low(3.0, 2.5)),
        "low_engagement_realtime": _log(_low_realtime()),
        "inactive_students": _log(
            f"SELECT * FROM ({inactive.format(keys='student_id', as_of='2024-02-05')}) "
            "WHERE inactive_days >= 7"
        ),
        "inactive_level": _log(
            f"""
SELECT *, CASE WHEN inactive_days >= 14 THEN '高' WHEN inactive_days >= 10 THEN '中'
               ELSE '低' END AS level
FROM ({pair_inactive}) WHERE inactive_days >= 7"""
        ),
        "low_duration": _log(
            "SELECT student_id, course_id, CAST(sum(duration) AS BIGINT) AS total_duration "
            "FROM behavior GROUP BY 1, 2 HAVING sum(duration) < 1800"
        ),
        "low_score": _log(f"SELECT * FROM ({avg_score}) WHERE avg_score < 60"),
        # quality
        "quality_report": _raw(report),
        "violations": _raw(
            f"SELECT record_id, ip_address FROM raw WHERE {rules['ip_format']}"
        ),
        "compare_counts": (
            "SELECT count(*) AS rows_before, count(*) AS rows_after, true AS equal FROM events"
        ),
        "csv_line_counts": "SELECT count(*) AS records, true AS one_header_each FROM events",
        "layer_counts": _raw(
            f"""
SELECT *, dwd_rows <= ods_rows AS not_increased FROM (
  SELECT (SELECT count(*) FROM raw) AS ods_rows, (SELECT count(*) FROM ({dwd})) AS dwd_rows)"""
        ),
        "json_roundtrip": whole_log,
        # streaming
        "stream_logs": whole_log,
        "split_lines": f"""
SELECT doc_id, length(piece) AS chars, md5(piece) AS digest FROM (
  SELECT doc_id, substr(text, start, {S.MAX_LINE_LENGTH}) AS piece
  FROM (SELECT doc_id, text,
               unnest(range(1, greatest(length(text), 1) + 1, {S.MAX_LINE_LENGTH})) AS start
        FROM documents))""",
        "parse_lines": _log(
            """
SELECT record_id, student_id, course_id, duration, "timestamp", score, NULL AS unread
FROM behavior
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, line FROM oplog""",
            OPLOG,
        ),
        "with_ingest_meta": _log(
            "SELECT record_id, true AS stamped, true AS named FROM behavior"
        ),
        "land_stream": _log(
            f"""
SELECT *, CAST(year({day}) AS INTEGER) AS year, CAST(month({day}) AS INTEGER) AS month,
       CAST(day({day}) AS INTEGER) AS day
FROM behavior"""
        ),
        "running_fact": _log(fact),
        "snapshot_results": _flat(*FLAT_REALTIME),
        "incremental_refresh": _flat(*FLAT_BATCH),
        "compact": _flat(*FLAT_BATCH),
        "extra_fields": _log(
            """
SELECT record_id, duration, CAST(record_id AS BIGINT) % 1000 AS seat, chapter_id AS unit,
       duration * 2 AS ticks, behavior_type AS tag, CAST(NULL AS VARCHAR) AS absent
FROM behavior"""
        ),
        # generation
        "synth_b8": _synth_b8(),
        "synth_b11": _synth_b11(),
        "synth_b22": _synth_b22(),
        "draws": "SELECT event_id AS row_id, "
        + ", ".join(f"{u[i]} AS u{i}" for i in range(5))
        + " FROM events",
        "weighted": f"SELECT event_id AS row_id, {_weighted(u[0], S.BEHAVIOR_WEIGHTS)} "
        f"AS behavior_type, {_weighted(u[1], S.DEVICE_WEIGHTS)} AS device_type FROM events",
        "triangular": f"SELECT event_id AS row_id, {_triangular(u[0], 300, 7200, 2400)} AS seconds "
        "FROM events",
        "score": _log(
            f"SELECT record_id, {_score('behavior_type', u_record[0], u_record[1], 15)} AS score, "
            + _score("behavior_type", u_record[0], u_record[1], 12, (u_record[2], u_record[3]))
            + " AS score_with_fails FROM behavior"
        ),
        "weighted_ts": _with(
            f"SELECT event_id AS row_id, {_text('event_ts')} AS event_ts FROM timed",
            SLOTS,
            _timed(u[0], u[1]),
        ),
        "chapter": "SELECT event_id AS row_id, "
        + _chapter("(user_id % 8 + 9)", "(user_id % 17 + 1)", u[0])
        + " AS chapter_id FROM events",
        "pick": f"""
SELECT event_id AS row_id, {_pick(u[0], S.BROWSERS)} AS browser,
       {_pick(u[1], S.OPERATING_SYSTEMS)} AS os, {_pick(u[2], S.MAJORS)} AS major,
       {_campus_ip(u[3], u[4], u[5])} AS campus_ip, {_private_ip(u[6], u[7])} AS private_ip
FROM events""",
        # operational log
        "parse_oplog": _with(
            parsed_line.replace(
                "FROM oplog", "FROM (SELECT line FROM oplog UNION ALL SELECT props FROM events)"
            ),
            OPLOG,
        ),
        "search_oplog": _with(
            f"SELECT * FROM ({parsed_line}) WHERE module IN ('HDFS', 'YARN') AND level = 'INFO' "
            "AND contains(line, 'event 1')",
            OPLOG,
        ),
        "latest": _with(
            f"SELECT * FROM ({parsed_line}) ORDER BY ts DESC, line DESC LIMIT 100", OPLOG
        ),
        "observe_job": (
            "SELECT 'land' AS job, count(*) AS records, 'succeeded' AS status FROM events"
        ),
    }
    found["clustered_scan"] = _log(
        "SELECT * FROM behavior WHERE student_id = 'STU_00000007' "
        "AND \"timestamp\" >= '2024-01-16 00:00:00'"
    )
    found["clustered_log"] = _raw("SELECT * FROM raw")
    # An entry is its first line and the lines of its trace.
    step = "'  at step ' || i || ' of ' || props"
    entries = f"""
SELECT p.ts, p.level, p.module, p.message, t.n + 1 AS n_lines,
       CAST(length(p.line) + t.chars AS BIGINT) AS n_chars, t.n
FROM ({parsed_line}) p JOIN (
  SELECT event_id, count(i) AS n, coalesce(sum(length({step})), 0) AS chars
  FROM events LEFT JOIN range(1, 4) r(i) ON event_type = 'error' AND i <= event_id % 4
  GROUP BY event_id) t ON p.message = 'event ' || t.event_id"""
    columns = "ts, level, module, message, n_lines, n_chars"
    found["log_entries"] = _with(f"SELECT {columns} FROM ({entries})", OPLOG)
    found["search_entries"] = _with(f"SELECT {columns} FROM ({entries}) WHERE n = 3", OPLOG)
    # Other ways to the same rows.
    same = {
        "roll_landed": "land_stream",
        "dedup_batches": "dwd",
        "summary_bitmaps": "summary",
        "popularity_bitmaps": "course_popularity",
        "tree_diff": "lost_keys",
        "watch_stream": "quality_report",
        "search_index": "search_oplog",
    }
    return found | {name: found[other] for name, other in same.items()}
