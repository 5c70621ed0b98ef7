"""The same results in plain SQL, written from the rules and not from the plans.

Each statement reads the generated tables and spells out, with joins and
windows over whole groups, what the corresponding query must give.
"""

from __future__ import annotations

_EV = """ev AS (
  SELECT *, lpad(hex(user_id), 8, '0') AS pid,
         'P' || user_id || '_' || lpad(hex(user_id), 8, '0') AS patient_id,
         epoch_us(ts) // 1000 AS ms,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso,
         strftime(ts, '%Y-%m-%d %H:%M') AS minute,
         strftime(ts, '%y%m%d') AS yymmdd,
         CASE event_type WHEN 'click' THEN 'garmin-device-heart-rate'
           WHEN 'error' THEN 'garmin-connect-sleep-stage' WHEN 'view' THEN 'garmin-device-step'
           WHEN 'signup' THEN 'garmin-device-respiration' WHEN 'purchase' THEN 'garmin-device-stress' END AS kind
  FROM events)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([_EV, *ctes]) + "\n"


def _file(kind: str) -> str:
    """The path of a reading's file."""
    return f"patient_id || '/' || {kind} || '/' || yymmdd || '_' || {kind} || '_' || patient_id || '.csv'"


_PATHS = """pth AS (
  SELECT *, CASE k % 6
    WHEN 0 THEN patient_id || '/' || kind || '/' || nm || '.csv'
    WHEN 1 THEN patient_id || '/questionnaire/Physical-Capacity-Aw_6274612c/' || nm || '.csv'
    WHEN 2 THEN patient_id || '/questionnaire/Mood_1/' || nm || '.csv'
    WHEN 3 THEN patient_id || '/garmin-device-bbi/' || nm || '.csv.gz'
    WHEN 4 THEN patient_id || '/garmin-device-pulse-ox/' || nm || '.v1.csv'
    ELSE 'error_logs/' || nm || '.txt' END AS path
  FROM (SELECT *, yymmdd || '_r_' || patient_id AS nm FROM ev))"""

ORACLE: dict[str, str] = {}

# --- scalar functions -------------------------------------------------------

ORACLE["iso_minute"] = _with() + """
SELECT event_id, CASE k % 6 WHEN 4 THEN NULL WHEN 5 THEN strftime(ts, '%Y-%m-%d 00:00') ELSE minute END AS minute
FROM ev"""

ORACLE["iso_second"] = _with() + """
SELECT event_id, CASE k % 6 WHEN 4 THEN strftime(ts, 'bad-%Y-%m-%d') WHEN 5 THEN strftime(ts, '%Y-%m-%d 00:00:00')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS second
FROM ev"""

ORACLE["iso_date"] = _with() + """
SELECT event_id, CASE WHEN k % 6 <> 4 THEN strftime(ts, '%Y-%m-%d') END AS day FROM ev"""

ORACLE["time_of_day"] = _with() + """
SELECT event_id, CASE WHEN k % 6 = 4 THEN 'unknown' WHEN k % 6 = 5 THEN 'night'
  WHEN hour(ts) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'noon'
  WHEN hour(ts) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS part
FROM ev"""

ORACLE["epoch_day_time"] = _with() + """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS time, minute FROM ev"""

ORACLE["participant_id"] = _with(_PATHS) + """
SELECT event_id, CASE WHEN k % 6 IN (0, 1, 2) THEN pid END AS participant_id,
       CASE WHEN k % 6 IN (0, 1, 2, 3) THEN pid END AS participant_id_gz
FROM pth"""

ORACLE["path_columns"] = _with(_PATHS) + """
SELECT event_id, split_part(path, '/', 1) AS patient_id, split_part(path, '/', 2) AS data_type,
  CASE WHEN k % 6 <> 5 THEN split_part(path, '/', 3) END AS file_name,
  b AS base_name, left(path, length(path) - length(b) - 1) AS folder,
  left(b, length(b) - strpos(reverse(b), '.')) AS stem,
  CASE WHEN k % 6 <> 5 THEN split_part(path, '/', 2) || '/' || split_part(path, '/', 3) END AS file_id,
  split_part(path, '/', 1) || '#' || strftime(ts, '%Y-%m-%d') AS batch_key,
  split_part(path, '/', 1) || '/questionnaire/' || left(b, length(b) - strpos(reverse(b), '.')) || '_cleaned.csv' AS clean_path
FROM (SELECT *, list_extract(string_split(path, '/'), -1) AS b FROM pth)"""

ORACLE["route_files"] = _with() + """
SELECT event_id, CASE k % 6 WHEN 1 THEN 'survey' WHEN 4 THEN 'others' ELSE
  CASE event_type WHEN 'click' THEN 'heart-rate' WHEN 'error' THEN 'sleep' WHEN 'view' THEN 'step' ELSE 'others' END
  END AS route
FROM ev WHERE k % 6 IN (0, 1, 4)"""

ORACLE["minute_keys"] = _with() + """
SELECT event_id, pid || '_' || m AS key, pid AS participant_id, m AS timestamp
FROM (SELECT *, CASE k % 6 WHEN 4 THEN 'None' WHEN 5 THEN strftime(ts, '%Y-%m-%d 00:00') ELSE minute END AS m FROM ev)"""

# --- sources ----------------------------------------------------------------

ORACLE["arrival_json"] = _with(_PATHS) + """
SELECT event_id, CASE WHEN k % 5 < 3 THEN 'in' END AS bucket,
       CASE WHEN k % 5 < 3 THEN path || ' (' || event_type || ')' END AS object_key
FROM pth"""

ORACLE["parse_preamble"] = _with() + f"""
SELECT {_file("kind")} AS source_file, event_id, iso AS "isoDate", CAST(ms AS VARCHAR) AS "unixTimestampInMs",
  CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) AS "beatsPerMinute", 'VALID' AS status,
  'WATCH' AS "deviceType", 'UTC' AS timezone
FROM ev WHERE event_type = 'click'"""

_TALK = """talk AS (
  SELECT *, '2025-03-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') AS sday,
         lpad(CAST(turn * 5 % 24 AS VARCHAR), 2, '0') AS shour,
         'S' || conv_id || '/questionnaire/form_' || conv_id || '.csv' AS source_file
  FROM conversations)"""

ORACLE["parse_marker_header"] = f"""WITH {_TALK}
SELECT source_file, 'UTC' AS timezone, '1' AS "unixTimestampInMs", sday || 'T' || shour || ':30:15Z' AS "isoDate",
       role, nullif(text, '') AS answer
FROM talk"""

ORACLE["parse_bbi_header"] = _with() + f"""
SELECT {_file("'garmin-device-bbi'")} AS source_file, ms AS "unixTimestampInMs", round(value + 600, 4) AS bbi FROM ev"""

ORACLE["parse_bbi_pairs"] = _with() + f"""
SELECT {_file("'garmin-device-bbi'")} AS source_file, event_id * 2 AS line_no, 'America/New_York' AS timezone,
  CAST(ms AS VARCHAR) AS "unixTimestampInMs"
FROM ev"""

ORACLE["parse_single_column"] = _with() + f"""
SELECT {_file("'garmin-device-bbi'")} AS source_file, event_id * 2 AS line_no, 'America/New_York' AS data FROM ev
UNION ALL
SELECT {_file("'garmin-device-bbi'")}, event_id * 2 + 1, CAST(ms AS VARCHAR) FROM ev"""

ORACLE["decode_cascade"] = r"""
SELECT doc_id, CAST(i - 1 AS BIGINT) AS line_no, parts[i] AS line
FROM (SELECT doc_id, string_split(CASE doc_id % 3 WHEN 0 THEN text ELSE
    regexp_replace(text, '[^\x09\x0a\x20-\x7e\x{a0}-\x{ff}]', '?', 'g') || CASE doc_id % 3 WHEN 1 THEN ' €“x”' ELSE ' ' || chr(129) END
  END, chr(10)) AS parts FROM documents) d,
     unnest(generate_series(1, len(parts))) AS u(i)"""

ORACLE["manifest"] = _with(_PATHS) + """
SELECT path, CAST(floor(value) AS BIGINT) AS size, patient_id, split_part(path, '/', 2) AS data_type,
       split_part(path, '/', 3) AS file_name
FROM pth WHERE k % 6 IN (0, 4) AND floor(value) > 0"""

ORACLE["patients"] = _with(_PATHS) + """
SELECT DISTINCT patient_id FROM pth WHERE k % 6 <> 5"""

ORACLE["bbi_paths"] = _with(_PATHS) + """
SELECT DISTINCT path, CAST(floor(value) AS BIGINT) AS size FROM pth WHERE k % 6 = 3 AND floor(value) > 0"""

ORACLE["expected_counts"] = _with() + """
SELECT patient_id, kind AS data_type, CAST(sum(CASE WHEN event_id % 97 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS expected
FROM ev WHERE value >= 1 GROUP BY ALL"""

# --- cleaners ---------------------------------------------------------------

_CLEAN_HR = f"""hr AS (
  SELECT pid AS participant_id, minute AS "Timestamp", ms AS "unixTimestampInMs",
    CAST(floor(value) AS INTEGER) AS "beatsPerMinute", pid || '_' || minute AS participantid_timestamp,
    {_file("kind")} AS source_file, event_id AS line_no
  FROM ev WHERE event_type = 'click')"""

ORACLE["clean_heart_rate"] = _with(_CLEAN_HR) + "SELECT * FROM hr"

ORACLE["stack_files"] = _with(_CLEAN_HR) + """
SELECT participant_id, "Timestamp" AS timestamp, "unixTimestampInMs", "beatsPerMinute", participantid_timestamp,
  source_file, line_no FROM hr"""

_STEPS = f"""coarse AS (
  SELECT pid, strftime(ts, '%Y-%m-%d 00:00') AS m, epoch_us(date_trunc('day', ts)) // 1000 AS ms0,
    CAST(floor(floor(value) / 50) AS INTEGER) AS steps, {_file("kind")} AS source_file, event_id
  FROM ev WHERE event_type = 'view'),
steps AS (
  SELECT pid AS participant_id, m AS "Timestamp", ms0 AS "unixTimestampInMs", steps, steps * 10 AS "totalSteps",
    pid || '_' || m AS participantid_timestamp, source_file, min(event_id) AS line_no
  FROM coarse GROUP BY pid, m, ms0, steps, source_file)"""

ORACLE["clean_step_dedup"] = _with(_STEPS) + "SELECT * FROM steps"

ORACLE["clean_other"] = _with() + f"""
SELECT pid AS participant_id, ms AS "unixTimestampInMs", minute AS "Timestamp",
  CAST(floor(value) AS INTEGER) AS "breathsPerMinute", pid || '_' || minute AS participantid_timestamp,
  {_file("kind")} AS source_file, event_id AS line_no
FROM ev WHERE event_type = 'signup'"""

_AUDIT = """files AS (
  SELECT source_file, i.n AS rows_in, o.n AS rows_out, i.n - o.n AS removed
  FROM (SELECT source_file, count(*) AS n FROM coarse GROUP BY 1) i
  JOIN (SELECT source_file, count(*) AS n FROM steps GROUP BY 1) o USING (source_file))"""

ORACLE["file_audit"] = _with(_STEPS, _AUDIT) + """
SELECT source_file, rows_in, rows_out, removed, CAST(NULL AS VARCHAR) AS reason FROM files"""

ORACLE["run_totals"] = _with(_STEPS, _AUDIT) + """
SELECT count(*) AS processed_files, CAST(0 AS BIGINT) AS failed_files, CAST(sum(rows_in) AS BIGINT) AS rows_in,
  CAST(sum(rows_out) AS BIGINT) AS rows_out, CAST(sum(removed) AS BIGINT) AS removed FROM files"""

ORACLE["file_rejects"] = _with() + f"""
SELECT source_file, 'no data rows' AS reason
FROM (SELECT {_file("kind")} AS source_file, max(floor(value)) AS top FROM ev WHERE event_type = 'purchase' GROUP BY 1)
WHERE top < 10"""

# --- sleep ------------------------------------------------------------------


def _sleep(duration: str) -> str:
    """Stages with file facts: row index, unit, whether the file expands."""
    return f"""st AS (
  SELECT pid, {_file("kind")} AS source_file, event_id, ms, ['light', 'deep', 'rem'][k % 3 + 1] AS type, minute,
    CAST({duration} AS DOUBLE) AS d
  FROM ev WHERE event_type = 'error'),
med AS (SELECT source_file, median(d) AS m, count(*) AS n, max(d) AS top FROM st GROUP BY 1),
su AS (
  SELECT st.*, CASE WHEN n > 1 AND m > 0 AND m < 1000 THEN d * 1000 ELSE d END AS dur, top > 0 AS grows,
    row_number() OVER (PARTITION BY source_file ORDER BY event_id) - 1 AS row_index
  FROM st JOIN med USING (source_file)),
grown AS (
  SELECT su.*, greatest(1, CAST(ceil(dur / 60000) AS BIGINT)) AS total, i, ms + i * 60000 AS arrived
  FROM su, LATERAL (SELECT unnest(generate_series(0, greatest(1, CAST(ceil(dur / 60000) AS BIGINT)) - 1)) AS i) g
  WHERE grows AND dur > 0)"""


_MINUTE_OF = "strftime(make_timestamp(arrived * 1000), '%Y-%m-%d %H:%M')"

_SLEEP_ROWS = f"""slept AS (
  SELECT pid AS participant_id, type, pid AS "sleepSummaryId", arrived AS "unixTimestampInMs",
    CAST(60000 AS BIGINT) AS "durationInMs", CAST(1.0 AS DOUBLE) AS "TimeInMin", i + 1 AS "minuteIndex",
    total AS "originalDurationMinutes", row_index AS "originalIndex", {_MINUTE_OF} AS "Timestamp",
    pid || '_' || {_MINUTE_OF} AS participantid_timestamp, source_file, event_id AS line_no
  FROM grown)"""

ORACLE["sleep_expand"] = _with(_sleep("floor(value * 1000)"), _SLEEP_ROWS) + "SELECT * FROM slept"

ORACLE["sleep_unit_inference"] = _with(_sleep("floor(floor(value * 1000) / 100)")) + """
SELECT source_file, event_id AS line_no, i + 1 AS "minuteIndex", total AS "originalDurationMinutes",
  arrived AS "unixTimestampInMs" FROM grown
UNION ALL
SELECT source_file, event_id, NULL, NULL, ms FROM su WHERE NOT grows"""

ORACLE["sleep_defaults"] = _with(_sleep("60000")) + """
SELECT pid AS participant_id, 'light' AS type, pid AS "sleepSummaryId", (ms // 1000) * 1000 AS "unixTimestampInMs",
  CAST(60000 AS BIGINT) AS "durationInMs", CAST(1.0 AS DOUBLE) AS "TimeInMin", CAST(1 AS BIGINT) AS "minuteIndex",
  CAST(1 AS BIGINT) AS "originalDurationMinutes", row_index AS "originalIndex", minute AS "Timestamp",
  pid || '_' || minute AS participantid_timestamp, source_file, event_id AS line_no
FROM su"""

ORACLE["sleep_fallback"] = _with(_sleep("floor(value * 1000) - 60000")) + """
SELECT pid AS participant_id, source_file, event_id AS line_no, arrived AS "unixTimestampInMs",
  CAST(60000 AS BIGINT) AS "durationInMs", i + 1 AS "minuteIndex", row_index AS "originalIndex"
FROM grown
UNION ALL
SELECT pid, source_file, event_id, ms, CAST(dur AS BIGINT), NULL, NULL FROM su WHERE NOT grows"""

# --- alignment --------------------------------------------------------------


def _readings(grain: str) -> str:
    fmt = {"minute": "%Y-%m-%d %H:%M", "hour": "%Y-%m-%d %H", "day": "%Y-%m-%d"}[grain]
    one = "SELECT pid, strftime(ts, '" + fmt + "') AS t, ms AS e"
    whole = "CAST(floor(value) AS INTEGER)"
    return f"""r_hr AS ({one}, {whole} AS bpm FROM ev WHERE event_type = 'click'),
r_sl AS ({one}, CAST(floor(value * 1000) AS BIGINT) AS dur, ['light', 'deep', 'rem'][k % 3 + 1] AS typ FROM ev WHERE event_type = 'error'),
r_st AS ({one}, {whole} AS steps, {whole} * 10 AS total FROM ev WHERE event_type = 'view'),
r_re AS ({one}, {whole} AS breaths FROM ev WHERE event_type = 'signup'),
r_ss AS ({one}, {whole} AS stress FROM ev WHERE event_type = 'purchase')"""


_ALL = ["hr", "sl", "st", "re", "ss"]


def _chain(types: list[str]) -> str:
    """The literal chain: full outer joins of distinct keys, then left joins."""
    first, rest = types[0], types[1:]
    sql = f"sp AS (SELECT pid, t, coalesce({', '.join('e_' + x for x in types)}) AS e FROM "
    sql += f"(SELECT DISTINCT pid, t, e AS e_{first} FROM r_{first}) s_{first}"
    for x in rest:
        sql += f" FULL OUTER JOIN (SELECT DISTINCT pid, t, e AS e_{x} FROM r_{x}) s_{x} USING (pid, t)"
    sql += "),\nmerged AS (SELECT sp.pid, sp.t, sp.e"
    cells = {"hr": ["bpm"], "sl": ["dur", "typ"], "st": ["steps", "total"], "re": ["breaths"], "ss": ["stress"]}
    for x in _ALL:
        for c in cells[x]:
            default = "'none'" if c == "typ" else "0"
            sql += f", coalesce(r_{x}.{c}, {default}) AS {c}" if x in types else f", {default} AS {c}"
    sql += " FROM sp" + "".join(
        f" LEFT JOIN r_{x} ON sp.pid = r_{x}.pid AND sp.t = r_{x}.t" for x in types
    ) + ")"
    return sql


_ALIGNED = """
SELECT pid || '_' || t AS participantid_timestamp, pid || '_' || strftime(make_timestamp(e * 1000), '%Y-%m-%d') AS "participantId_date",
  pid AS participant_id, t AS timestamp, e AS "unixTimestampInMs",
  strftime(make_timestamp(e * 1000), '%Y-%m-%d') AS day, strftime(make_timestamp(e * 1000), '%H:%M:%S') AS time,
  CAST(bpm AS INTEGER) AS "beatsPerMinute", CAST(stress AS INTEGER) AS "stressLevel", CAST(steps AS INTEGER) AS steps,
  CAST(total AS INTEGER) AS "totalSteps", CAST(breaths AS INTEGER) AS "breathsPerMinute", CAST(0 AS INTEGER) AS spo2,
  CAST(dur AS BIGINT) AS "durationInMs", typ AS "sleepType"
FROM merged"""

ORACLE["align_metrics"] = _with(_readings("minute"), _chain(_ALL)) + _ALIGNED
ORACLE["align_fanout"] = _with(_readings("hour"), _chain(_ALL)) + _ALIGNED
ORACLE["align_crowded"] = ORACLE["align_fanout"]
ORACLE["align_defaults"] = _with(_readings("hour"), _chain(["hr", "ss"])) + _ALIGNED

_CODES = {"hr": 0, "sl": 1, "st": 2, "re": 3, "ss": 4}
_SPINE = "every AS (" + " UNION ALL ".join(
    f"SELECT pid, t, e, {i} AS kind FROM r_{x}" for x, i in _CODES.items()
) + """),
counted AS (SELECT pid AS participant_id, t AS timestamp, """ + ", ".join(
    f"count(DISTINCT e) FILTER (kind = {i}) AS d{i}, count(*) FILTER (kind = {i}) AS n{i}" for i in range(6)
) + " FROM every GROUP BY 1, 2)"

ORACLE["align_spine"] = _with(_readings("day"), _SPINE) + "SELECT * FROM counted"
ORACLE["align_row_counts"] = _with(_readings("day"), _chain(_ALL)) + """
SELECT pid AS participant_id, t AS timestamp, CAST(count(*) AS DOUBLE) AS rows FROM merged GROUP BY 1, 2"""

_LATEST = ",\n".join(
    f"r_{x} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pid, t ORDER BY e DESC, {o} DESC) AS rn "
    f"FROM q_{x}) WHERE rn = 1)"
    for x, o in {"hr": "bpm", "sl": "dur DESC, typ", "st": "steps", "re": "breaths", "ss": "stress"}.items()
)
ORACLE["align_latest"] = (
    _with(_readings("day").replace("r_", "q_"), _LATEST, _chain(_ALL)) + _ALIGNED
)

_CLEANED = """r_hr AS (SELECT pid, minute AS t, ms AS e, CAST(floor(value) AS INTEGER) AS bpm FROM ev WHERE event_type = 'click'),
r_st AS (SELECT DISTINCT pid, minute AS t, ms AS e, CAST(floor(value) AS INTEGER) AS steps, CAST(floor(value) AS INTEGER) * 10 AS total
  FROM ev WHERE event_type = 'view'),
r_sl AS (SELECT participant_id AS pid, "Timestamp" AS t, "unixTimestampInMs" AS e, "durationInMs" AS dur, type AS typ FROM slept),
r_re AS (SELECT pid, minute AS t, ms AS e, CAST(floor(value) AS INTEGER) AS breaths FROM ev WHERE event_type = 'signup'),
r_ss AS (SELECT pid, minute AS t, ms AS e, CAST(floor(value) AS INTEGER) AS stress FROM ev WHERE event_type = 'purchase')"""
ORACLE["align_cleaned"] = (
    _with(_sleep("floor(value * 1000)"), _SLEEP_ROWS, _CLEANED, _chain(_ALL)) + _ALIGNED
)
ORACLE["align_files"] = ORACLE["align_cleaned"]

ORACLE["merged_names"] = _with(_readings("hour"), _chain(_ALL)) + """
SELECT pid AS participant_id, 'merged_file_' || strftime(make_timestamp(max(e) * 1000), '%Y%m%d') || '.csv' AS merged_file
FROM merged GROUP BY 1"""

# --- intervals --------------------------------------------------------------

_BBI = _file("'garmin-device-bbi'")
_W = "OVER (PARTITION BY source_file ORDER BY ms, event_id)"

_DERIVED = f"""raw AS (SELECT *, {_BBI} AS source_file FROM ev),
lagged AS (SELECT *, CAST(ms - lag(ms) {_W} AS DOUBLE) AS bbi FROM raw),
beats AS (SELECT *, lead(bbi) {_W} AS nxt FROM lagged WHERE bbi IS NOT NULL),
b AS (SELECT *, CASE WHEN nxt IS NULL THEN 0.0 ELSE bbi - nxt END AS bbi_diff FROM beats)"""

_NATIVE = f"""raw AS (SELECT *, {_BBI} AS source_file, value + 600 AS bbi FROM ev),
beats AS (SELECT *, lead(bbi) {_W} AS nxt, lag(bbi) {_W} AS prv FROM raw),
b AS (SELECT *, CASE WHEN nxt IS NULL THEN 0.0 ELSE bbi - nxt END AS bbi_diff FROM beats)"""

ORACLE["bbi_derive"] = _with(_DERIVED) + """
SELECT pid AS participant_id, source_file, event_id AS line_no, ms AS "unixTimestampInMs", bbi, bbi_diff FROM b"""

ORACLE["bbi_diff"] = _with(_NATIVE) + """
SELECT source_file, event_id AS line_no, round(bbi, 4) AS bbi, round(bbi_diff, 4) AS bbi_diff,
  round(bbi_diff * bbi_diff, 4) AS bbi_diff_squared FROM b"""

ORACLE["bbi_stats"] = _with(_DERIVED) + """
SELECT source_file, min(bbi) AS bbi_min, max(bbi) AS bbi_max, round(avg(bbi), 4) AS bbi_avg, count(*) AS row_count,
  count(*) FILTER (bbi < 200 OR bbi > 2000) AS implausible_bbi,
  count(*) FILTER (ms < 946684800000 OR ms > 4102444800000) AS implausible_epochs,
  avg(bbi) < 200 OR avg(bbi) > 2000 AS implausible_mean
FROM b GROUP BY 1"""


def _hrv(diff: str) -> str:
    return f"""sums AS (
  SELECT source_file, any_value(pid) AS pid, min(ms) AS start, arg_min(iso, (ms, event_id)) AS first_iso,
    round(coalesce(avg(bbi), 0), 4) AS mean_bbi, round(coalesce(stddev_samp(bbi), 0), 4) AS sdrr,
    round(coalesce(sqrt(avg(({diff}) * ({diff}))), 0), 4) AS rmssd,
    count(*) FILTER (({diff}) > 50) AS rr50, count({diff}) AS pairs, count(*) AS record_count
  FROM b GROUP BY 1),
hrv AS (
  SELECT pid || '_' || strftime(make_timestamp(start * 1000), '%Y-%m-%d') AS "participantId_date",
    pid AS participant_id, 'America/New_York' AS timezone, first_iso AS "isoDate", sdrr, rmssd, rr50,
    CASE WHEN pairs > 0 THEN round(rr50 / pairs * 100, 4) ELSE 0.0 END AS prr50, mean_bbi,
    CASE WHEN mean_bbi > 0 THEN round(60000.0 / mean_bbi, 4) ELSE 0.0 END AS heart_rate, record_count, source_file
  FROM sums)"""


ORACLE["hrv_summary"] = _with(_NATIVE, _hrv("bbi_diff")) + "SELECT * FROM hrv"
ORACLE["hrv_no_diff"] = _with(_NATIVE, _hrv("bbi - prv")) + "SELECT * FROM hrv"

ORACLE["hrv_missing"] = _with() + f"""
SELECT any_value(pid) || '_unknown' AS "participantId_date", 'America/New_York' AS timezone,
  arg_min(ms, event_id) AS "unixTimestampInMs", arg_min(iso, event_id) AS "isoDate", 0.0::DOUBLE AS sdrr, 0.0::DOUBLE AS rmssd,
  0::BIGINT AS rr50, 0.0::DOUBLE AS prr50, 0.0::DOUBLE AS mean_bbi, 0.0::DOUBLE AS heart_rate, count(*) AS record_count, source_file
FROM (SELECT *, {_BBI} AS source_file FROM ev) GROUP BY source_file"""

ORACLE["hrv_merge"] = _with(_NATIVE, _hrv("bbi_diff")) + """
SELECT "participantId_date", left("isoDate", 10) AS "isoDate", mean_bbi, record_count, folder,
  'merged_file_' || replace(max(left("isoDate", 10)) OVER (PARTITION BY folder), '-', '') || '.csv' AS merged_file
FROM (SELECT *, regexp_replace(source_file, '/[^/]*$', '') AS folder FROM hrv)"""

_FORM = "user_id % 4"
_THREE = f"""raw AS (SELECT *, {_BBI} AS source_file FROM ev WHERE {_FORM} <> 3),
lagged AS (SELECT *, CASE WHEN {_FORM} = 0 THEN value + 600 ELSE CAST(ms - lag(ms) {_W} AS DOUBLE) END AS bbi FROM raw),
beats AS (SELECT *, lead(bbi) {_W} AS nxt FROM lagged WHERE bbi IS NOT NULL),
b AS (SELECT *, CASE WHEN nxt IS NULL THEN 0.0 ELSE bbi - nxt END AS bbi_diff FROM beats)"""

ORACLE["interval_files"] = _with(_THREE, _hrv("bbi_diff")) + f"""
SELECT source_file, "participantId_date", participant_id,
  CASE WHEN {_FORM.replace("user_id", "('0x' || participant_id)::BIGINT")} < 2 THEN left("isoDate", 10) END AS "isoDate",
  sdrr, rmssd, rr50, prr50, mean_bbi, heart_rate, record_count, folder,
  CASE WHEN {_FORM.replace("user_id", "('0x' || participant_id)::BIGINT")} < 2
    THEN 'merged_file_' || replace(max(left("isoDate", 10)) OVER (PARTITION BY folder), '-', '') || '.csv'
    ELSE 'merged_file_20250101.csv' END AS merged_file
FROM (SELECT *, regexp_replace(source_file, '/[^/]*$', '') AS folder FROM hrv)
UNION ALL
SELECT source_file, pid || '_unknown', pid, NULL, 0.0, 0.0, 0, 0.0, 0.0, 0.0, count(*),
  regexp_replace(source_file, '/[^/]*$', ''), 'merged_file_20250101.csv'
FROM (SELECT pid, {_BBI} AS source_file FROM ev WHERE {_FORM} = 3) GROUP BY source_file, pid"""

_MIXED = f"""m AS (SELECT *, {_BBI} AS source_file,
  CASE WHEN k % 5 = 0 THEN '' ELSE CASE {_FORM} WHEN 0 THEN CAST(k AS VARCHAR) WHEN 1 THEN CAST(ms AS VARCHAR)
    WHEN 2 THEN printf('%.3f', value) ELSE iso END END AS mixed,
  CASE WHEN k % 3 = 0 THEN iso ELSE strftime(ts, '%Y-%m-%d') END AS at_text,
  CASE WHEN k = 1 THEN '1' END AS rare FROM ev)"""


def _column_types(file: str) -> str:
    known = "mixed <> ''"
    return f"""
SELECT {file} AS source_file, unnest(['whole', 'mixed', 'when', 'flag', 'word', 'rare']) AS "column",
  unnest(['int',
    CASE WHEN count(*) FILTER ({known}) = 0 THEN 'string'
      WHEN bool_and(mixed SIMILAR TO '[0-9]+') FILTER ({known}) AND max(TRY_CAST(mixed AS BIGINT)) < 2147483648 THEN 'int'
      WHEN bool_and(mixed SIMILAR TO '[0-9]+') FILTER ({known}) THEN 'bigint'
      WHEN bool_and(TRY_CAST(mixed AS DOUBLE) IS NOT NULL) FILTER ({known}) THEN 'double'
      WHEN bool_and(TRY_CAST(mixed AS TIMESTAMP) IS NOT NULL) FILTER ({known}) THEN 'timestamp' ELSE 'string' END,
    CASE WHEN max(length(at_text)) = 10 THEN 'date' ELSE 'timestamp' END, 'boolean', 'string',
    CASE WHEN count(rare) > 0 THEN 'int' ELSE 'string' END]) AS "type"
FROM m GROUP BY {file}"""


ORACLE["column_types"] = _with(_MIXED) + _column_types("source_file") + "\nUNION ALL" + _column_types("'*'")

ORACLE["typed_cells"] = _with(_MIXED) + """
SELECT source_file, event_id AS line_no, CAST(k AS INTEGER) AS whole, CAST(at_text AS TIMESTAMP) AS "when", k % 2 = 0 AS flag,
  event_type AS word, CAST(rare AS INTEGER) AS rare
FROM m"""

ORACLE["run_summaries"] = _with(_THREE) + f"""
SELECT kind AS flow, count(DISTINCT {_file("kind")}) AS files_in, 0 AS files_rejected, count(*) AS rows_in,
  CASE kind WHEN 'garmin-connect-sleep-stage' THEN (SELECT count(*) FROM ({ORACLE["sleep_expand"]})) ELSE count(*) END AS rows_out,
  CASE kind WHEN 'garmin-connect-sleep-stage' THEN NULL ELSE 0 END AS removed
FROM ev WHERE kind IS NOT NULL GROUP BY kind
UNION ALL
SELECT 'intervals', (SELECT count(DISTINCT {_BBI}) FROM ev), 0, (SELECT count(*) FROM ev), n, (SELECT count(*) FROM ev) - n
FROM (SELECT (SELECT count(*) FROM b) + (SELECT count(*) FROM ev WHERE {_FORM} = 3) AS n)
UNION ALL
SELECT 'surveys', count(DISTINCT conv_id), 0, count(*), count(*), 0 FROM conversations"""

# --- questionnaires ---------------------------------------------------------

ORACLE["survey_normalise"] = f"""WITH {_TALK}
SELECT lpad(hex(conv_id), 8, '0') AS patient_id, 'UTC' AS timezone, sday || ' ' || shour || ':30:15' AS "isoDate", role,
  text AS answer, CASE WHEN shour BETWEEN '05' AND '11' THEN 'morning' WHEN shour BETWEEN '12' AND '16' THEN 'noon'
    WHEN shour BETWEEN '17' AND '20' THEN 'evening' ELSE 'night' END AS time_of_day, source_file
FROM talk"""

ORACLE["survey_files"] = f"""
SELECT split_part(source_file, '/', 1) AS patient_folder, * EXCLUDE (source_file) FROM ({ORACLE["survey_normalise"]})
WHERE source_file NOT LIKE '%7.csv'"""

ORACLE["survey_preamble"] = f"""WITH {_TALK}
SELECT DISTINCT source_file, lpad(hex(conv_id), 8, '0') AS patient_id FROM talk"""

_ROWS = f"""{_TALK},
ans AS (
  SELECT 'S' || conv_id % 20 AS patient_folder, sday || 'T' || shour || ':30:15Z' AS "isoDate", role,
    text AS answer
  FROM talk)"""

ORACLE["survey_merge"] = f"""WITH {_ROWS}
SELECT *, CASE WHEN role = 'user' THEN answer END AS mood FROM ans"""

ORACLE["survey_upsert"] = f"""WITH {_ROWS},
old AS (SELECT DISTINCT patient_folder FROM ans WHERE role = 'system')
SELECT DISTINCT * FROM (SELECT * FROM ans UNION ALL SELECT * FROM ans WHERE role = 'system')
WHERE patient_folder IN (SELECT patient_folder FROM old)
UNION ALL
SELECT * FROM ans WHERE patient_folder NOT IN (SELECT patient_folder FROM old)"""

ORACLE["survey_names"] = f"""WITH {_ROWS}
SELECT patient_folder, replace(min(left("isoDate", 10)), '-', '') || '_merged.csv' AS merged_file FROM ans GROUP BY 1"""

ORACLE["survey_batch_status"] = _with(_PATHS, """q AS (
  SELECT *, split_part(path, '/', 3) AS f FROM pth WHERE split_part(path, '/', 2) = 'questionnaire'),
came AS (SELECT patient_id, patient_id || '#' || strftime(ts, '%Y-%m-%d') AS batch_key, count(DISTINCT f) AS actual
  FROM q GROUP BY 1, 2),
want AS (SELECT patient_id, count(*) AS expected FROM q WHERE value >= 20 GROUP BY 1)""") + """
SELECT patient_id, batch_key, actual, coalesce(expected, 0) AS expected,
  CASE WHEN coalesce(expected, 0) > 0 AND actual >= expected THEN 'complete' ELSE 'processing' END AS status
FROM came LEFT JOIN want USING (patient_id)"""

# --- batch completion -------------------------------------------------------

_KINDS = ["garmin-device-heart-rate", "garmin-connect-sleep-stage", "garmin-device-step",
          "garmin-device-respiration", "garmin-device-stress", "garmin-device-pulse-ox"]

_SENT = """sent AS (
  SELECT event_id * 2 AS arrival_id, patient_id, kind, kind || '/f' || event_id || '.csv' AS file_id, k,
    make_timestamp(1706745600000000 + (epoch_us(ts) - 1704067200000000) // 31) AS arrived
  FROM ev),
came AS (
  SELECT arrival_id, patient_id, kind, file_id, arrived, patient_id || '#' || strftime(arrived, '%Y-%m-%d') AS batch_key FROM sent
  UNION ALL
  SELECT arrival_id + 1, patient_id, kind, file_id, arrived + INTERVAL 10 MINUTE,
    patient_id || '#' || strftime(arrived + INTERVAL 10 MINUTE, '%Y-%m-%d') FROM sent WHERE k >= 50),
want AS (SELECT patient_id, kind, CAST(sum(CASE WHEN event_id % 97 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS expected
  FROM ev WHERE value >= 1 GROUP BY 1, 2),
once AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_key, file_id ORDER BY arrived, arrival_id) AS rn FROM came) WHERE rn = 1)"""

# every distinct arrival with all types' running counts after it
_REPLAY = "replay AS (SELECT once.*, " + ", ".join(
    f"count(*) FILTER (kind = '{t}') OVER w AS a{i}, "
    f"coalesce((SELECT expected FROM want WHERE want.patient_id = once.patient_id AND want.kind = '{t}'), 0) AS x{i}"
    for i, t in enumerate(_KINDS)
) + """ FROM once WINDOW w AS (PARTITION BY batch_key ORDER BY arrived RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
done AS (SELECT batch_key, any_value(patient_id) AS patient_id, min(arrived) AS completed_at FROM replay WHERE """ + " AND ".join(
    f"(a{i} = 0 OR x{i} = 0 OR a{i} >= x{i})" for i in range(6)
) + " AND (" + " OR ".join(f"(a{i} > 0 AND x{i} > 0)" for i in range(6)) + ") GROUP BY 1)"

_COUNT_COLUMNS = ", ".join(
    f"count(*) FILTER (kind = '{t}') AS {t.replace('-', '_')}_count" for t in _KINDS
)

ORACLE["batch_counters"] = _with(_SENT) + f"""
SELECT batch_key, patient_id, {_COUNT_COLUMNS}, count(*) AS total_files FROM once GROUP BY 1, 2"""

ORACLE["batch_status"] = _with(_SENT, _REPLAY) + f"""
SELECT c.*, {", ".join(
    f"CASE WHEN {t.replace('-', '_')}_count > 0 THEN coalesce((SELECT expected FROM want WHERE want.patient_id = c.patient_id AND want.kind = '{t}'), 0) ELSE 0 END AS expected_{t.replace('-', '_')}_count"
    for t in _KINDS)},
  completed_at, CASE WHEN completed_at IS NULL THEN 'processing' ELSE 'complete' END AS status
FROM (SELECT batch_key, patient_id, {_COUNT_COLUMNS}, count(*) AS total_files FROM once GROUP BY 1, 2) c
LEFT JOIN (SELECT batch_key, completed_at FROM done) USING (batch_key)"""

ORACLE["batch_progress"] = _with(_SENT) + """
SELECT batch_key, kind AS data_type, count(*) || '/' || any_value(expected) AS progress
FROM once JOIN want USING (patient_id, kind) GROUP BY 1, 2"""

_FIRST = """fin AS (
  SELECT batch_key, any_value(done.patient_id) AS patient_id, any_value(completed_at) AS completed_at, count(*) AS total_files
  FROM done JOIN once USING (batch_key) WHERE arrived <= completed_at GROUP BY 1)"""

ORACLE["batch_first_complete"] = _with(_SENT, _REPLAY, _FIRST) + "SELECT * FROM fin"

_STRICT = _REPLAY.replace("a0 = 0 OR ", "").replace("a1 = 0 OR ", "").replace("a2 = 0 OR ", "").replace(
    "a3 = 0 OR ", "").replace("a4 = 0 OR ", "").replace("a5 = 0 OR ", "")
ORACLE["batch_manifest_mode"] = _with(_SENT, _STRICT, _FIRST) + "SELECT * FROM fin"

ORACLE["batch_outcomes"] = _with(_SENT, _REPLAY, """closing AS (
  SELECT batch_key, max(file_id) AS file_id FROM replay JOIN done USING (batch_key) WHERE arrived = completed_at
    AND CASE kind """ + " ".join(f"WHEN '{t}' THEN x{i} > 0 AND a{i} >= x{i}" for i, t in enumerate(_KINDS)) + """ END
  GROUP BY 1)""") + """
SELECT came.arrival_id, CASE WHEN once.arrival_id IS NULL THEN 'duplicate' WHEN closing.file_id IS NOT NULL THEN 'triggered'
  ELSE 'counted' END AS outcome
FROM came LEFT JOIN once ON came.arrival_id = once.arrival_id
LEFT JOIN closing ON came.batch_key = closing.batch_key AND came.file_id = closing.file_id"""

ORACLE["batch_events"] = _with(_SENT, _REPLAY, _FIRST) + """
SELECT batch_key, detail_type, '{"batchId":"' || patient_id || '","completedAt":"' || strftime(completed_at, '%Y-%m-%dT%H:%M:%S.%f')
  || '","status":"complete","totalFiles":' || total_files || ',"metadata":{"batchFolder":"' || patient_id
  || '"},"targetRule":"' || target || '"}' AS detail
FROM fin, (VALUES ('device', 'merge'), ('intervals', 'preprocess')) v(detail_type, target)"""

# --- streams ----------------------------------------------------------------

ORACLE["stream_dedup"] = _with(_SENT) + "SELECT batch_key, file_id FROM once"
ORACLE["stream_batch_status"] = ORACLE["batch_first_complete"]
ORACLE["stream_outcomes"] = ORACLE["batch_outcomes"]
ORACLE["stream_completions"] = ORACLE["batch_first_complete"]
ORACLE["stream_letters"] = _with() + """
SELECT event_id, t AS tries, CASE WHEN t > 5 THEN 'dead' ELSE 'again' END AS state
FROM (SELECT event_id, unnest(range(1, k % 8 + 2)) AS t FROM ev WHERE k % 5 >= 3)"""

_FORMS = """fs AS (
  SELECT event_id AS arrival_id, patient_id, 'questionnaire/f' || event_id // 2 || '.csv' AS file_id,
    make_timestamp(1706745600000000 + (epoch_us(ts) - 1704067200000000) // 31) AS arrived FROM ev),
fc AS (SELECT *, patient_id || '#' || strftime(arrived, '%Y-%m-%d') AS batch_key FROM fs),
fw AS (SELECT patient_id, count(DISTINCT event_id // 2) + count(DISTINCT CASE WHEN event_id % 97 = 0 THEN event_id // 2 END) AS expected
  FROM ev GROUP BY 1),
fo AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_key, file_id ORDER BY arrived, arrival_id) AS rn FROM fc) WHERE rn = 1),
fr AS (SELECT fo.*, count(*) OVER (PARTITION BY batch_key ORDER BY arrived RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM fo),
fd AS (SELECT batch_key, any_value(patient_id) AS patient_id, min(arrived) AS completed_at FROM fr JOIN fw USING (patient_id)
  WHERE n >= expected GROUP BY 1)"""

ORACLE["survey_first_complete"] = _with(_FORMS) + """
SELECT fd.batch_key, fd.patient_id, completed_at, count(*) AS total_files
FROM fd JOIN fo ON fo.batch_key = fd.batch_key AND arrived <= completed_at GROUP BY ALL"""
ORACLE["stream_survey_status"] = ORACLE["survey_first_complete"]

ORACLE["survey_outcomes"] = _with(_FORMS) + """
SELECT fc.arrival_id, CASE WHEN fo.arrival_id IS NULL THEN 'duplicate' WHEN w.file_id IS NOT NULL THEN 'triggered' ELSE 'counted' END AS outcome
FROM fc LEFT JOIN fo USING (arrival_id)
LEFT JOIN (SELECT fo.batch_key, max(file_id) AS file_id FROM fo JOIN fd ON fo.batch_key = fd.batch_key AND arrived = completed_at GROUP BY 1) w
  ON w.batch_key = fc.batch_key AND w.file_id = fc.file_id"""
