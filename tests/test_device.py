"""Cleaners, sleep expansion and alignment."""

import itertools
import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid.operators import align, cleaners, sleep
from vitalgrid.plans import device

FILE = "T_cd037752/x/250204_T_cd037752.csv"


def frame(spark, cols, rows, file=FILE):
    df = spark.createDataFrame([(*r, file, i) for i, r in enumerate(rows)],
                               ", ".join(f"{c} string" for c in cols) + ", source_file string, line_no bigint")
    return df


def test_heart_rate_columns(spark):
    cols = ["isoDate", "unixTimestampInMs", "heartRate", "status", "deviceType", "timezone"]
    df = cleaners.clean_heart_rate(frame(spark, cols, [("2025-01-01T10:00:00Z", "1", "72", "V", "D", "UTC"), (None,) * 6]))
    assert df.columns == ["participant_id", "Timestamp", "unixTimestampInMs", "heartRate", "participantid_timestamp",
                          "source_file", "line_no"]
    rows = df.orderBy("line_no").collect()
    assert rows[0]["participantid_timestamp"] == "cd037752_2025-01-01 10:00"
    assert rows[1]["participantid_timestamp"] == "cd037752_None"


def test_heart_rate_without_dates_has_no_key(spark):
    df = cleaners.clean_heart_rate(frame(spark, ["heartRate"], [("1",)]))
    assert "participantid_timestamp" not in df.columns
    assert align.prepare(df.drop("participant_id"), K.HEART_RATE) is None


@pytest.mark.parametrize("values,left", [("aba", 2), ("abc", 3), ("aaa", 1)])
def test_step_duplicates(spark, values, left):
    df = frame(spark, ["isoDate", "unixTimestampInMs", "steps"], [("2025-01-01T10:00:00Z", "1", v) for v in values])
    assert cleaners.clean_step(df).count() == left


def test_other_needs_both_dates(spark):
    with pytest.raises(ValueError):
        cleaners.clean_other(frame(spark, ["isoDate", "spo2"], [("x", "1")]))


def sleep_reference(rows):
    """Row loop over one file's (ms, duration text) pairs."""
    d = []
    for _, text in rows:
        try:
            d.append(float(text))
        except (TypeError, ValueError):
            d.append(60000.0)
    if len(d) > 1 and 0 < statistics.median(d) < 1000:
        d = [x * 1000 for x in d]
    out = [(ms + i * 60000, i + 1, max(1, math.ceil(x / 60000)), n)
           for n, ((ms, _), x) in enumerate(zip(rows, d)) if x > 0 for i in range(max(1, math.ceil(x / 60000)))]
    return out or [(ms, None, None, None) for ms, _ in rows]


@pytest.mark.parametrize("seed", range(6))
def test_sleep_against_row_loop(spark, seed):
    rnd = random.Random(seed)
    pick = [lambda: rnd.randrange(1, 999), lambda: rnd.randrange(-5, 2000), lambda: rnd.randrange(10**5, 10**6),
            lambda: rnd.choice([0, -1]), lambda: rnd.choice(["bad", None, "", 5]), lambda: rnd.choice([999, 1000, 1001, 1])][seed]
    files, want = [], Counter()
    for f in range(12):
        path = f"p/t/{f}_T_cd0377{f:02d}.csv"
        rows = [(1704142800000 + rnd.randrange(10**7), pick()) for _ in range(rnd.randrange(1, 6))]
        rows = [(ms, None if v is None else str(v)) for ms, v in rows]
        files += [(str(ms), v, path, i) for i, (ms, v) in enumerate(rows)]
        want.update((path, *r) for r in sleep_reference(rows))
    df = spark.createDataFrame(files, "unixTimestampInMs string, durationInMs string, source_file string, line_no bigint")
    got = Counter((r["source_file"], r["unixTimestampInMs"], r["minuteIndex"], r["originalDurationMinutes"], r["originalIndex"])
                  for r in sleep.clean_sleep(df, 0).collect())
    assert got == want


def test_sleep_expectations(spark):
    cols = ["isoDate", "unixTimestampInMs", "type", "durationInMs", "timezoneOffsetInMs"]
    rows = sleep.clean_sleep(frame(spark, cols, [("2025-01-01T22:00:00+05:00", "1704142800000", "deep", "180000", "0")]), 0)
    got = rows.orderBy("minuteIndex").collect()
    assert [(r["minuteIndex"], r["durationInMs"], r["TimeInMin"], r["Timestamp"]) for r in got] == [
        (i + 1, 60000, 1.0, f"2024-01-01 21:0{i}") for i in range(3)]
    assert got[0]["sleepSummaryId"] == "cd037752" and "isoDate" not in rows.columns


def test_sleep_defaults_and_formats(spark):
    bare = spark.createDataFrame([("f_abcdefgh.csv", 0)], "source_file string, line_no bigint")
    row = sleep.expand_minutes(bare, 777).first()
    assert (row["type"], row["durationInMs"], row["unixTimestampInMs"], row["sleepSummaryId"]) == ("light", 60000, 777, "sleep_session_1")
    texts = {"a": ["2024-01-01 10:00:00", "2024-01-01 10:01:00"], "b": ["01/02/2024 00:00:00"], "c": ["2024-01-01 10:00:00", "x"]}
    df = spark.createDataFrame([(t, f, i) for f, ts in texts.items() for i, t in enumerate(ts)],
                               "timestamp string, source_file string, line_no bigint")
    got = {(r["source_file"], r["line_no"]): r["unixTimestampInMs"] for r in sleep.expand_minutes(df, 5).collect()}
    assert got == {("a", 0): 1704103200000, ("a", 1): 1704103260000, ("b", 0): 1704153600000, ("c", 0): 5, ("c", 1): 5}


def test_long_stage_is_expanded_whole(spark):
    df = frame(spark, ["unixTimestampInMs", "durationInMs"], [("0", str(60000 * 5000))])
    got = sleep.clean_sleep(df, 0).agg(F.count("*"), F.max("minuteIndex"), F.countDistinct("unixTimestampInMs")).first()
    assert tuple(got) == (5000, 5000, 5000)


def brute_alignment(types):
    """Literal combinations per key over lists of (key, epoch, value)."""
    keys = defaultdict(lambda: [[] for _ in types])
    loose = set()
    for i, rows in enumerate(types):
        for k, e, v in rows:
            if k is None:
                loose.add((i if e is not None else None, e))
            else:
                keys[k][i].append((e, v))
    out = Counter()
    for k, lists in keys.items():
        epochs = [list({e for e, _ in rows}) or [None] for rows in lists]
        values = [[v for _, v in rows] or [0] for rows in lists]
        for es in itertools.product(*epochs):
            first = next((e for e in es if e is not None), None)
            for vs in itertools.product(*values):
                out[(k, first, *vs)] += 1
    for _, e in loose:
        out[(None, e, *[0] * len(types))] += 1
    return out


@pytest.mark.parametrize("seed,crowded,piece", [(0, 1024, 1 << 16), (0, 1, 1), (0, 1024, 1), (1, 1024, 1 << 16), (1, 1024, 3), (2, 2, 7), (3, 1, 2)])
def test_alignment_against_product(spark, seed, crowded, piece):
    rnd = random.Random(seed)
    chosen = [K.HEART_RATE, K.STRESS, K.PULSE_OX]
    types = [[(rnd.choice(["m1", "m2", "m3", None] if seed % 2 else ["m1", "m2", "m3", "m4"]),
               rnd.choice([None, 1, 2]), rnd.randrange(2)) for _ in range(rnd.randrange(1, 9))] for _ in chosen]
    metric = {K.HEART_RATE: "beatsPerMinute", K.STRESS: "stressLevel", K.PULSE_OX: "spo2"}
    frames = {t: spark.createDataFrame([("p", k, e, str(v)) for k, e, v in rows],
                                       f"participant_id string, timestamp string, unixTimestampInMs bigint, {metric[t]} string")
              for t, rows in zip(chosen, types)}
    got = Counter((r["timestamp"], r["unixTimestampInMs"], *[r[metric[t]] for t in chosen])
                  for r in align.aligned(frames, crowded=crowded, piece=piece).collect())
    assert got == brute_alignment(types)
    if not any(k is None for rows in types for k, _, _ in rows):
        assert align.expected_rows(frames).agg(F.sum("rows")).first()[0] == sum(got.values())


def test_fanout_of_sixteen(spark):
    make = lambda m, e0: spark.createDataFrame(
        [("p", "10:00", e0 + i, str(i)) for i in range(2)], f"participant_id string, timestamp string, unixTimestampInMs bigint, {m} string")
    frames = {K.HEART_RATE: make("bpm", 0), K.STEP: make("steps", 10)}
    assert align.aligned(frames).count() == 16
    assert align.aligned(frames, crowded=1).count() == 16
    assert align.aligned(frames, mode="latest").collect()[0]["beatsPerMinute"] == 1


def test_wide_key_is_cut_by_result_rows(spark):
    made = lambda m, n: spark.range(n).selectExpr(
        "'p' AS participant_id", "'None' AS timestamp", "CAST(NULL AS bigint) AS unixTimestampInMs", f"CAST(id AS string) AS {m}")
    frames = {K.HEART_RATE: made("beatsPerMinute", 1000), K.STRESS: made("stressLevel", 300)}
    assert align.expected_rows(frames).first()["rows"] == 300_000
    # more than a piece, and no list long enough for the join path
    rows = align.aligned(frames, piece=1 << 12)
    assert rows.groupBy("beatsPerMinute", "stressLevel").count().agg(F.count("*"), F.max("count")).first()[:] == (300_000, 1)
    per_task = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 150_000


def test_merge_expectations(spark):
    day = "2025-01-01 "
    def df(cols, rows):
        return spark.createDataFrame([("cd037752", day + t, *v) for t, *v in rows], ["participant_id", "timestamp", *cols])
    frames = {
        K.HEART_RATE: df(["heartRate"], [("10:00", "72"), ("10:01", "75.0"), ("10:02", "bad")]),
        K.STEP: df(["steps", "totalSteps"], [("10:00", 100, 5000), ("10:01", 150, 5150), ("10:02", 120, 5270)]),
        K.SLEEP: df(["durationInMs", "type"], [("22:00", 1800000, "light"), ("22:30", 3600000, "deep"), ("23:30", 1200000, "rem")]),
    }
    out = align.aligned(frames)
    assert out.columns == list(K.ALIGNED_COLUMNS)
    rows = {r["timestamp"][-5:]: r for r in out.collect()}
    assert len(rows) == 6 and rows["10:01"]["beatsPerMinute"] == 75 and rows["10:02"]["beatsPerMinute"] is None
    assert (rows["10:00"]["durationInMs"], rows["10:00"]["sleepType"], rows["10:00"]["day"]) == (0, "none", None)
    assert (rows["22:00"]["beatsPerMinute"], rows["22:00"]["steps"], rows["22:00"]["sleepType"]) == (0, 0, "light")
    no_type = align.aligned({K.SLEEP: frames[K.SLEEP].drop("type")}).first()
    assert no_type["sleepType"] == "unknown"


def test_raw_files_to_aligned(spark):
    pre = [f"p{i}" for i in range(6)]
    head = "isoDate,unixTimestampInMs,{},status,deviceType,timezone"
    files = {
        f"T_cd037752/{K.HEART_RATE}/1_cd037752.csv": [*pre, "", head.format("heartRate"), "2025-01-01T10:00:00Z,1704110400000,72,V,D,U", "2025-01-01T10:01:00Z,1704110460000,NA,V,D,U"],
        f"T_cd037752/{K.HEART_RATE}/2_cd037752.csv": [*pre, head.format("beatsPerMinute"), "2025-01-01T11:00:00Z,1704114000000,80,V,D,U"],
        f"T_cd037752/{K.HEART_RATE}/3_cd037752.csv": [*pre, head.format("beatsPerMinute")],
        f"T_cd037752/{K.HEART_RATE}/nobody.csv": [*pre, "a", "b"],
        f"T_cd037752/{K.PULSE_OX}/1_cd037752.csv": [*pre, "spo2,isoDate", "95,2025-01-01T10:00:00Z"],
        f"T_cd037752/{K.SLEEP}/1_cd037752.csv": [*pre, "isoDate,unixTimestampInMs,type,durationInMs", "2025-01-01T22:00:00Z,1704142800000,light,120000"],
    }
    lines = spark.createDataFrame([(f, i, t) for f, ts in files.items() for i, t in enumerate(ts)], "source_file string, line_no bigint, line string")
    rows, bad = device.run(lines, 0)
    got = {r["timestamp"]: (r["beatsPerMinute"], r["durationInMs"], r["sleepType"], r["day"]) for r in rows.collect()}
    assert got == {
        "2025-01-01 10:00": (72, 0, "none", "2024-01-01"), "2025-01-01 10:01": (0, 0, "none", "2024-01-01"),
        "2025-01-01 11:00": (80, 0, "none", "2024-01-01"),
        "2024-01-01 21:00": (0, 60000, "light", "2024-01-01"), "2024-01-01 21:01": (0, 60000, "light", "2024-01-01")}
    reasons = {r["source_file"].split("/", 1)[1]: r["reason"] for r in bad.collect()}
    assert reasons == {f"{K.HEART_RATE}/3_cd037752.csv": "no data rows", f"{K.HEART_RATE}/nobody.csv": "no participant id in file name",
                       f"{K.PULSE_OX}/1_cd037752.csv": "file is rejected: no column unixTimestampInMs"}


def test_types_are_read_from_their_own_folders(spark, tmp_path):
    pre = "\n".join(f"p{i}" for i in range(6))
    for t, head, row in ((K.HEART_RATE, "isoDate,unixTimestampInMs,heartRate", "2025-01-01T10:00:00Z,1704110400000,72"),
                         (K.STRESS, "isoDate,unixTimestampInMs,stressLevel", "2025-01-01T10:00:00Z,1704110400000,9")):
        folder = tmp_path / "T_cd037752" / t
        folder.mkdir(parents=True)
        (folder / "1_cd037752.csv").write_text(f"{pre}\n{head}\n{row}\n")
        (folder / "nobody.csv").write_text("x")
    by_type = device.read_types(spark, str(tmp_path))
    assert set(by_type) == {K.HEART_RATE, K.STRESS}
    parts, bad = device.clean_files(by_type[K.STRESS], K.STRESS, 0)
    (df,) = parts
    assert {f.split("/")[-2] for f in df.inputFiles() if "settled-" not in f} == {K.STRESS}
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan text") <= 2
    assert [r["reason"] for r in bad.collect()] == ["no participant id in file name"]
    rows, _ = device.run(by_type, 0)
    (row,) = rows.collect()
    assert (row["beatsPerMinute"], row["stressLevel"]) == (72, 9)
