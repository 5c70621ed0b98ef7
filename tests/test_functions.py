"""Scalar functions against exact expectations."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitalgrid.functions import clock, numbers, paths
from vitalgrid.operators import columns
from vitalgrid.sources import arrivals


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["o"] for r in df.select("i", fn(F.col("t")).alias("o")).orderBy("i").collect()]


def python_minute(text):
    try:
        return dt.datetime.fromisoformat(text.replace("Z", "+00:00")).strftime("%Y-%m-%d %H:%M")
    except Exception:
        return None


ISO = ["2025-01-01T10:00:00Z", "2025-01-01T10:00:00+00:00", "2025-01-01T10:00:00+05:00", "2025-01-01 10:00:59.5-0330",
       "2025-01-01", "2025-01-01T10", "20250101T101112Z", "20250101", "2025-01-01T10:00:00,123", "2024-02-29T00:00",
       "2025-02-29T00:00", "2025-13-01", "2025-01-01T24:30:00", "invalid-date", "", None, "2025-1-1", "2025-01-01T1:00",
       "2025-03-09T02:30:00-05:00", "2025-01-01T10:00:61", "x2025-01-01", "2025-01-01T10:00:00 Z"]


def test_iso_minute_follows_the_written_clock(spark):
    assert values(spark, ISO, clock.iso_minute) == [python_minute(t) for t in ISO]


def test_iso_minute_on_random_times(spark):
    rnd = random.Random(1)
    texts = []
    for _ in range(300):
        t = dt.datetime(2000, 1, 1) + dt.timedelta(seconds=rnd.randrange(10**9))
        zone = rnd.choice(["", "Z", "+05:30", "-0800", "+01"])
        texts.append(t.isoformat(sep=rnd.choice("T ")) + zone)
    assert values(spark, texts, clock.iso_minute) == [python_minute(t) for t in texts]


def test_iso_second_keeps_unreadable_text(spark):
    assert values(spark, ["2025-01-01T10:00:05Z", "soon", ""], clock.iso_second) == ["2025-01-01 10:00:05", "soon", ""]


@pytest.mark.parametrize("text,day", [
    ("2025-06-07T17:14:22Z", "2025-06-07"), (" 2025-06-07 17:14:22.856000 ", "2025-06-07"),
    ("2025-06-07 nonsense", "2025-06-07"), ("2025-06-07Tnonsense", "2025-06-07"), ("06/07/2025", None),
    ("some words", "some"), ("", None), (None, None),
])
def test_iso_date_fallbacks(spark, text, day):
    assert values(spark, [text], clock.iso_date) == [day]


def test_time_of_day(spark):
    texts = [f"2025-01-01T{h:02d}:59:00Z" for h in (4, 5, 11, 12, 16, 17, 20, 21)] + ["x", None]
    assert values(spark, texts, clock.time_of_day) == [
        "night", "morning", "morning", "noon", "noon", "evening", "evening", "night", "unknown", "unknown"]


def test_participant_id(spark):
    names = ["path/to/file_abc12345.csv", "file_abc1234.csv", "file_abc123456.csv", "abc12345.csv", "", "x_abc12345.csv.gz"]
    assert values(spark, names, paths.participant_id) == ["abc12345", None, None, None, None, None]
    assert values(spark, names[-1:], lambda c: paths.participant_id(c, gz=True)) == ["abc12345"]


def test_route(spark):
    names = ["p/garmin-device-heart-rate/f", "p/garmin-connect-sleep-stage/f", "p/garmin-device-step/f",
             "p/garmin-device-stress/f", "p/questionnaire/Physical-Capacity-A/f", "p/questionnaire/Other/f",
             "p/garmin-device-bbi/f", "p", "", "p/garmin-device-step"]
    assert values(spark, names, paths.route) == [
        "heart-rate", "sleep", "step", "others", "survey", None, None, None, None, "step"]


def test_key_split(spark):
    assert values(spark, ["cd037752_20250101100000", "x"], lambda c: paths.key_part(c, 0)) == ["cd037752", "x"]
    assert values(spark, ["cd037752_20250101100000", "x"], lambda c: paths.key_part(c, 1)) == ["20250101100000", None]


def test_numbers(spark):
    assert values(spark, ["72", "72.0", "72.9", "abc", None, "9e18"], numbers.to_int) == [72, 72, 72, None, None, None]
    assert values(spark, ["1704110400123", "1.5", "x"], numbers.to_long) == [1704110400123, 1, None]
    assert values(spark, ["NA", "null", "0", "nan", "n"], numbers.null_tokens_to_null) == [None, None, "0", None, "n"]


def test_find_column():
    find = columns.find_column
    assert find(["x", "heartRate"], "beatsPerMinute", any_of=("heart", "bpm")) == "heartRate"
    assert find(["heartRate", "beatsPerMinute"], "beatsPerMinute", any_of=("heart",)) == "beatsPerMinute"
    assert find(["totalSteps", "stepCount"], "steps", all_of=("step",), none_of=("total",)) == "stepCount"
    assert find(["StepTotal"], "totalSteps", all_of=("total", "step")) == "StepTotal"
    assert find(["a"], "b") is None and find(["a"], "b", any_of=("z",)) is None
    assert columns.find_iso_date(["x", "ISODATE"]) == "ISODATE"


def test_messages(spark):
    rec = '{"eventSource":"aws:s3","s3":{"bucket":{"name":"b"},"object":{"key":"a+b%2Fc%20d"}}}'
    bodies = ['{"Records":[{"eventSource":"other"},%s]}' % rec, rec, '{"Records":[]}', "{", '{"Records":[{"eventSource":"aws:s3"}]}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = [(r["bucket"], r["object_key"]) for r in arrivals.parse_messages(df).orderBy("i").collect()]
    assert got == [("b", "a b/c d"), ("b", "a b/c d"), (None, None), (None, None), (None, None)]
    routed = arrivals.parse_routed(df).orderBy("i").collect()
    assert routed[0]["object_key"] is None
