"""The stream of messages against a sequential replay, over several triggers, killed and started again."""

import datetime as dt
import json
import os

import pytest
from test_batches import replay, scenario

from vitalgrid.plans import surveys
from vitalgrid.streaming import incremental

MESSAGES = "message_id string, body string, arrived_at timestamp"


def body(key):
    return json.dumps({"Records": [{"eventSource": "aws:s3", "s3": {"bucket": {"name": "b"}, "object": {"key": key}}}]})


def files(folder, rows, parts):
    """Messages as files in order of time, none of whose times lies in two."""
    os.makedirs(folder)
    times = sorted({at for _, _, at in rows})
    for i in range(parts):
        mine = set(times[i * len(times) // parts : (i + 1) * len(times) // parts])
        name = f"{folder}/{i}.json"
        with open(name, "w") as out:
            for n, text, at in rows:
                if at in mine:
                    out.write(json.dumps({"message_id": n, "body": text, "arrived_at": at.isoformat()}) + "\n")
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))


def stream(spark, folder):
    return spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).json(folder)


def test_outcomes_over_triggers_and_a_restart(spark, tmp_path):
    rows, expected = scenario(5)
    files(str(tmp_path / "in"), [(f"{n:06d}", body(key), at) for n, key, at in rows], 3)
    want = spark.createDataFrame([(p, t, n) for (p, t), n in expected.items()], "patient_id string, data_type string, expected long")
    home, calls = str(tmp_path / "home"), []

    def fails_once(done, number):
        calls.append(number)
        if len(calls) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        incremental.run(stream(spark, str(tmp_path / "in")), home, want, on_complete=fails_once)
    incremental.run(stream(spark, str(tmp_path / "in")), home, want, on_complete=fails_once)
    assert calls[0] == calls[1] and len(set(calls)) == len(calls) - 1

    want_done, outcome = replay(rows, expected)
    got = incremental.table(spark, home, "outcomes").collect()
    assert sorted((int(r["message_id"]), r["outcome"]) for r in got) == sorted(outcome.items())
    done = {r["batch_key"]: (r["completed_at"], r["total_files"]) for r in incremental.table(spark, home, "completed").collect()}
    assert done == want_done
    events = incremental.table(spark, home, "events").collect()
    assert len(events) == len(done) and all(json.loads(r["detail"])["status"] == "complete" for r in events)


def test_bad_messages_are_tried_and_die(spark, tmp_path):
    at = [dt.datetime(2025, 2, 4, 8, i) for i in range(9)]
    rows = [("a", "{not json", t) for t in at[:7]] + [("b", '{"Records":[]}', at[8]), (None, None, at[3]), ("c", body("p0/x/f.csv"), at[0])]
    rows += [("twice", body("p0/garmin-device-step/f.csv"), at[1]), ("twice", body("p0/garmin-device-step/f.csv"), at[2])]
    files(str(tmp_path / "in"), rows, 4)
    want = spark.createDataFrame([("p0", "garmin-device-step", 1)], "patient_id string, data_type string, expected long")
    home = str(tmp_path / "home")
    for _ in range(2):  # the second run finds nothing new
        incremental.run(stream(spark, str(tmp_path / "in")), home, want)
        bad = incremental.table(spark, home, "rejects").collect()
        assert sorted((r["tries"], r["state"]) for r in bad if r["message_id"] == "a") == [(i, "again") for i in range(1, 6)] + [(6, "dead"), (7, "dead")]
        assert [r["tries"] for r in bad if r["message_id"] == "b"] == [1] and len(bad) == 9
        out = incremental.table(spark, home, "outcomes").collect()
        assert sorted(r["outcome"] for r in out) == ["duplicate", "triggered"]


def test_completion_merges_the_patient_once(spark, tmp_path):
    clean = tmp_path / "clean"
    for patient in ("p0", "p1"):
        (clean / patient).mkdir(parents=True)
        (clean / patient / "a_cleaned.csv").write_text(f"isoDate,patient_id\n2025-01-03 10:00:00,{patient}\n2025-01-03 10:00:00,{patient}\n")
    rows = [("1", body("p0/questionnaire/a.csv"), dt.datetime(2025, 2, 4, 8, 0)), ("2", body("p0/questionnaire/b.csv"), dt.datetime(2025, 2, 4, 8, 1)),
            ("3", body("p1/questionnaire/a.csv"), dt.datetime(2025, 2, 4, 8, 2))]
    files(str(tmp_path / "in"), rows, 2)
    want = spark.createDataFrame([("p0", "questionnaire", 2), ("p1", "questionnaire", 2)], "patient_id string, data_type string, expected long")
    target, tries = str(tmp_path / "merged"), []

    def merge(done, number):
        surveys.merge_completed(spark, done, str(clean), target, run=f"trigger-{number}")
        tries.append(number)
        if len(tries) == 1:
            raise RuntimeError("lost after the merge")

    for _ in range(2):
        try:
            incremental.run(stream(spark, str(tmp_path / "in")), str(tmp_path / "home"), want, ["questionnaire"], on_complete=merge)
        except Exception as e:
            assert "lost after the merge" in str(e)
    assert len(tries) == 2
    merged = spark.read.parquet(target).collect()
    assert [r["patient_folder"] for r in merged] == ["p0", "p0"]  # both equal rows of a first write, once


def test_progress_from_first_arrivals_alone(spark):
    from vitalgrid.operators import tracker

    rows, expected = scenario(5)
    came = tracker.arrivals(spark.createDataFrame([(key, at) for _, key, at in rows], "object_key string, arrived_at timestamp"))
    want = spark.createDataFrame([(p, t, n) for (p, t), n in expected.items()], "patient_id string, data_type string, expected long")
    firsts = tracker.first_arrivals(came)
    whole = sorted(map(tuple, tracker.type_progress(came, want).collect()), key=str)
    assert sorted(map(tuple, tracker.type_progress(firsts, want, firsts=True).collect()), key=str) == whole
