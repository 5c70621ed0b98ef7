"""Batch completion: aggregates and stream against a sequential replay."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid.operators import tracker
from vitalgrid.streaming import batches

START = dt.datetime(2025, 2, 4, 8, 0)
SCHEMA = "arrival_id bigint, object_key string, arrived_at timestamp"


def scenario(seed):
    rnd = random.Random(seed)
    rows, expected, n = [], {}, 0
    for p in range(6):
        for t in rnd.sample(K.DEVICE_TYPES, rnd.randrange(1, 4)):
            files = rnd.randrange(1, 5)
            want = max(0, files + rnd.choice([0, 0, 0, 1, -1]))
            if want:
                expected[(f"p{p}", t)] = want
            for f in range(files):
                for _ in range(rnd.choice([1, 1, 2])):
                    at = START + dt.timedelta(seconds=rnd.choice([1, 30, 60, 600, 3600]) * rnd.randrange(1, 20))
                    rows.append((n, f"p{p}/{t}/f{f}.csv", at))
                    n += 1
    rows += [(n, "p0/unknown/f.csv", START), (n + 1, "p0", START)]
    return rows, expected


def replay(rows, expected):
    """One arrival after the other; equal times are applied together."""
    state = defaultdict(lambda: {"n": defaultdict(int), "seen": set(), "done": None, "total": None})
    outcome = {}
    by_time = defaultdict(list)
    for i, key, at in rows:
        parts = key.split("/")
        if len(parts) >= 3 and parts[1] in K.DEVICE_TYPES:
            by_time[at].append((i, parts[0], parts[1], f"{parts[1]}/{parts[2]}"))
    for at in sorted(by_time):
        fresh = defaultdict(list)
        for i, p, t, fid in sorted(by_time[at]):
            s = state[(p, at.date())]
            if fid in s["seen"]:
                outcome[i] = "duplicate"
                continue
            s["seen"].add(fid)
            s["n"][t] += 1
            outcome[i] = "counted"
            fresh[(p, at.date())].append((fid, t, i))
        for key, new in fresh.items():
            s = state[key]
            want = {t: expected.get((key[0], t), 0) for t in s["n"]}
            counted = [t for t in want if want[t]]
            if s["done"] is None and counted and all(s["n"][t] >= want[t] for t in counted):
                s["done"], s["total"] = at, sum(s["n"].values())
                closing = [x for x in new if want[x[1]] and s["n"][x[1]] >= want[x[1]]
                           and s["n"][x[1]] - sum(y[1] == x[1] for y in new) < want[x[1]]]
                outcome[max(closing)[2]] = "triggered"
    done = {f"{p}#{d}": (s["done"], s["total"]) for (p, d), s in state.items() if s["done"]}
    return done, outcome


def inputs(spark, seed):
    rows, expected = scenario(seed)
    table = spark.createDataFrame([(*k, n) for k, n in expected.items()], "patient_id string, data_type string, expected bigint")
    return rows, expected, spark.createDataFrame(rows, SCHEMA), table


@pytest.mark.parametrize("seed", range(4))
def test_batch_form_against_replay(spark, seed):
    rows, expected, df, table = inputs(spark, seed)
    done, outcome = replay(rows, expected)
    came = tracker.arrivals(df)
    got = {r["batch_key"]: (r["completed_at"], r["total_files"]) for r in tracker.first_complete(came, table).collect()}
    assert got == done
    assert {r["arrival_id"]: r["outcome"] for r in tracker.outcomes(came, table, "arrival_id").collect()} == outcome
    status = tracker.status(came, table).collect()
    assert {r["batch_key"] for r in status if r["status"] == "complete"} == set(done)
    wide = tracker.status(came, table).where(tracker.is_complete(list(K.DEVICE_TYPES)))
    assert set(done) >= {r["batch_key"] for r in wide.collect()}


@pytest.mark.parametrize("seed", [0, 3])
def test_stream_equals_batch(spark, tmp_path, seed):
    rows, expected, df, table = inputs(spark, seed)
    # several files in time order, so that state is carried over triggers
    for i, part in enumerate(sorted({r[2] for r in rows})):
        df.where(F.col("arrived_at") == F.lit(part)).coalesce(1).write.parquet(f"{tmp_path}/in/{i:04d}")
    stream = batches.read_arrivals(spark, f"{tmp_path}/in/*", SCHEMA, files=7)
    stream = batches.completions(batches.arrivals_of(stream, table))
    batches.drain_to_table(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    out = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()
    got = {r["batch_key"]: (r["completed_at"], r["total_files"]) for r in out}
    assert got == replay(rows, expected)[0] and len(out) == len(got)


def test_cascade_runs_once_per_completion(spark, tmp_path):
    rows, expected, df, table = inputs(spark, 1)
    df.write.parquet(f"{tmp_path}/in")
    calls = []
    stream = batches.completions(batches.arrivals_of(batches.read_arrivals(spark, f"{tmp_path}/in", SCHEMA), table))
    batches.cascade(stream, f"{tmp_path}/cp", lambda done, n: calls.append(done.count()), f"{tmp_path}/done").awaitTermination()
    assert sum(calls) == len(replay(rows, expected)[0])


def test_manifest_mode_waits_for_unseen_types(spark):
    t = K.DEVICE_TYPES
    df = spark.createDataFrame([(0, f"p/{t[0]}/a.csv", START)], SCHEMA)
    table = spark.createDataFrame([("p", t[0], 1), ("p", t[1], 1)], "patient_id string, data_type string, expected bigint")
    came = tracker.arrivals(df)
    assert tracker.first_complete(came, table).count() == 1
    assert tracker.first_complete(came, table, known_types="manifest").count() == 0


def test_survey_status_and_progress(spark):
    df = spark.createDataFrame([(i, f"p/questionnaire/f{i}.csv", START) for i in range(2)], SCHEMA)
    came = tracker.arrivals(df, [K.QUESTIONNAIRE])
    for want, status in [(2, "complete"), (3, "processing")]:
        table = spark.createDataFrame([("p", K.QUESTIONNAIRE, want)], "patient_id string, data_type string, expected bigint")
        assert tracker.survey_status(came, table).first()["status"] == status
        assert tracker.progress_text(tracker.type_progress(came, table)).first()["progress"] == f"2/{want}"


def test_late_arrivals_are_counted(spark, tmp_path):
    import datetime as dt

    t = K.DEVICE_TYPES[0]
    table = spark.createDataFrame([("p", t, 2), ("q", t, 2)], "patient_id string, data_type string, expected bigint")

    def arrive(number, patient, name, at):
        one = spark.createDataFrame([(number, f"{patient}/{t}/{name}.csv", at)], SCHEMA)
        one.coalesce(1).write.parquet(f"{tmp_path}/in/{number:04d}")
        stream = batches.completions(batches.arrivals_of(batches.read_arrivals(spark, f"{tmp_path}/in/*", SCHEMA), table))
        batches.drain_to_table(stream, f"{tmp_path}/out", f"{tmp_path}/cp", state_partitions=2)
        return stream.schema

    arrive(0, "p", "a", START)
    arrive(1, "q", "a", START + dt.timedelta(days=30))  # far beyond every horizon
    schema = arrive(2, "p", "b", START + dt.timedelta(minutes=1))
    got = spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()
    assert [(r["patient_id"], r["total_files"]) for r in got] == [("p", 2)]


def test_stream_of_forms(spark, tmp_path):
    forms = [K.QUESTIONNAIRE]
    df = spark.createDataFrame([(i, f"p/questionnaire/f{i % 3}.csv", START) for i in range(5)], SCHEMA)
    df.write.parquet(f"{tmp_path}/in")
    table = spark.createDataFrame([("p", K.QUESTIONNAIRE, 3)], "patient_id string, data_type string, expected bigint")
    stream = batches.completions(batches.arrivals_of(batches.read_arrivals(spark, f"{tmp_path}/in", SCHEMA), table, types=forms), forms)
    batches.drain_to_table(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert [r["total_files"] for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()] == [3]
