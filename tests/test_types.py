"""Inferred types against a plain reading of the same texts, and run summaries."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid.operators import audit
from vitalgrid.plans import runs
from vitalgrid.sources import types

POOL = ["0", "-7", "+12", "2147483647", "2147483648", "-9223372036854775808", "9223372036854775808", "1.5", ".5", "3.", "1e9", "1e", ".",
        "2024-02-29", "2023-02-29", "2024-01-01T10:00:00Z", "2024-01-01 10:00", "true", "FALSE", "yes", " 1", "", None, "NaN"]


def kind(text):
    if text is None or text == "":
        return None
    if re.fullmatch(r"[+-]?\d+", text):
        n = int(text)
        return "int" if -(2**31) <= n < 2**31 else "bigint" if -(2**63) <= n < 2**63 else "double"
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text):
        return "double"
    known = {"2024-02-29": "date", "2024-01-01T10:00:00Z": "timestamp", "2024-01-01 10:00": "timestamp", "true": "boolean", "FALSE": "boolean"}
    return known.get(text, "string")


def join(kinds):
    for wide in (["int"], ["int", "bigint"], ["int", "bigint", "double"], ["date"], ["date", "timestamp"], ["boolean"]):
        if kinds and kinds <= set(wide):
            return wide[-1]
    return "string"


@pytest.mark.parametrize("seed", range(4))
def test_types_equal_plain_reading(spark, seed):
    rnd = random.Random(seed)
    names = ["a", "b.c", "d"]
    pools = {(f, n): rnd.sample(POOL, rnd.randrange(1, 4)) for f in range(40) for n in names}
    rows = [(f"f{f}", *[rnd.choice(pools[f, n]) for n in names]) for f in range(40) for _ in range(5)]
    df = spark.createDataFrame(rows, "source_file string, a string, `b.c` string, d string").repartition(3)
    want = {(f"f{f}", n): join({kind(r[1 + i]) for r in rows if r[0] == f"f{f}"} - {None}) for f in range(40) for i, n in enumerate(names)}
    got = {(r["source_file"], r["column"]): r["type"] for r in types.file_types(df, names).collect()}
    assert got == want
    assert types.common_types(df, names) == {n: join({kind(r[1 + i]) for r in rows} - {None}) for i, n in enumerate(names)}


def test_each_kind_by_itself(spark):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(POOL)], "source_file string, a string")
    got = {r["source_file"]: r["type"] for r in types.file_types(df, ["a"]).collect()}
    assert got == {str(i): kind(t) or "string" for i, t in enumerate(POOL)}


def test_typed_table_keeps_every_row(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "x"), ("", "2024-01-02T03:04:05Z", ""), (None, None, None)], "a string, b string, c string")
    out = types.typed(df, types.common_types(df, df.columns))
    assert out.dtypes == [("a", "int"), ("b", "timestamp"), ("c", "string")]
    assert [(r["a"], str(r["b"]), r["c"]) for r in out.select("a", F.col("b").cast("string"), "c").collect()] == [
        (1, "2024-01-01 00:00:00", "x"), (None, "2024-01-02 03:04:05", ""), (None, "None", None)]
    empty = df.limit(0)
    assert types.common_types(empty, ["a"]) == {"a": "string"} and types.common_types(df, []) == {}
    assert types.file_types(df, [], by="a").count() == 0


def test_summary_of_a_cleaning_run(spark, tmp_path):
    name = "P/garmin-device-step/1_garmin-device-step_P_cd037752.csv"
    top = ["p"] * 6 + ["isoDate,unixTimestampInMs,steps"]
    row = "2024-01-01T00:00:00Z,1704067200000,5"
    files = {name: [*top, row, row, "", row.replace(",5", ",6")], "P/garmin-device-step/x.csv": [*top, row],
             name.replace("1_", "2_"): top, name.replace("1_", "3_"): [*top, row + ",more"]}
    lines = spark.createDataFrame([(f, i, t) for f, ts in files.items() for i, t in enumerate(ts)], "source_file string, line_no bigint, line string")
    for run in ("one", "one"):
        told = runs.clean(lines, K.STEP, 0, str(tmp_path), run).first().asDict()
        assert told == {"flow": K.STEP, "files_in": 4, "files_rejected": 3, "rows_in": 3, "rows_out": 2, "removed": 1}
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 2
    assert sorted(r["reason"] for r in spark.read.parquet(f"{tmp_path}/rejects").collect()) == [
        "more cells than names", "no data rows", "no participant id in file name"]


def test_rows_are_seen_once(spark, tmp_path):
    df, seen = audit.watched(spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count())
    df.write.parquet(str(tmp_path / "a"))
    assert audit.rows_seen(seen) == 10
