"""Hot-group helpers against the plain window or join they replace."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalgrid.operators import spread


def rows_with_ties(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        hot = rnd.random() < 0.5
        ms = 5_000 if hot and rnd.random() < 0.6 else rnd.choice([None, rnd.randrange(0, 40_000), rnd.randrange(0, 900)])
        out.append(("hot" if hot else f"f{rnd.randrange(3)}", ms, i, float(rnd.randrange(1000)) if rnd.random() > 0.1 else None))
    return out


@pytest.mark.parametrize("width,heavy", [(10_000, 1 << 20), (10_000, 8), (1_000, 5), (1, 2), (1 << 40, 10), (10_000, 120)])
def test_neighbours_equal_plain_window(spark, width, heavy):
    df = spark.createDataFrame(rows_with_ties(width + heavy), "g string, ms bigint, no bigint, v double")
    got = spread.with_neighbours(
        df, ["g"], "ms", "no", "v", previous="p", following="f", width=width, heavy_rows=heavy
    )
    w = Window.partitionBy("g").orderBy(F.col("ms").asc_nulls_first(), "no")
    want = df.withColumn("p", F.lag("v").over(w)).withColumn("f", F.lead("v").over(w))
    key = lambda r: r["no"]
    assert sorted(got.select(*want.columns).collect(), key=key) == sorted(want.collect(), key=key)


def test_groups_of_bounded_size_take_one_exchange_of_the_rows(spark):
    df = spark.createDataFrame(rows_with_ties(1), "g string, ms bigint, no bigint, v double")
    got = spread.with_neighbours(df, ["g"], "ms", "no", "v", previous="p")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_row_index_is_dense(spark, chunk):
    nos = random.Random(chunk).sample(range(50), 20)
    df = spark.createDataFrame([("a", n) for n in nos] + [("b", 7)], "f string, no bigint")
    got = {(r["f"], r["no"]): r["i"] for r in spread.with_row_index(df, "f", "no", "i", chunk).collect()}
    assert got == {**{("a", n): i for i, n in enumerate(sorted(nos))}, ("b", 7): 0}


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_join_per_file_keeps_every_row(spark, chunk):
    rows = spark.createDataFrame([("a", n) for n in range(11)] + [("b", 0)], "f string, no bigint")
    own = spark.createDataFrame([("a", "x"), ("b", "y")], "f string, v string")
    facts = rows.groupBy("f").agg(spread.lanes("no", chunk).alias("lanes")).join(own, "f")
    got = spread.join_per_file(rows, facts, "f", "no", "lanes", chunk).collect()
    assert sorted((r["f"], r["no"], r["v"]) for r in got) == [("a", n, "x") for n in range(11)] + [("b", 0, "y")]


def test_heavy_keys_are_all_listed(spark):
    df = spark.createDataFrame([(k % 7,) for k in range(200)] + [(99,)] * 50 + [(98,)] * 20, "k int")
    got = {r["k"]: r["_n"] for r in spread.heavy_keys(df, ["k"], heavy_rows=20).collect()}
    assert set(got) == {*range(7), 99} and got[99] == 50


def test_facts_are_repeated_for_lanes_that_occur_only(spark):
    rows = spark.createDataFrame([("a", 10**9), ("b", 5), ("b", 6)], "f string, no bigint")
    facts = rows.groupBy("f").agg(spread.lanes("no").alias("lanes"))
    assert facts.select(F.explode("lanes")).count() == 2
    assert spread.join_per_file(rows, facts, "f", "no", "lanes").count() == 3


@pytest.mark.parametrize("times", [0, 1, 4095, 4096, 4097, 10_000])
def test_repeat_rows(spark, times):
    df = spark.createDataFrame([(times,)], "n bigint")
    got = [r["i"] for r in spread.repeat_rows(df, "n", "i").collect()]
    assert sorted(got) == list(range(times))
