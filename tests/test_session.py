"""Settings, kept results, text tables."""

from pyspark.sql import functions as F

from vitalgrid import session
from vitalgrid.sources import tables


def test_settled_result_is_the_same(spark):
    df = spark.range(10).select("id", (F.col("id") % 3).alias("k"), F.lit("x").alias("v"))
    key = lambda r: r["id"]
    assert sorted(session.settle(df).collect(), key=key) == df.collect()
    assert sorted(session.settle(df, "k").select("id", "k", "v").collect(), key=key) == df.collect()


def test_shuffles_follow_input_size(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert session.size_shuffles(spark, 0) == spark.sparkContext.defaultParallelism
    assert session.size_shuffles(spark, 100 << 40) == 200_000
    assert session.size_shuffles(spark, 1 << 40) == 5243
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_text_table_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a, ""b"""\n,\n')
    (tmp_path / "b.csv").write_text("y,z\nq,7\n")
    df = tables.read_text_table(spark, str(tmp_path), keep_empty=True)
    got = sorted((r["source_file"], r["line_no"], r["x"], r["y"], r["z"]) for r in df.collect())
    assert got == [("a.csv", 1, "1", 'a, "b"', None), ("a.csv", 2, "", "", None), ("b.csv", 1, None, "q", "7")]
    plain = tables.read_text_table(spark, str(tmp_path), names=["x"])
    assert sorted(str(r["x"]) for r in plain.collect()) == ["1", "None", "None"]


def test_scratch_goes_at_its_end(spark):
    import os

    with session.scratch(spark) as folder:
        gone = session.settle(spark.range(3).toDF("id"))
        kept = session.settle(gone.select((F.col("id") + 1).alias("id")), lasting=True)
        assert gone.count() == 3 and os.listdir(folder)
        with session.scratch(spark) as inner:
            session.settle(gone)
        assert not os.path.exists(inner) and gone.count() == 3
    assert not os.path.exists(folder)
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3]


def test_settled_result_leaves_no_shuffle_files(spark):
    kept = lambda: sum(1 for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = kept()
    counts = session.settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert kept() <= before and counts.count() == 7
    assert spark.conf.get(session.CLEANUP) == "false"
