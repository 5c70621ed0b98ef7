"""Arrival messages as a stream: outcomes, completions, rejects and what they set off.

Every trigger is one incremental step over tables, made of built-in functions
only. Each table below ``home`` has a folder for each trigger that wrote to it:

``seen``       first sendings of files
``progress``   per batch and type: files so far, expected number, first and closing time
``outcomes``   every arrival as duplicate, counted or triggered
``completed``  completed batches, each once
``events``     one event for each completed batch and target
``rejects``    messages without a readable file: their number of tries, to be sent again or dead

A step reads what earlier triggers wrote for the batches it touches (batches of
the same days) and writes its own folders. A repeated trigger, after a restart,
finds the same earlier folders and replaces its own, so every message counts
once. The numbers a batch is known by are two counts and two times for each
type, whatever the number of its files; files are found again by joins, so no
batch or type is held by one task.

Arrivals of one trigger are applied in order of their times; a later trigger
goes on from the counts before it. A batch completes once. A message without an
id is told by its body.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid.operators import tracker
from vitalgrid.session import settle
from vitalgrid.sources import arrivals as A

TRIGGER = "trigger"
KEYS = "batch_key string, patient_id string, data_type string"
TABLES = {
    "seen": f"{KEYS}, file_id string, arrived_at timestamp, _first string, day string",
    "progress": f"{KEYS}, actual long, expected long, seen timestamp, reached timestamp, day string",
    "outcomes": "message_id string, batch_key string, file_id string, arrived_at timestamp, outcome string",
    "completed": "batch_key string, patient_id string, completed_at timestamp, total_files long, day string",
    "events": "batch_key string, detail_type string, detail string",
    "rejects": "message_id string, body string, arrived_at timestamp, tries long, state string",
}
#: A message is tried so many times before it is dead.
MOST_TRIES = 5


def read_messages(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """Text files of JSON bodies, one a line, as a stream: (message_id, body, arrived_at)."""
    stream = spark.readStream.option("maxFilesPerTrigger", files).text(path)
    return stream.select(
        F.sha2("value", 256).alias("message_id"), F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )


def table(spark: SparkSession, home: str, name: str, before: int | None = None) -> DataFrame:
    """A table of the stream's results, or what triggers before a given one wrote."""
    try:
        df = spark.read.schema(f"{TABLES[name]}, {TRIGGER} long").parquet(f"{home.rstrip('/')}/{name}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], f"{TABLES[name]}, {TRIGGER} long")
    return df if before is None else df.where(F.col(TRIGGER) < before)


def _write(df: DataFrame, home: str, name: str, number: int) -> DataFrame:
    """Replace a trigger's folder of a table; returns it as written."""
    columns = [c.split()[0] for c in TABLES[name].split(", ")]
    path = f"{home.rstrip('/')}/{name}/{TRIGGER}={number}"
    df.select(*columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(TABLES[name]).parquet(path)


def _day() -> Column:
    return F.substring_index("batch_key", "#", -1).alias("day")


def step(
    messages: DataFrame, number: int, home: str, expected: DataFrame, types=K.DEVICE_TYPES, rules: dict[str, str] | None = None
) -> DataFrame:
    """Apply the messages (message_id, body, arrived_at) of a trigger; returns the batches it completed."""
    spark = messages.sparkSession
    named = messages.withColumn("message_id", F.coalesce("message_id", F.sha2(F.coalesce("body", F.lit("")), 256)))
    # a message may be sent twice: its sendings are told apart by a number that is written once
    sending = F.concat_ws("/", "message_id", F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    # keys are cut out once; a body is asked for again only where no file could be read from it
    body = F.when(F.col("object_key").isNull(), F.col("body")).alias("body")
    keys = ["batch_key", "patient_id", "data_type", "file_id"]
    messages = tracker.keyed(A.parse_messages(named).withColumn("sending", sending)).withColumn("day", _day())
    messages = settle(messages.select("message_id", body, "object_key", "arrived_at", "sending", *keys, "day"))
    _reject(messages.where("object_key IS NULL"), number, home)

    came = messages.where(F.col("file_id").isNotNull() & F.col("data_type").isin(*types)).drop("body", "object_key")
    days = settle(came.select("day").distinct())
    once = came.dropna(subset=[*keys, "arrived_at"]).groupBy(*keys, "day").agg(F.min(F.struct("arrived_at", "sending")).alias("f"))
    known = table(spark, home, "seen", number).join(days, "day", "left_semi").select("batch_key", "file_id")
    firsts = once.join(known, ["batch_key", "file_id"], "left_anti").select(
        *keys, F.col("f.arrived_at").alias("arrived_at"), F.col("f.sending").alias("_first"), "day"
    )
    firsts = _write(firsts, home, "seen", number)

    touched = firsts.select("batch_key").distinct()
    latest = table(spark, home, "progress", number).join(days, "day", "left_semi").join(touched, "batch_key", "left_semi")
    state = F.max_by(F.struct("actual", "expected", "seen", "reached"), TRIGGER).alias("s")
    before = settle(latest.groupBy("batch_key", "patient_id", "data_type").agg(state).select("batch_key", "patient_id", "data_type", "s.*"))
    now = tracker.type_progress(firsts.drop("_first", "day"), expected, before, firsts=True).withColumn("day", _day())
    now = _write(now.withColumn("expected", F.coalesce("expected", F.lit(0))), home, "progress", number)

    over = table(spark, home, "completed", number).join(days, "day", "left_semi").select("batch_key")
    done = tracker.completion(now, expected).where("completed_at IS NOT NULL").join(over, "batch_key", "left_anti")
    had = before.groupBy("batch_key").agg(F.sum("actual").alias("had"))
    fresh = firsts.join(done.select("batch_key", "completed_at"), "batch_key").where("arrived_at <= completed_at")
    fresh = fresh.groupBy("batch_key").agg(F.count("*").alias("fresh"))
    done = done.join(fresh, "batch_key", "left").join(had, "batch_key", "left").withColumn(
        "total_files", F.coalesce("fresh", F.lit(0)) + F.coalesce("had", F.lit(0))
    )
    done = _write(done.withColumn("day", _day()), home, "completed", number)

    labelled = tracker.label_arrivals(came, firsts, now, done.select("batch_key", "patient_id", "completed_at"), "sending")
    _write(labelled, home, "outcomes", number)
    _write(tracker.completion_events(done, rules or {"batch": "complete"}), home, "events", number)
    return done


def _reject(bad: DataFrame, number: int, home: str) -> None:
    """Unreadable messages with the number of their try; from the sixth on they are dead.

    Tries before are counted by the triggers' rejects; those within a trigger in order of time.
    """
    here = bad.select("message_id", "body", "arrived_at")
    earlier = table(bad.sparkSession, home, "rejects", number).groupBy("message_id").agg(F.max("tries").alias("had"))
    # a message's tries are summed up by time first: a row for each time, not for each sending, is put in order
    times = here.groupBy("message_id", "arrived_at").agg(F.count("*").alias("n"), F.first("body").alias("body"))
    upto = F.sum("n").over(Window.partitionBy("message_id").orderBy("arrived_at"))
    counted = times.withColumn("upto", upto).join(earlier, "message_id", "left")
    tries = F.col("upto") + F.coalesce("had", F.lit(0))
    state = F.when(tries > MOST_TRIES, F.lit("dead")).otherwise(F.lit("again"))
    _write(counted.withColumn("tries", tries).withColumn("state", state), home, "rejects", number)


def run(
    stream: DataFrame, home: str, expected: DataFrame, types=K.DEVICE_TYPES, rules: dict[str, str] | None = None,
    on_complete: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """All there is of a stream of messages, trigger by trigger; a killed run goes on where it was.

    ``on_complete(batches, trigger)`` is called with what a trigger completed,
    again if the trigger is repeated; give it the trigger as the run's name.
    """
    expected = settle(expected)

    def handle(messages: DataFrame, number: int) -> None:
        done = step(messages, number, home, expected, types, rules)
        if on_complete is not None and not done.isEmpty():
            on_complete(done, number)

    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{home.rstrip('/')}/checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
