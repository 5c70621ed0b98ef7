"""Batch completion: which patient's files of a day are all there, and since when.

The batch form is a handful of aggregates. Arrivals are first reduced to their
first sending, then to counts per minute; only those counts are put in order.
Arrivals with the same time are applied together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid.functions import paths
from vitalgrid.session import settle

SLOT = "yyyy-MM-dd HH:mm"
BATCH = ["batch_key"]


def arrivals(df: DataFrame, types=K.DEVICE_TYPES, path: str = "object_key", at: str = "arrived_at") -> DataFrame:
    """Arrivals that belong to a batch, keyed by patient and processing day."""
    return keyed(df.where(_of_types(path, types)), path, at)


def _of_types(path: str, types) -> Column:
    return paths.segment(F.col(path), 2).isNotNull() & paths.segment(F.col(path), 1).isin(*types)


def keyed(df: DataFrame, path: str = "object_key", at: str = "arrived_at") -> DataFrame:
    """The keys of arrivals; null where a path has too few segments."""
    kind, name = paths.segment(F.col(path), 1), paths.segment(F.col(path), 2)
    patient = paths.segment(F.col(path), 0)
    return (
        df.withColumn("patient_id", patient)
        .withColumn("data_type", kind)
        .withColumn("batch_key", paths.batch_key(patient, F.date_format(at, "yyyy-MM-dd")))
        .withColumn("file_id", paths.file_id(kind, name))
        .withColumnRenamed(at, "arrived_at")
    )


def first_arrivals(df: DataFrame) -> DataFrame:
    """Each file of a batch once, at its first arrival (partial aggregate).

    The null test changes nothing; stated here, it keeps the aggregate the same
    wherever it is used, so that one exchange serves all its uses in a plan.
    """
    keys = ["batch_key", "patient_id", "data_type", "file_id"]
    return df.dropna(subset=[*keys, "arrived_at"]).groupBy(*keys).agg(
        F.min("arrived_at").alias("arrived_at")
    )


def counters(df: DataFrame, types=K.DEVICE_TYPES) -> DataFrame:
    """One row per batch: distinct files per type and in total."""
    once = first_arrivals(df)
    return once.groupBy("batch_key", "patient_id").agg(
        *[F.count_if(F.col("data_type") == t).alias(column_name(t)) for t in types],
        F.count(F.lit(1)).alias("total_files"),
    )


def column_name(data_type: str) -> str:
    return data_type.replace("-", "_") + "_count"


def type_progress(df: DataFrame, expected: DataFrame, before: DataFrame | None = None, firsts: bool = False) -> DataFrame:
    """Per batch and type: actual, expected, first seen, complete since.

    ``before`` (batch_key, data_type, actual, expected, seen, reached) is what
    was known without ``df``: counts go on from there, an expected number or a
    time that was there stays, and types without rows in ``df`` are kept. With
    ``firsts`` the rows of ``df`` are first arrivals already.

    ``reached`` is the arrival that brings the type to its expected number. It
    is found in two steps: the minute in which the running count passes the
    number (at most 1440 counts a day), then the time inside that minute.
    """
    once = df if firsts else first_arrivals(df)
    group = ["batch_key", "patient_id", "data_type"]
    slots = once.groupBy(*group, F.date_trunc("minute", "arrived_at").alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min("arrived_at").alias("first_at")
    )
    along = Window.partitionBy(*group).orderBy("slot")
    running = slots.join(expected, ["patient_id", "data_type"], "left")
    counted = F.sum("n").over(along)
    if before is not None:
        had = before.select("batch_key", "data_type", F.col("actual").alias("had"), F.col("expected").alias("fixed"))
        running = running.join(had, ["batch_key", "data_type"], "left").withColumn("expected", F.coalesce(F.nullif("fixed", F.lit(0)), "expected"))
        counted = counted + F.coalesce("had", F.lit(0))
    running = running.withColumn("upto", counted)
    totals = running.groupBy(*group).agg(
        F.sum("n").alias("actual"), F.max("expected").alias("expected"), F.min("first_at").alias("seen")
    )
    passing = running.where((F.col("upto") >= F.col("expected")) & (F.col("upto") - F.col("n") < F.col("expected")))
    passing = passing.select(*group, "slot", "expected", (F.col("upto") - F.col("n")).alias("before"))
    inside = (
        once.withColumn("slot", F.date_trunc("minute", "arrived_at"))
        .join(passing, [*group, "slot"])
        .groupBy(*group, "slot", "arrived_at", "expected", "before")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    passed = F.col("before") + F.sum("n").over(Window.partitionBy(*group, "slot").orderBy("arrived_at"))
    reached = (
        inside.withColumn("upto", passed)
        .where(F.col("upto") >= F.col("expected"))
        .groupBy(*group)
        .agg(F.min("arrived_at").alias("reached"))
    )
    found = totals.join(reached, group, "left")
    if before is None:
        return found
    names = ["actual", "expected", "seen", "reached"]
    old = before.select("batch_key", "patient_id", "data_type", *[F.col(c).alias(f"_{c}") for c in names])
    return found.join(old, group, "full").select(
        *group,
        (F.coalesce("actual", F.lit(0)) + F.coalesce("_actual", F.lit(0))).alias("actual"),
        F.coalesce("expected", "_expected").alias("expected"),
        F.coalesce("_seen", "seen").alias("seen"),
        F.coalesce("_reached", "reached").alias("reached"),
    )


def completion(progress: DataFrame, expected: DataFrame, known_types: str = "frozen_on_first_arrival") -> DataFrame:
    """Per batch the moment its last open type closes, null while open.

    A type counts from its first arrival on, so a batch can complete before
    another type shows up. With ``known_types="manifest"`` every type the
    source lists counts from the start.
    """
    if known_types == "manifest":
        listed = expected.select("patient_id", F.col("data_type"), F.col("expected"))
        batches = progress.select("batch_key", "patient_id").distinct()
        all_types = batches.join(listed, "patient_id")
        progress = all_types.join(
            progress.drop("expected", "patient_id"), ["batch_key", "data_type"], "left"
        ).withColumn("seen", F.lit("1970-01-01").cast("timestamp"))
    elif known_types != "frozen_on_first_arrival":
        raise ValueError(f"unknown choice {known_types!r}")
    counted = progress.where(F.col("expected") > 0)
    # at most one entry per data type, so the list is short by construction
    one = F.struct("data_type", "seen", "reached")
    per_batch = counted.groupBy("batch_key", "patient_id").agg(F.collect_list(one).alias("types"))
    return per_batch.select("batch_key", "patient_id", _closing_time("types").alias("completed_at"))


def _closing_time(types: str) -> Column:
    """First moment at which a type closes and no other seen type is open."""
    def closes(t: Column) -> Column:
        def open_then(u: Column) -> Column:
            return (u["seen"] <= t["reached"]) & (u["reached"].isNull() | (u["reached"] > t["reached"]))

        return t["reached"].isNotNull() & ~F.exists(types, open_then)

    return F.array_min(F.transform(F.filter(types, closes), lambda t: t["reached"]))


def status(df: DataFrame, expected: DataFrame, known_types: str = "frozen_on_first_arrival") -> DataFrame:
    """Per batch: actual and expected per type, total, status, completion time."""
    progress = type_progress(df, expected)
    counts = [
        cell
        for t in K.DEVICE_TYPES
        for cell in (
            F.coalesce(F.max(F.when(F.col("data_type") == t, F.col("actual"))), F.lit(0)).alias(column_name(t)),
            F.coalesce(F.max(F.when(F.col("data_type") == t, F.col("expected"))), F.lit(0)).alias(
                "expected_" + column_name(t)
            ),
        )
    ]
    # at most one entry per data type
    one = F.when(F.col("expected") > 0, F.struct("data_type", "seen", "reached"))
    wide = progress.groupBy("batch_key", "patient_id").agg(
        *counts, F.sum("actual").alias("total_files"), F.collect_list(one).alias("_types")
    )
    if known_types == "frozen_on_first_arrival":
        wide = wide.withColumn("completed_at", _closing_time("_types"))
    else:
        done = completion(progress, expected, known_types).drop("patient_id")
        wide = wide.join(done, "batch_key", "left")
    return wide.drop("_types").withColumn(
        "status", F.when(F.col("completed_at").isNull(), F.lit("processing")).otherwise(F.lit("complete"))
    )


def progress_text(progress: DataFrame) -> DataFrame:
    """``actual/expected`` for each counted type."""
    text = F.concat_ws("/", F.col("actual").cast("string"), F.col("expected").cast("string"))
    return progress.where(F.col("expected") > 0).select("batch_key", "data_type", text.alias("progress"))


def first_complete(df: DataFrame, expected: DataFrame, known_types: str = "frozen_on_first_arrival") -> DataFrame:
    """Completed batches with the number of files there were at that moment."""
    done = completion(type_progress(df, expected), expected, known_types).where("completed_at is not null")
    # a batch with very many files is split by the adaptive skew join, and its
    # files are counted before the second exchange
    return (
        first_arrivals(df)
        .join(done.select("batch_key", "completed_at"), "batch_key")
        .where(F.col("arrived_at") <= F.col("completed_at"))
        .groupBy("batch_key", "patient_id", "completed_at")
        .agg(F.count(F.lit(1)).alias("total_files"))
    )



def outcomes(df: DataFrame, expected: DataFrame, row_id: str) -> DataFrame:
    """Every arrival as duplicate, counted or triggered.

    The trigger goes to the file, greatest by id, that arrived at the moment
    of completion with the type that closed then.
    """
    keys = ["batch_key", "patient_id", "data_type", "file_id"]
    # each file once with its first sending: written, as four later steps start from it
    firsts = settle(
        df.dropna(subset=[*keys, "arrived_at"]).groupBy(*keys).agg(F.min(F.struct("arrived_at", row_id)).alias("_f"))
        .select(*keys, F.col("_f.arrived_at").alias("arrived_at"), F.col(f"_f.{row_id}").alias("_first"))
    )
    progress = type_progress(firsts, expected, firsts=True)
    done = completion(progress, expected).where("completed_at is not null")
    return label_arrivals(df, firsts, progress, done, row_id)


def label_arrivals(df: DataFrame, firsts: DataFrame, progress: DataFrame, done: DataFrame, row_id: str) -> DataFrame:
    """``df`` with its outcome: against first sendings (with ``_first``, the row's id) and completed batches."""
    closers = (
        progress.join(done.drop("patient_id"), "batch_key")
        .where(F.col("reached") == F.col("completed_at"))
        .select("batch_key", "data_type", "completed_at")
    )
    winners = (
        firsts.join(closers.withColumnRenamed("completed_at", "arrived_at"), ["batch_key", "data_type", "arrived_at"])
        .groupBy("batch_key")
        .agg(F.max("file_id").alias("file_id"))
        .withColumn("_won", F.lit(True))
    )
    marked = firsts.join(winners, ["batch_key", "file_id"], "left").select("batch_key", "file_id", "_first", "_won")
    out = (
        F.when(F.col(row_id) != F.col("_first"), F.lit("duplicate"))
        .when(F.col("_won"), F.lit("triggered"))
        .otherwise(F.lit("counted"))
    )
    # a file without a first sending here was sent before
    labelled = df.dropna(subset=["batch_key", "file_id", "arrived_at"]).join(marked, ["batch_key", "file_id"], "left")
    out = F.when(F.col("_first").isNull(), F.lit("duplicate")).otherwise(out)
    return labelled.withColumn("outcome", out).drop("_first", "_won")


def completion_events(done: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One JSON event per completed batch and target, as rows of a table."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("detail_type"), F.lit(v).alias("target")) for k, v in rules.items()]))
    detail = F.to_json(
        F.struct(
            F.col("patient_id").alias("batchId"),
            F.date_format("completed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("completedAt"),
            F.lit("complete").alias("status"),
            F.col("total_files").alias("totalFiles"),
            F.struct(F.col("patient_id").alias("batchFolder")).alias("metadata"),
            F.col("_k.target").alias("targetRule"),
        )
    )
    return done.withColumn("_k", kinds).select("batch_key", F.col("_k.detail_type").alias("detail_type"), detail.alias("detail"))


def survey_status(df: DataFrame, expected: DataFrame) -> DataFrame:
    """The one-type form: questionnaires of a batch against the expected number."""
    once = first_arrivals(df)
    counts = once.groupBy("batch_key", "patient_id").agg(F.count(F.lit(1)).alias("actual"))
    want = expected.where(F.col("data_type") == K.QUESTIONNAIRE).select("patient_id", "expected")
    out = counts.join(want, "patient_id", "left").withColumn("expected", F.coalesce("expected", F.lit(0)))
    complete = (F.col("expected") > 0) & (F.col("actual") >= F.col("expected"))
    return out.withColumn("status", F.when(complete, F.lit("complete")).otherwise(F.lit("processing")))


def is_complete(types: list[str]) -> Column:
    """Completion predicate on a wide counter row, as a plain expression."""
    tests = [
        (F.col("expected_" + column_name(t)) == 0) | (F.col(column_name(t)) >= F.col("expected_" + column_name(t)))
        for t in types
    ]
    some = reduce(lambda a, b: a | b, [F.col("expected_" + column_name(t)) > 0 for t in types])
    return reduce(lambda a, b: a & b, tests) & some
