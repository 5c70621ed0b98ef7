"""Batch completion over a stream of arrivals.

Repeated sendings are removed by a native stateful operator keyed by file, so
its state and its work spread over all tasks. What is kept per batch is small
and of fixed size: two numbers per data type and a flag.

Watermarks follow the time at which the stream sees an arrival, not the time in
the arrival. A file that comes days late is therefore never dropped; only
the horizons below count from when it was seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vitalgrid import constants as K
from vitalgrid.operators import tracker

COMPLETED = "batch_key string, patient_id string, completed_at timestamp, total_files long"
#: How long a batch without new arrivals is remembered.
KEEP_STATE_MS = 3 * 86_400_000
SEEN = "seen_at"
_STATE = "actual array<long>, expected array<long>, done boolean"


def distinct_arrivals(stream: DataFrame, keep: str = "2 days") -> DataFrame:
    """First sendings only. A repetition is known for ``keep`` after the first was seen."""
    seen = stream.withColumn(SEEN, F.current_timestamp())
    return seen.withWatermark(SEEN, keep).dropDuplicatesWithinWatermark(["batch_key", "file_id"])


def with_expected(stream: DataFrame, expected: DataFrame) -> DataFrame:
    """Stream-static join: the listing's number for the patient and type."""
    return stream.join(expected, ["patient_id", "data_type"], "left").withColumn(
        "expected", F.coalesce("expected", F.lit(0))
    )


def _advance(
    types: tuple[str, ...], keep_ms: int, key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """Apply one batch's arrivals of a trigger in time order.

    Each Arrow chunk is reduced at once to a time, a type number and the
    expected number, about a dozen bytes per arrival.
    """
    if state.hasTimedOut:
        state.remove()
        return
    n = len(types)
    actual, expected, done = ([0] * n, [0] * n, False)
    if state.exists:
        actual, expected, done = state.get
    place = {t: i for i, t in enumerate(types)}
    chunks = [
        (
            p["arrived_at"].to_numpy("datetime64[us]"),
            p["data_type"].map(place).to_numpy("int8"),
            p["expected"].to_numpy("int64"),
            p[SEEN].to_numpy("datetime64[ms]"),
        )
        for p in pdfs
    ]
    at, kind, want, seen = (np.concatenate(c) for c in zip(*chunks))
    order = np.argsort(at, kind="stable")
    at, kind, want = at[order], kind[order], want[order]

    complete, counted = np.ones(len(at), bool), np.zeros(len(at), bool)
    after, fixed = [], []
    for i in range(n):
        mine = kind == i
        running = actual[i] + np.cumsum(mine)
        limit, since = expected[i], 0
        if limit == 0:
            named = np.flatnonzero(mine & (want > 0))
            limit, since = (int(want[named[0]]), int(named[0])) if len(named) else (0, len(at))
        counts = np.arange(len(at)) >= since
        counted |= counts
        complete &= ~counts | (running >= limit)
        after.append(int(running[-1]))
        fixed.append(limit)
    last_of_time = np.append(at[1:] != at[:-1], True)
    closed = np.flatnonzero(complete & counted & last_of_time)
    state.update((after, fixed, bool(done or len(closed))))
    state.setTimeoutTimestamp(max(int(seen.max().astype("int64")), state.getCurrentWatermarkMs()) + keep_ms)
    if len(closed) and not done:
        first = int(closed[0])
        yield pd.DataFrame(
            {"batch_key": [key[0]], "patient_id": [key[1]], "completed_at": [pd.Timestamp(at[first])],
             "total_files": [sum(actual) + first + 1]}
        )


def completions(arrivals: DataFrame, types=K.DEVICE_TYPES, keep_ms: int = KEEP_STATE_MS) -> DataFrame:
    """Completed batches of the given types, each once, when its last open type closes."""
    return arrivals.groupBy("batch_key", "patient_id").applyInPandasWithState(
        partial(_advance, tuple(types), keep_ms), COMPLETED, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def read_arrivals(spark: SparkSession, path: str, schema, glob: str | None = None, files: int = 100) -> DataFrame:
    """Arrivals as a file stream with a bounded number of files per trigger."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def drain_to_table(stream: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None) -> None:
    """Run over all there is and write it to a table, exactly once.

    The number of state partitions is fixed by a stream's first run, so it is
    chosen here for the stream and not taken over from batch settings.
    """
    conf, name = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(name)
    if state_partitions:
        conf.set(name, str(state_partitions))
    try:
        query = (
            stream.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    finally:
        conf.set(name, before)
    query.awaitTermination()


def cascade(stream: DataFrame, checkpoint: str, on_complete, table: str):
    """For each trigger: record completions, then call what they set off.

    The table's partition is the trigger number, so a repeated trigger
    overwrites its own rows.
    """
    def handle(done: DataFrame, number: int) -> None:
        done = done.withColumn("trigger", F.lit(number))
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trigger").parquet(table)
        written = done.sparkSession.read.parquet(table).where(F.col("trigger") == number)
        on_complete(written.drop("trigger"), number)

    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def arrivals_of(
    stream: DataFrame, expected: DataFrame, path: str = "object_key", at: str = "arrived_at", types=K.DEVICE_TYPES
) -> DataFrame:
    """Parsed, distinct arrivals of the given types with their expected numbers."""
    return with_expected(distinct_arrivals(tracker.arrivals(stream, types, path=path, at=at)), expected)
