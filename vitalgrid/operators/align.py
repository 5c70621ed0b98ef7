"""Alignment of the six device types to one table per participant and minute.

Per key (participant, minute) the result holds every combination of the types'
distinct epochs and of the types' readings; a type without a reading counts as
one combination with its defaults. So a key with ``d_t`` distinct epochs and
``n_t`` readings of type ``t`` gives ``prod max(1, d_t) * prod max(1, n_t)``
rows. ``mode="latest"`` keeps one row per key instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid.functions import clock, numbers, paths
from vitalgrid.operators import columns, spread
from vitalgrid.session import settle

KEYS = ["participant_id", "timestamp"]
Frames = Mapping[str, "DataFrame | Sequence[DataFrame] | None"]

# type -> (metric, Spark type, default when the type has no reading)
METRICS = {
    K.HEART_RATE: [("beatsPerMinute", "int", 0)],
    K.SLEEP: [("durationInMs", "bigint", 0), ("sleepType", "string", "none")],
    K.STEP: [("steps", "int", 0), ("totalSteps", "int", 0)],
    K.RESPIRATION: [("breathsPerMinute", "int", 0)],
    K.STRESS: [("stressLevel", "int", 0)],
    K.PULSE_OX: [("spo2", "int", 0)],
}

# metric -> how its source column is chosen
CHOICES = {
    "beatsPerMinute": dict(exact="beatsPerMinute", any_of=("heart", "beat", "bpm")),
    "durationInMs": dict(exact="durationInMs", any_of=("duration",)),
    "sleepType": dict(exact="type", any_of=("type", "stage")),
    "steps": dict(exact="steps", all_of=("step",), none_of=("total",)),
    "totalSteps": dict(exact="totalSteps", all_of=("total", "step")),
    "breathsPerMinute": dict(exact="breathsPerMinute", any_of=("breath", "respiration")),
    "stressLevel": dict(exact="stressLevel", any_of=("stress", "level")),
    "spo2": dict(exact="spo2", any_of=("spo2", "oxygen", "pulse")),
}
NO_SLEEP_COLUMN = "unknown"

# more readings of one type in one minute than this take the join path
CROWDED = 1024
# a key that gives more rows than this is cut by its result rows
PIECE_ROWS = 1 << 16
MOST_BROADCAST = 50_000


def prepare(df: DataFrame, data_type: str) -> DataFrame | None:
    """Keys, epoch and typed metrics of one type; None without key columns.

    A missing value becomes the default before typing, an unreadable one
    becomes null by typing.
    """
    names = df.columns
    key = F.col("participantid_timestamp")
    if "participant_id" in names and "timestamp" in names:
        pid, minute = F.col("participant_id"), F.col("timestamp")
    elif "participantid_timestamp" in names:
        pid, minute = paths.key_part(key, 0), paths.key_part(key, 1)
    else:
        return None
    epoch = (
        numbers.to_long(F.col("unixTimestampInMs"))
        if "unixTimestampInMs" in names
        else F.lit(None).cast("bigint")
    )
    out = [pid.cast("string").alias("participant_id"), minute.cast("string").alias("timestamp"),
           epoch.alias("epoch")]
    for metric, kind, default in METRICS[data_type]:
        source = columns.find_column(names, **CHOICES[metric])
        if source is None:
            value = F.lit(NO_SLEEP_COLUMN if metric == "sleepType" else default).cast(kind)
        elif kind == "string":
            value = F.coalesce(F.col(source).cast("string"), F.lit(default))
        else:
            typed = numbers.to_int if kind == "int" else numbers.to_long
            value = F.when(F.col(source).isNull(), F.lit(default).cast(kind)).otherwise(
                typed(F.col(source))
            )
        out.append(value.alias(metric))
    return df.select(*out)


def prepare_all(frames: Frames) -> dict[str, DataFrame]:
    """The types that are there. A type may come in parts with own columns;
    metrics are looked up in each part by itself."""
    prepared = {}
    for t in K.DEVICE_TYPES:
        parts = frames.get(t)
        if parts is None:
            continue
        parts = [parts] if isinstance(parts, DataFrame) else list(parts)
        ready = [p for p in (prepare(df, t) for df in parts) if p is not None]
        if ready:
            prepared[t] = reduce(DataFrame.unionByName, ready)
    if not prepared:
        raise ValueError("no type has key columns")
    return prepared


def _stack(prepared: Mapping[str, DataFrame]) -> DataFrame:
    """All types in one narrow table; ``kind`` is the place in type order."""
    parts = []
    for t, df in prepared.items():
        own = {m for m, _, _ in METRICS[t]}
        cells = [
            F.col(m) if m in own else F.lit(None).cast(kind).alias(m)
            for ms in METRICS.values()
            for m, kind, _ in ms
        ]
        parts.append(
            df.select(*KEYS, F.lit(K.DEVICE_TYPES.index(t)).alias("kind"), "epoch", *cells)
        )
    return reduce(DataFrame.unionByName, parts)


def _payload(t: str) -> Column:
    return F.struct(*[m for m, _, _ in METRICS[t]])


def _metric_columns(value_of) -> list[Column]:
    return [value_of(t, m, kind, d).alias(m) for t, ms in METRICS.items() for m, kind, d in ms]


def aligned(
    frames: Frames, mode: str = "fanout", crowded: int = CROWDED, piece: int = PIECE_ROWS
) -> DataFrame:
    """The aligned table, with the columns of ``constants.ALIGNED_COLUMNS``."""
    return finish(align_rows(frames, mode, crowded, piece))


def align_rows(
    frames: Frames, mode: str = "fanout", crowded: int = CROWDED, piece: int = PIECE_ROWS
) -> DataFrame:
    prepared = prepare_all(frames)
    stacked = _stack(prepared)
    if mode == "fanout":
        # the narrow table is counted and then used: written once, so that
        # what made it (parsing, cleaning, expansion) runs once
        stacked = settle(stacked)
    keyed = stacked.where(F.col("participant_id").isNotNull() & F.col("timestamp").isNotNull())
    if mode == "latest":
        return _latest(keyed, prepared).unionByName(_without_key(stacked))
    if mode != "fanout":
        raise ValueError(f"unknown mode {mode!r}")

    # Minutes with very many readings of one type (usually none at all) and
    # readings without a key are looked for first, in one narrow aggregate over
    # the keys: the former must not be gathered into one row.
    has_key = F.col("participant_id").isNotNull() & F.col("timestamp").isNotNull()
    kinds = range(len(K.DEVICE_TYPES))
    numbers_of = [F.count_if(F.col("kind") == i).alias(f"n{i}") for i in kinds]
    most = F.greatest(*[F.col(f"n{i}") for i in kinds])
    ways = reduce(lambda a, b: a * b, [F.pow(F.greatest(F.lit(1), F.col(f"n{i}")), F.lit(2)) for i in kinds])
    found = (
        stacked.groupBy(*KEYS)
        .agg(*numbers_of)
        .agg(
            F.count_if(has_key & (most > crowded)).alias("hot"),
            F.count_if(has_key & (most <= crowded) & (ways > piece)).alias("wide"),
            F.count_if(~has_key).alias("loose"),
        )
        .first()
    )

    calm = keyed
    parts = []
    if found["hot"]:
        hot = settle(keyed.groupBy(*KEYS).agg(*numbers_of).where(most > crowded))
        # broadcast only after the check of its size
        near = F.broadcast(hot) if found["hot"] <= MOST_BROADCAST else hot
        calm = keyed.join(near.select(*KEYS), KEYS, "left_anti")
        crowd = settle(keyed.join(near, KEYS), "kind")
        parts.append(_multiply(hot, crowd, prepared, crowded))
    if found["loose"]:
        parts.append(_without_key(stacked))
    # a fixed number of tasks: pieces are small as input, and would be put together again by their bytes
    tasks = int(stacked.sparkSession.conf.get("spark.sql.shuffle.partitions")) if found["wide"] else None
    return reduce(DataFrame.unionByName, parts, _gather(calm, prepared, piece, tasks))


def _without_key(stacked: DataFrame) -> DataFrame:
    """Rows without a key never meet others: distinct epochs with defaults."""
    return (
        stacked.where(F.col("participant_id").isNull() | F.col("timestamp").isNull())
        .select(
            *KEYS,
            F.when(F.col("epoch").isNotNull(), F.col("kind")).alias("kind"),
            "epoch",
        )
        .distinct()
        .select(
            *KEYS,
            F.col("epoch").alias("unixTimestampInMs"),
            *_metric_columns(lambda t, m, kind, d: F.lit(d).cast(kind)),
        )
    )


def _gather(keyed: DataFrame, prepared: Mapping[str, DataFrame], piece: int, tasks: int | None) -> DataFrame:
    """One shuffle: short lists per key and type, then their combinations.

    Only called for keys whose lists have at most ``crowded`` entries. Keys
    that give more rows than ``piece`` (``tasks``: if there are any) are cut by result rows.
    """
    aggs = []
    for t in prepared:
        mine = F.col("kind") == K.DEVICE_TYPES.index(t)
        i = K.DEVICE_TYPES.index(t)
        aggs.append(F.collect_set(F.when(mine, F.struct("epoch"))).alias(f"e{i}"))
        aggs.append(F.collect_list(F.when(mine, _payload(t))).alias(f"p{i}"))
    df = keyed.groupBy(*KEYS).agg(*aggs)
    order = [K.DEVICE_TYPES.index(t) for t in prepared]
    lists = [f"e{i}" for i in order] + [f"p{i}" for i in order]
    if tasks is None:
        df = _exploded(df, lists)
    else:
        ways = reduce(lambda a, b: a * b, [F.greatest(F.lit(1), F.size(c)).cast("double") for c in lists])
        df = df.withColumn("_rows", ways)
        few = _exploded(df.where(F.col("_rows") <= piece).drop("_rows"), lists)
        df = few.unionByName(_unranked(df.where(F.col("_rows") > piece), lists, piece, tasks))
    df = df.withColumn("unixTimestampInMs", F.coalesce(*[F.col(f"e{i}.epoch") for i in order]))

    def value(t: str, m: str, kind: str, default) -> Column:
        if t not in prepared:
            return F.lit(default).cast(kind)
        cell = F.col(f"p{K.DEVICE_TYPES.index(t)}")
        return F.when(cell.isNull(), F.lit(default).cast(kind)).otherwise(cell.getField(m))

    return df.select(*KEYS, "unixTimestampInMs", *_metric_columns(value))


def _exploded(df: DataFrame, lists: list[str]) -> DataFrame:
    """All combinations of the entries of the lists, one list after the other."""
    for c in lists:
        df = df.withColumn(c, F.explode_outer(c))
    return df


def _unranked(df: DataFrame, lists: list[str], piece: int, tasks: int) -> DataFrame:
    """The same combinations by their numbers, for keys that have many.

    The combinations of a key are numbered from 0; the digits of a number, to
    the lists' lengths as bases, are the places in the lists. A key is cut into
    runs of ``piece`` numbers, which are dealt anew with the short lists, so a
    task makes about ``piece`` rows at a time whatever key they belong to.
    """
    size = lambda c: F.greatest(F.lit(1), F.size(c)).cast("bigint")
    base = F.lit(1).cast("bigint")
    for i, c in enumerate(lists):
        df = df.withColumn(f"_b{i}", base)
        base = F.col(f"_b{i}") * size(c)
    df = df.withColumn("_all", base)
    df = spread.repeat_rows(df, F.ceil(F.col("_all") / F.lit(piece)), "_piece").repartition(tasks, *KEYS, "_piece")
    start = F.col("_piece") * F.lit(piece)
    df = df.withColumn("_no", F.explode(F.sequence(start, F.least(start + (piece - 1), F.col("_all") - 1))))
    digits = [F.get(c, (F.expr(f"_no div _b{i}") % size(c)).cast("int")) for i, c in enumerate(lists)]
    return df.select(*KEYS, *[d.alias(c) for d, c in zip(digits, lists)])


def _multiply(
    hot: DataFrame, crowd: DataFrame, prepared: Mapping[str, DataFrame], piece: int
) -> DataFrame:
    """The same combinations by joins, for keys with many readings.

    Copies are counted before anything is joined and multiplied out last. The
    many readings of a key are spread over salts in proportion to their
    number, and the other side is repeated once per salt, so one task joins
    about ``piece`` readings of a key with each of its partners.
    """
    order = [K.DEVICE_TYPES.index(t) for t in prepared]
    out = hot.withColumn("_w", F.lit(1).cast("bigint"))

    def salts(i: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(f"n{i}") / F.lit(piece))).cast("bigint")

    def attach(left: DataFrame, right: DataFrame, i: int, spread_by: list[str]) -> DataFrame:
        right = right.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts(i))).drop(
            *[f"n{j}" for j in range(len(K.DEVICE_TYPES))]
        )
        left = spread.repeat_rows(left, salts(i), "_salt")
        joined = left.join(right, [*KEYS, "_salt"], "left").drop("_salt")
        # a salt may be empty; only a type without any reading keeps its blank row
        return joined.where((F.col(f"n{i}") == 0) | F.col("_hit").isNotNull()).drop("_hit")

    for i in order:
        epochs = (
            crowd.where(F.col("kind") == i)
            .select(*KEYS, f"n{i}", F.col("epoch").alias(f"e{i}"))
            .distinct()
            .withColumn("_hit", F.lit(True))
        )
        out = attach(out, epochs, i, [f"e{i}"])
    out = out.withColumn("unixTimestampInMs", F.coalesce(*[F.col(f"e{i}") for i in order]))
    out = out.drop(*[f"e{i}" for i in order])
    for t in prepared:
        i, own = K.DEVICE_TYPES.index(t), [m for m, _, _ in METRICS[t]]
        readings = (
            crowd.where(F.col("kind") == i)
            .groupBy(*KEYS, f"n{i}", *own)
            .agg(F.count(F.lit(1)).alias("_hit"))
        ).withColumn(f"w{i}", F.col("_hit"))
        out = attach(out, readings, i, own)
        out = out.withColumn("_w", F.col("_w") * F.coalesce(F.col(f"w{i}"), F.lit(1))).drop(f"w{i}")
    out = spread.repeat_rows(out, "_w", "_copy")

    def value(t: str, m: str, kind: str, default) -> Column:
        if t not in prepared:
            return F.lit(default).cast(kind)
        absent = F.col(f"n{K.DEVICE_TYPES.index(t)}") == 0
        return F.when(absent, F.lit(default).cast(kind)).otherwise(F.col(m))

    return out.select(*KEYS, "unixTimestampInMs", *_metric_columns(value))


def _latest(keyed: DataFrame, prepared: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key: the reading with the latest epoch of each type."""
    aggs = []
    for t in prepared:
        mine = F.col("kind") == K.DEVICE_TYPES.index(t)
        reading = F.struct("epoch", *[m for m, _, _ in METRICS[t]])
        aggs.append(F.max(F.when(mine, reading)).alias(f"p{K.DEVICE_TYPES.index(t)}"))
    df = keyed.groupBy(*KEYS).agg(*aggs)

    def value(t: str, m: str, kind: str, default) -> Column:
        if t not in prepared:
            return F.lit(default).cast(kind)
        cell = F.col(f"p{K.DEVICE_TYPES.index(t)}")
        return F.when(cell.isNull(), F.lit(default).cast(kind)).otherwise(cell.getField(m))

    epoch = F.coalesce(*[F.col(f"p{K.DEVICE_TYPES.index(t)}.epoch") for t in prepared])
    return df.select(*KEYS, epoch.alias("unixTimestampInMs"), *_metric_columns(value))


def spine(frames: Frames) -> DataFrame:
    """Distinct keys with the epoch sets' sizes: the skeleton of the result."""
    stacked = _stack(prepare_all(frames))
    keyed = stacked.where(F.col("participant_id").isNotNull() & F.col("timestamp").isNotNull())
    epochs = keyed.groupBy(*KEYS, "kind", "epoch").agg(F.count(F.lit(1)).alias("n"))
    return epochs.groupBy(*KEYS).agg(
        *[
            part
            for i in range(len(K.DEVICE_TYPES))
            for part in (
                F.count_if(F.col("kind") == i).alias(f"d{i}"),
                F.coalesce(F.sum(F.when(F.col("kind") == i, F.col("n"))), F.lit(0)).alias(f"n{i}"),
            )
        ]
    )


def expected_rows(frames: Frames) -> DataFrame:
    """How many rows each key will give, without making them.

    Worth a look before a fan-out run: counts only, two partial aggregates.
    """
    keys = spine(frames)
    ways = reduce(
        lambda a, b: a * b,
        [
            F.greatest(F.lit(1), F.col(f"{c}{i}")).cast("double")
            for i in range(len(K.DEVICE_TYPES))
            for c in "dn"
        ],
    )
    return keys.withColumn("rows", ways)


def finish(df: DataFrame) -> DataFrame:
    """Composite keys, day and time, final column order."""
    ms = F.col("unixTimestampInMs")
    return (
        df.withColumn("participantid_timestamp", F.concat("participant_id", F.lit("_"), "timestamp"))
        .withColumn("day", clock.epoch_day(ms))
        .withColumn("time", clock.epoch_time(ms))
        .withColumn("participantId_date", F.concat("participant_id", F.lit("_"), "day"))
        .select(*K.ALIGNED_COLUMNS)
    )


def merged_names(df: DataFrame, today: str) -> DataFrame:
    """Per participant the name of the merged file: its latest day, or today."""
    latest = F.coalesce(F.max("day"), F.lit(today))
    name = F.concat(F.lit("merged_file_"), clock.compact_date(latest), F.lit(".csv"))
    return df.groupBy("participant_id").agg(name.alias("merged_file"))
