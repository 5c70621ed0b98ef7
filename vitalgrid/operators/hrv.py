"""Heart-rate-variability summary: one row per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import clock, numbers, paths
from vitalgrid.operators import columns, spread
from vitalgrid.session import settle

_CONSUMED = (
    "bbi", "bbi_diff", "bbi_diff_squared", "prev_bbi", "diff", "window_5min",
    "timestamp_seconds", "unixTimestampInMs",
)
METRICS = ("sdrr", "rmssd", "rr50", "prr50", "mean_bbi", "heart_rate", "record_count")


def _owner() -> Column:
    """The id in the file name, else the file name without ``.csv``."""
    path = F.col("source_file")
    name = F.replace(paths.base_name(path), F.lit(".csv"), F.lit(""))
    return F.coalesce(paths.participant_id(path), name)


def _or_zero(value: Column) -> Column:
    return F.round(F.coalesce(value, F.lit(0.0)), 4)


def summarise(df: DataFrame, tie: str = "line_no", **cells) -> DataFrame:
    """HRV metrics per file. All aggregates combine before the one shuffle.

    ``bbi_diff`` is used when present; otherwise differences to the interval
    before are made. A file set without intervals or epochs gives zeros.
    """
    kept = [c for c in df.columns if c not in _CONSUMED and c not in ("source_file", tie)]
    if "bbi" not in df.columns or "unixTimestampInMs" not in df.columns:
        return _zeros(df, tie)
    ms = numbers.to_long(F.col("unixTimestampInMs"))
    df = df.withColumn("unixTimestampInMs", ms).withColumn("bbi", numbers.to_double(F.col("bbi")))
    if "bbi_diff" in df.columns:
        df = df.withColumn("_diff", numbers.to_double(F.col("bbi_diff")))
    else:
        df = spread.with_neighbours(
            df, ["source_file"], "unixTimestampInMs", tie, "bbi", previous="_before", **cells
        ).withColumn("_diff", F.col("bbi") - F.col("_before"))
    first = F.min_by(F.struct(*kept, "source_file"), F.struct("unixTimestampInMs", tie))
    sums = df.groupBy("source_file").agg(
        first.alias("_first"),
        F.min("unixTimestampInMs").alias("_start"),
        F.avg("bbi").alias("_mean"),
        F.stddev_samp("bbi").alias("_sd"),
        F.sqrt(F.avg(F.pow("_diff", F.lit(2)))).alias("_rms"),
        F.count_if(F.col("_diff") > 50).alias("rr50"),
        F.count("_diff").alias("_pairs"),
        F.count(F.lit(1)).alias("record_count"),
    )
    mean = _or_zero(F.col("_mean"))
    day = clock.epoch_day(F.col("_start"))
    return sums.select(
        F.concat(_owner(), F.lit("_"), day).alias("participantId_date"),
        *[F.col(f"_first.{c}").alias(c) for c in kept],
        _or_zero(F.col("_sd")).alias("sdrr"),
        _or_zero(F.col("_rms")).alias("rmssd"),
        F.col("rr50"),
        F.when(F.col("_pairs") > 0, F.round(F.col("rr50") / F.col("_pairs") * 100, 4))
        .otherwise(F.lit(0.0)).alias("prr50"),
        mean.alias("mean_bbi"),
        F.when(mean > 0, F.round(F.lit(60000.0) / mean, 4)).otherwise(F.lit(0.0)).alias("heart_rate"),
        F.col("record_count"),
        F.col("source_file"),
    )


def _zeros(df: DataFrame, tie: str) -> DataFrame:
    """Files whose columns do not allow metrics: first row and zeros."""
    kept = [c for c in df.columns if c not in ("source_file", tie)]
    first = df.groupBy("source_file").agg(
        F.min_by(F.struct(*kept, "source_file"), F.col(tie)).alias("_first"),
        F.count(F.lit(1)).alias("record_count"),
    )
    zero = F.lit(0.0)
    return first.select(
        F.concat(_owner(), F.lit("_unknown")).alias("participantId_date"),
        *[F.col(f"_first.{c}").alias(c) for c in kept],
        zero.alias("sdrr"), zero.alias("rmssd"), F.lit(0).cast("bigint").alias("rr50"), zero.alias("prr50"),
        zero.alias("mean_bbi"), zero.alias("heart_rate"), F.col("record_count"), F.col("source_file"),
    )


def split_failures(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files that can be summarised, and rejects for those that cannot.

    A file without any readable epoch has no start date; it is reported
    instead of summarised.
    """
    return (
        df.where(F.col("participantId_date").isNotNull()),
        df.where(F.col("participantId_date").isNull()).select(
            "source_file", F.lit("no readable epoch").alias("reason")
        ),
    )


def merge_folders(summaries: DataFrame, today: str) -> DataFrame:
    """Summaries with date-only ``isoDate`` and the name of their folder's file.

    ``merged_file_{latest date}``; ``today`` is used where no date is known.
    """
    # one row per file, used for the names and for the rows: kept, because
    # making it again would read all intervals again
    df = settle(summaries.withColumn("folder", paths.folder(F.col("source_file"))))
    iso = columns.find_iso_date(df.columns)
    if iso is None:
        latest = F.lit(today)
        return df.withColumn("merged_file", _merged_name(latest))
    df = df.withColumn(iso, clock.iso_date(F.col(iso).cast("string")))
    names = df.groupBy("folder").agg(F.max(iso).alias("_latest"))
    latest = F.coalesce(clock.iso_date(F.nullif(F.col("_latest"), F.lit(""))), F.lit(today))
    return (
        df.join(names.select("folder", _merged_name(latest).alias("merged_file")), "folder", "left")
    )


def _merged_name(day: Column) -> Column:
    return F.concat(F.lit("merged_file_"), clock.compact_date(day), F.lit(".csv"))
