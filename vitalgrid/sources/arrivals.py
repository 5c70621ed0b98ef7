"""Arrival messages: JSON in, bucket and key out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RECORD = "struct<eventSource:string, s3:struct<bucket:struct<name:string>, object:struct<key:string>>>"
MESSAGE = (
    f"Records array<{_RECORD}>, eventSource string, "
    "s3 struct<bucket:struct<name:string>, object:struct<key:string>>"
)


def url_text(key: Column) -> Column:
    """Undo URL quoting, plus signs included; a broken escape stays."""
    return F.coalesce(F.try_url_decode(key), F.replace(key, F.lit("+"), F.lit(" ")))


def parse_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """Add bucket and object_key: those of the first storage record.

    Null where a message is malformed, has no storage record, or lacks either.
    """
    message = F.from_json(body, MESSAGE)
    df = df.withColumn("_m", message)
    first = F.get(F.filter("_m.Records", lambda r: r["eventSource"] == "aws:s3"), F.lit(0)).getField("s3")
    alone = F.when(F.col("_m.eventSource") == "aws:s3", F.col("_m.s3"))
    s3 = F.when(F.col("_m.Records").isNotNull(), first).otherwise(alone)
    df = df.withColumn("_s3", s3)
    bucket = F.nullif(F.col("_s3.bucket.name"), F.lit(""))
    key = F.nullif(url_text(F.col("_s3.object.key")), F.lit(""))
    both = bucket.isNotNull() & key.isNotNull()
    return (
        df.withColumn("bucket", F.when(both, bucket))
        .withColumn("object_key", F.when(both, key))
        .drop("_m", "_s3")
    )


def parse_routed(df: DataFrame, body: str = "body") -> DataFrame:
    """The router's reading: the first record whatever it is, key as sent."""
    m = F.from_json(body, MESSAGE)
    return (
        df.withColumn("_r", F.get(m.getField("Records"), F.lit(0)).getField("s3"))
        .withColumn("bucket", F.col("_r.bucket.name"))
        .withColumn("object_key", F.col("_r.object.key"))
        .drop("_r")
    )
