"""Arrival messages to routes and to batch status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid.functions import paths
from vitalgrid.operators import tracker
from vitalgrid.sources import arrivals as A
from vitalgrid.sources import manifest as M


def routed(messages: DataFrame) -> DataFrame:
    """Messages with the cleaner they go to; others are left out."""
    df = A.parse_routed(messages)
    return df.withColumn("route", paths.route(F.col("object_key"))).where(F.col("route").isNotNull())


def unreadable(messages: DataFrame) -> DataFrame:
    """Messages that name no stored file."""
    df = A.parse_messages(messages)
    return df.where(F.col("object_key").isNull()).select("body", F.lit("no storage record").alias("reason"))


def device_status(messages: DataFrame, listing: DataFrame, known_types: str = "frozen_on_first_arrival") -> DataFrame:
    """Batches of device files from messages (body, arrived_at) and a listing."""
    came = tracker.arrivals(A.parse_messages(messages).where(F.col("object_key").isNotNull()))
    return tracker.status(came, M.expected_counts(M.batch_files(listing)), known_types)


def survey_status(messages: DataFrame, listing: DataFrame) -> DataFrame:
    came = tracker.arrivals(A.parse_messages(messages).where(F.col("object_key").isNotNull()), [K.QUESTIONNAIRE])
    listed = M.batch_files(listing, [K.QUESTIONNAIRE])
    return tracker.survey_status(came, M.expected_counts(listed, ".csv", ".json"))
