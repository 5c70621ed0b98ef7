"""Typing of text columns that never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalgrid import constants as K


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def to_int(value: Column) -> Column:
    """``'72.0'`` is 72, unreadable text is null."""
    return value.try_cast("double").try_cast("int")


def to_long(value: Column) -> Column:
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def null_tokens_to_null(value: Column) -> Column:
    """The missing-value texts of device files become null."""
    return F.when(~value.isin(*K.NULL_TOKENS), value)


def outside(value: Column, bounds: tuple[int, int]) -> Column:
    return (value < bounds[0]) | (value > bounds[1])
