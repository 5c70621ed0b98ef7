"""Wall-clock and epoch functions, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(?: ?(?:Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:\.\d+)?)?)?))?"
_ISO = (
    r"^(\d{4})-?(\d\d)-?(\d\d)(?:\D(\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,]\d+)?)?)?" + _OFFSET + ")?$"
)
_USUAL = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(?:[.,]\d+)?" + _OFFSET + "$"
_CANONICAL = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"


def wall_clock(iso: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as *written*: an offset is cut, not applied.

    Null where the text is no ISO date. The usual form costs one pattern test
    and two substrings. Other extended and basic forms, with hours, minutes or
    seconds left out, are rewritten first. The result is text throughout, so
    no session time zone takes part.
    """
    usual = F.concat(F.substring(iso, 1, 10), F.lit(" "), F.substring(iso, 12, 8))
    parts = F.regexp_replace(iso, _ISO, "$1-$2-$3 $4:$5:$6")
    other = F.regexp_replace(parts, "([ :])(?=:|$)", "$100")
    return F.when(
        iso.rlike(_USUAL), F.when(usual.try_cast("timestamp_ntz").isNotNull(), usual)
    ).otherwise(
        F.when(other.rlike(_CANONICAL) & other.try_cast("timestamp_ntz").isNotNull(), other)
    )


def iso_minute(iso: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` of the written wall clock, null when unreadable."""
    return F.substring(wall_clock(iso), 1, 16)


def iso_second(iso: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; an unreadable text stays as it is."""
    return F.coalesce(wall_clock(iso), iso)


def iso_date(iso: Column) -> Column:
    """``yyyy-MM-dd``, with the fall-backs for texts that are no ISO date.

    In order: the parsed date; the part before a blank; the first ten
    characters when they are shaped like a date; null.
    """
    text = F.trim(iso)
    plain = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    shaped = (
        (F.length(plain) >= 10)
        & (F.substring(plain, 5, 1) == "-")
        & (F.substring(plain, 8, 1) == "-")
    )
    return F.coalesce(
        F.substring(wall_clock(text), 1, 10),
        F.when(plain.contains(" "), F.substring_index(plain, " ", 1)),
        F.when(shaped, F.substring(plain, 1, 10)),
    )


_PARTS_OF_DAY = ["night"] * 5 + ["morning"] * 7 + ["noon"] * 5 + ["evening"] * 4 + ["night"] * 3


def time_of_day(iso: Column) -> Column:
    """morning, noon, evening, night or unknown, by the written hour."""
    hour = F.substring(wall_clock(iso), 12, 2).try_cast("int")
    return F.coalesce(F.get(F.array(*[F.lit(p) for p in _PARTS_OF_DAY]), hour), F.lit("unknown"))


def epoch_text(ms: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_millis(ms), pattern)


def epoch_day(ms: Column) -> Column:
    return epoch_text(ms, "yyyy-MM-dd")


def epoch_time(ms: Column) -> Column:
    return epoch_text(ms, "HH:mm:ss")


def epoch_minute(ms: Column) -> Column:
    return epoch_text(ms, "yyyy-MM-dd HH:mm")


def compact_date(day: Column) -> Column:
    """``yyyy-MM-dd`` to ``yyyyMMdd``."""
    return F.replace(day, F.lit("-"), F.lit(""))
