"""Functions on object paths and composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalgrid import constants as K


def participant_id(path: Column, gz: bool = False) -> Column:
    """The eight characters before ``.csv``; null when the name has none."""
    pattern = K.PARTICIPANT_ID_PATTERN_GZ if gz else K.PARTICIPANT_ID_PATTERN
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def segment(path: Column, index: int) -> Column:
    return F.get(F.split(path, "/"), F.lit(index))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder(path: Column) -> Column:
    """Everything before the last slash, empty when there is none."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def stem(name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def minute_key(pid: Column, minute: Column) -> Column:
    """The cleaners' key: a missing minute is written as the text ``None``."""
    return F.concat(pid, F.lit("_"), F.coalesce(minute, F.lit("None")))


def key_part(key: Column, index: int) -> Column:
    return F.get(F.split(key, "_"), F.lit(index))


def file_id(data_type: Column, name: Column) -> Column:
    return F.concat(data_type, F.lit("/"), name)


def batch_key(patient: Column, day: Column) -> Column:
    return F.concat(patient, F.lit("#"), day)


def route(path: Column) -> Column:
    """Which cleaner takes a path; null when none does."""
    kind = F.split_part(path, F.lit("/"), F.lit(2))
    takes = {K.HEART_RATE: "heart-rate", K.SLEEP: "sleep", K.STEP: "step", **{t: "others" for t in K.OTHER_TYPES}}
    table = F.create_map(*[F.lit(x) for pair in takes.items() for x in pair])
    form = path.rlike(f"^[^/]*/{K.QUESTIONNAIRE}/{K.QUESTIONNAIRE_FORM}")
    return F.when(form, F.lit("survey")).otherwise(F.try_element_at(table, kind))


def survey_clean_path(path: Column) -> Column:
    """Where a normalised survey goes; sub-folders are dropped."""
    return F.concat(
        segment(path, 0), F.lit("/questionnaire/"), stem(base_name(path)), F.lit("_cleaned.csv")
    )
