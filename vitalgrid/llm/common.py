"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts name it.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column, gap: str = SPACE) -> Column:
    """The non-empty words between the gaps; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), gap, -1), lambda w: w != "")


def doc_crc(doc_id: Column) -> Column:
    """crc32 of an id written as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def tokenizer_file(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)
