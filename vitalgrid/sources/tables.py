"""CSV tables with a header line, read as text by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.operators import spread
from vitalgrid.session import settle
from vitalgrid.sources import lines as L


def read_text_table(
    spark: SparkSession, root: str, glob: str = "*.csv", names: Sequence[str] | None = None, keep_empty: bool = False
) -> DataFrame:
    """The rows of ``read_text_files`` where nobody asks for its rejects."""
    return read_text_files(spark, root, glob, names, keep_empty)[0]


def read_text_files(
    spark: SparkSession, root: str, glob: str = "*.csv", names: Sequence[str] | None = None, keep_empty: bool = False
) -> tuple[DataFrame, DataFrame]:
    """All files below ``root`` as one table of texts, columns by name, and the files that gave none.

    Files may differ in columns and in their order: a column a file lacks is
    null. ``keep_empty`` keeps an empty field as empty text. Quoted fields may
    run over lines. No types are guessed. The decoded lines are written once,
    so the files are read twice: for their character sets, and for this.
    """
    lines = settle(L.decode_lines(L.read_lines(spark, root, glob)).drop("charset"))
    return text_files(lines, names, keep_empty)


def text_files(lines: DataFrame, names: Sequence[str] | None = None, keep_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of numbered lines whose first line with text is the header.

    Rejected are files without rows, with a quoted field that is never closed,
    or with a record of more cells than names; a line break in a quoted field
    belongs to its cell.
    """
    facts, found = L.named_records(lines)
    rejects = L.rejected(facts).unionByName(L.unclosed(facts))
    width = L.header_width(facts)
    names = list(names or L.header_names(facts, width))
    rows = L.records(found, facts, names, width)
    if not keep_empty:
        return rows, rejects
    # empty and absent differ: an absent column is null for the whole file
    own = L.with_fields(facts, F.col("header"), width, "_own").select("source_file", "lanes", "_own")
    joined = spread.join_per_file(rows, own, "source_file", "line_no", "lanes")
    cells = [
        F.when(F.col(n).isNull() & F.array_contains("_own", n), F.lit("")).otherwise(F.col(n)).alias(n) for n in names
    ]
    return joined.select("source_file", "line_no", *cells), rejects
