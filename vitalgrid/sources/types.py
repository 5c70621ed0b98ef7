"""Types of text columns, found from all their values in one aggregate.

Every value has a kind, kinds are single bits, and a column's kinds are the
bits of its values put together: a sum that combines before the shuffle and
has the size of one number a column, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT, LONG, DOUBLE, DATE, TIME, BOOL, TEXT = (1 << i for i in range(7))
_NAMES = {INT: "int", LONG: "bigint", DOUBLE: "double", DATE: "date", TIME: "timestamp", BOOL: "boolean", TEXT: "string"}
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}"


def kind_of(value: Column) -> Column:
    """The kind of a text; nulls and empty texts have none. A number too large for a bigint is a double."""
    whole = value.rlike(_WHOLE)
    return (
        F.when(value.isNull() | (value == ""), F.lit(0))
        .when(whole & value.try_cast("int").isNotNull(), F.lit(INT))
        .when(whole & value.try_cast("bigint").isNotNull(), F.lit(LONG))
        .when(value.rlike(_NUMBER), F.lit(DOUBLE))
        .when(value.rlike(_DAY) & value.try_cast("date").isNotNull(), F.lit(DATE))
        .when(value.rlike(_MOMENT) & value.try_cast("timestamp").isNotNull(), F.lit(TIME))
        .when(F.lower(value).isin("true", "false"), F.lit(BOOL))
        .otherwise(F.lit(TEXT))
    )


def type_of(kinds: Column) -> Column:
    """The narrowest type that holds all values of these kinds; text where there is none, or no value."""
    within = lambda allowed: (kinds != 0) & (kinds.bitwiseAND(F.lit(~allowed)) == 0)
    ladder = (INT, INT), (LONG, INT | LONG), (DOUBLE, INT | LONG | DOUBLE), (DATE, DATE), (TIME, DATE | TIME), (BOOL, BOOL)
    return reduce(lambda found, step: found.when(within(step[1]), _NAMES[step[0]]), ladder[1:], F.when(within(INT), _NAMES[INT])).otherwise(
        _NAMES[TEXT]
    )


def _kinds(names: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.bit_or(kind_of(F.col(f"`{n}`"))), F.lit(0)).alias(f"_k{i}") for i, n in enumerate(names)]


def file_types(rows: DataFrame, names: Sequence[str], by: str = "source_file") -> DataFrame:
    """(file, column, type): each file's columns, typed by its own values.

    One aggregate over all columns. A column without a value in a file is text there.
    """
    if not names:
        return rows.select(by, F.lit("").alias("column"), F.lit("").alias("type")).limit(0)
    cells = [F.struct(F.lit(n).alias("column"), type_of(F.col(f"_k{i}")).alias("type")) for i, n in enumerate(names)]
    found = rows.groupBy(by).agg(*_kinds(names)).select(by, F.explode(F.array(*cells)).alias("_c"))
    return found.select(by, "_c.column", "_c.type")


def common_types(rows: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """One type a column that holds the values of all files. One row, of one number a column, reaches the driver."""
    if not names:
        return {}
    made = rows.agg(*_kinds(names)).select(*[type_of(F.col(f"_k{i}")).alias(f"_t{i}") for i in range(len(names))]).first()
    return dict(zip(names, made))


def typed(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns cast to these types; empty texts become null where the type is no text."""
    cells = {n: F.col(f"`{n}`").try_cast(t) for n, t in types.items() if t != "string"}
    return rows.withColumns(cells) if cells else rows
