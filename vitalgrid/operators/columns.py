"""Tolerant choice of columns by name, made when the plan is built."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_column(
    columns: Iterable[str],
    exact: str,
    any_of: Sequence[str] = (),
    all_of: Sequence[str] = (),
    none_of: Sequence[str] = (),
) -> str | None:
    """The exact name, else the first whose lower-case name fits the terms."""
    columns = list(columns)
    if exact in columns:
        return exact
    for name in columns:
        low = name.lower()
        if any_of and not any(term in low for term in any_of):
            continue
        if not all(term in low for term in all_of):
            continue
        if any(term in low for term in none_of):
            continue
        if any_of or all_of:
            return name
    return None


def find_iso_date(columns: Iterable[str]) -> str | None:
    """``isoDate`` in any case, or ``iso_date``."""
    return next((c for c in columns if c.lower() in ("isodate", "iso_date")), None)


def insert_after(df: DataFrame, anchor: str, name: str, value: Column) -> DataFrame:
    """Add a column right behind another one."""
    out: list[Column | str] = []
    for c in df.columns:
        if c == name:
            continue
        out.append(F.col(c))
        if c == anchor:
            out.append(value.alias(name))
    return df.select(*out)
