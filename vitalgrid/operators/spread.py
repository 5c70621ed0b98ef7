"""Ways to work per file or per participant without one task holding a group.

A single file or participant may hold a large part of all rows. The operators
here therefore never sort, number or join a whole group in one task. They cut
the group into cells whose size is bounded, work inside the cells, and pass
only one summary row per cell along the group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.session import settle

CHUNK_ROWS = 1 << 18
HEAVY_ROWS = 1 << 20
LANES = 64
_LOWEST = -(1 << 63)


def chunk_of(position: str | Column, rows: int = CHUNK_ROWS) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return F.floor(position / F.lit(rows)).cast("bigint")


def lane_of(position: str | Column, rows: int = CHUNK_ROWS) -> Column:
    """One of ``LANES`` numbers; neighbouring chunks of a file have different ones."""
    return F.pmod(chunk_of(position, rows), F.lit(LANES))


def lanes(position: str | Column, rows: int = CHUNK_ROWS) -> Column:
    """Aggregate: the lanes a file's rows really are in, at most ``LANES``."""
    return F.collect_set(lane_of(position, rows))


def join_per_file(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    position: str,
    lanes_of: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Join one row of facts per file to all rows of the file (inner).

    ``facts`` carries the ``lanes`` of the file's rows. Its row is repeated
    once for each, so the join key is (file, lane): a large file is spread over
    many keys, and a small one is not repeated, whatever its line numbers are.
    """
    per_lane = facts.withColumn("_lane", F.explode(lanes_of)).drop(lanes_of)
    return rows.withColumn("_lane", lane_of(position, chunk_rows)).join(per_lane, [key, "_lane"]).drop("_lane")


def with_row_index(
    rows: DataFrame, key: str, position: str, name: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Dense 0-based row number per file, in order of ``position``.

    Chunks are counted first (a partial aggregate), the counts are summed along
    the file, and rows are numbered inside their chunk only.
    """
    cut = rows.withColumn("_chunk", chunk_of(position, chunk_rows))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(key, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(key, "_chunk").orderBy(position)
    return (
        cut.join(starts, [key, "_chunk"])
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_chunk", "_start")
    )


def heavy_keys(rows: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """All keys with more than ``heavy_rows`` rows, and their numbers ``_n``.

    There is less than one such key for each ``heavy_rows`` rows of the input.
    """
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy_rows)


def _mark(rows: DataFrame, listed: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add the number of rows of listed keys as ``name``, null for the others."""
    side = listed.select(*[F.col(c).alias(f"_h_{c}") for c in keys], F.col("_n").alias(name))
    same = reduce(
        lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in keys]
    )
    return rows.join(side, same, "left").drop(*[f"_h_{c}" for c in keys])


def _cells(
    rows: DataFrame, group: Sequence[str], order: str, tie: str, width: int, heavy_rows: int
) -> DataFrame:
    """Add ``_cell``: contiguous pieces of each group in (order, tie) order.

    A cell is a slot of ``width`` in ``order``. Where a slot has more than
    ``heavy_rows`` rows it is cut into equal parts by its number of rows, and
    a part that is still too large (rows crowding on few values) by the exact
    value and by chunks of ``tie``, which numbers rows.
    """
    value = F.coalesce(F.col(order), F.lit(_LOWEST))
    none = F.lit(0).cast("bigint")
    # in doubles: monotone in ``order``, and an absurd epoch cannot overflow
    slot = F.coalesce(F.floor(F.col(order) / F.lit(float(width))), F.lit(_LOWEST))
    into = F.col(order).cast("double") - F.col("_slot") * F.lit(float(width))
    slots = rows.withColumn("_slot", slot)
    where = [*group, "_slot"]
    largest = slots.groupBy(*where).count().agg(F.max("count").alias("n")).first()["n"]
    if largest is None or largest <= heavy_rows:
        return slots.withColumn("_cell", F.struct("_slot")).drop("_slot")

    target = max(1, heavy_rows // 4)
    marked = _mark(slots, heavy_keys(slots, where, heavy_rows), where, "_in_slot")
    part = F.greatest(F.lit(1), F.floor(F.lit(float(width) * target) / F.col("_in_slot")))
    marked = marked.withColumn(
        "_part", F.coalesce(F.when(F.col("_in_slot").isNotNull(), F.floor(into / part)), none)
    )
    crowded = heavy_keys(marked.where(F.col("_in_slot").isNotNull()), [*where, "_part"], heavy_rows)
    marked = _mark(marked, crowded, [*where, "_part"], "_in_part")
    tight = F.col("_in_part").isNotNull()
    cell = F.struct(
        "_slot",
        "_part",
        F.when(tight, value).otherwise(none).alias("_at"),
        F.when(tight, chunk_of(tie, target)).otherwise(none).alias("_piece"),
    )
    return marked.withColumn("_cell", cell).drop("_slot", "_in_slot", "_part", "_in_part")


def with_neighbours(
    rows: DataFrame,
    group: Sequence[str],
    order: str,
    tie: str,
    value: str,
    previous: str | None = None,
    following: str | None = None,
    width: int = 86_400_000,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``value`` of the row before and after, per group, nulls of ``order`` first.

    Equal to lag and lead over the whole group. Groups with at most
    ``heavy_rows`` rows are sorted whole: one count and one exchange of the
    rows. Larger ones are listed by the count and sorted in cells of at most
    about that many rows (see ``_cells``; ``width`` is a day for epochs in ms).
    """
    group = list(group)
    listed = settle(heavy_keys(rows, group, heavy_rows))
    inside = Window.partitionBy(*group).orderBy(F.col(order).asc_nulls_first(), tie)
    if listed.isEmpty():
        return _lag_lead(rows, inside, value, previous, following)
    side = listed.select(*[F.col(c).alias(f"_h_{c}") for c in group])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in group])
    light = _lag_lead(rows.join(side, same, "left_anti"), inside, value, previous, following)
    crowded = rows.join(side, same, "left_semi")
    heavy = _neighbours_in_cells(crowded, group, order, tie, value, previous, following, width, heavy_rows)
    return light.unionByName(heavy)


def _lag_lead(rows: DataFrame, along: Window, value: str, previous: str | None, following: str | None) -> DataFrame:
    found = {previous: F.lag(value).over(along), following: F.lead(value).over(along)}
    return rows.withColumns({name: column for name, column in found.items() if name})


def _neighbours_in_cells(
    rows: DataFrame, group: list[str], order: str, tie: str, value: str,
    previous: str | None, following: str | None, width: int, heavy_rows: int,
) -> DataFrame:
    """The first row of a cell takes its value from the last row of the cell before, found among one edge row per cell."""
    cut = _cells(rows, group, order, tie, width, heavy_rows)
    spot = F.struct(order, tie)
    edge = F.struct(F.col(value).alias("v"))
    along = Window.partitionBy(*group).orderBy("_cell")
    edges = (
        cut.groupBy(*group, "_cell")
        .agg(F.min_by(edge, spot).alias("_head"), F.max_by(edge, spot).alias("_tail"))
        .select(
            *group,
            "_cell",
            F.lag("_tail").over(along).alias("_edge_before"),
            F.lead("_head").over(along).alias("_edge_after"),
        )
    )
    inside = Window.partitionBy(*group, "_cell").orderBy(F.col(order).asc_nulls_first(), tie)
    out = cut.join(edges, [*group, "_cell"])
    here = F.struct(F.col(value).alias("v"))
    if previous:
        out = out.withColumn(
            previous, F.coalesce(F.lag(here).over(inside), F.col("_edge_before")).getField("v")
        )
    if following:
        out = out.withColumn(
            following, F.coalesce(F.lead(here).over(inside), F.col("_edge_after")).getField("v")
        )
    return out.drop("_cell", "_edge_before", "_edge_after")


def repeat_rows(rows: DataFrame, times: str | Column, index: str, step: int = 4096) -> DataFrame:
    """Each row ``times`` times, numbered from 0 in ``index``.

    Two generators, so a very large count never becomes one long array.
    """
    n = (F.col(times) if isinstance(times, str) else times).cast("bigint")
    long = lambda v: F.lit(v).cast("bigint")
    rows = rows.withColumn("_times", n).where(F.col("_times") > 0)
    rows = rows.withColumn("_from", F.explode(F.sequence(long(0), F.col("_times") - 1, long(step))))
    last = F.least(F.col("_from") + (step - 1), F.col("_times") - 1)
    return rows.withColumn(index, F.explode(F.sequence(F.col("_from"), last))).drop("_times", "_from")
