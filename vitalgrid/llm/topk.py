"""Exact top-k search by inner product: a Voronoi join.

Pivots are as many as the root of the row count, up to a bound. Queries and
rows belong to the cell of their nearest pivot. A cell of queries is summarised
by its radius ``r`` around its pivot ``p``, a cell of rows by its number of
rows, its largest distance from the pivot, its longest vector, and the k+1 rows
that score best with the pivot. For every row ``x`` and all queries ``q`` of a
cell ``p.x - r|x| <= q.x <= p.x + r|x|``; the (k+1)-th largest lower bound over
the rows of the summaries (each id once) is a score that each query of the cell
surely reaches with k other rows. A cell of rows whose summary cannot reach it
is left out as a whole; of the others those rows are sent whose own upper bound
does. They are solved exactly, with integers.

Cells of queries that lie together share a group, so a row needed by many cells
is sent once for each group of about ``block`` queries. A cell with more queries
is cut into several blocks, and a group's rows into shards, so neither a crowded
cell nor many copies of one vector meet in one task; the best k of the shards
are merged at the end. The driver sees the pivots and a few numbers a cell.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, nor do rows without an id or of another dimension than
the most common one. Rows with the query's id are its own and no candidates. A
repeated query row asks once; repeated rows are candidates each. Ties go to the
smaller id. Without rows there are no results. Only the id and the vector are
read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.session import scratch, settle

#: Products of integers below this, summed over 4096 components, are exact in doubles.
EXACT = 1 << 20


@dataclass(frozen=True)
class Search:
    k: int = 5
    #: Queries of a block and rows of a shard: the size of a local problem.
    block: int = 1024
    shard: int = 32_768
    #: Bound of the pivots, and so of what reaches the driver: a vector and a few numbers each.
    most_cells: int = 1024


def whole(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def matrix(column) -> np.ndarray:
    """Rows of equal length from an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 1))


def _cells(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.argmin((pivots**2).sum(1) - 2 * (x @ pivots.T), axis=1)


def _pivots(rows: DataFrame, n: int) -> np.ndarray:
    """n distinct vectors, those with the smallest hashes of their ids."""
    found = rows.orderBy(F.xxhash64(F.lit("pivot"), "id"), "id").limit(n).collect()
    return np.unique(np.array([r["v"] for r in found], np.float64), axis=0)


def _query_cells(queries: DataFrame, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Radius (-1 without queries) and number of queries of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, number = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1)).astype(np.float64)
                cell = _cells(x, pivots)
                np.maximum.at(most, cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1)))
                np.add.at(number, cell, 1)
        at = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(most[at]), pa.array(number[at])], ["cell", "radius", "n"])

    radii, number = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    found = queries.mapInArrow(run, "cell bigint, radius double, n bigint").groupBy("cell")
    for r in found.agg(F.max("radius").alias("radius"), F.sum("n").alias("n")).collect():
        radii[r["cell"]], number[r["cell"]] = r["radius"], r["n"]
    return radii, number


def _row_cells(data: DataFrame, pivots: np.ndarray, k: int) -> tuple[dict[str, np.ndarray], DataFrame]:
    """Summaries of the cells of rows: numbers for the driver, and a table of (id, v).

    The numbers are ``n``, ``most`` (largest distance from the pivot) and
    ``longest`` (length of a vector); the table holds for each cell the rows of
    the k+1 ids that score best with its pivot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, n = len(pivots), np.zeros(len(pivots), np.int64)
        most, longest = np.full(cells, -1.0), np.full(cells, -1.0)
        best: dict[int, dict[int, float]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1)).astype(np.float64)
            cell = _cells(x, pivots)
            np.add.at(n, cell, 1)
            np.maximum.at(most, cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1)))
            np.maximum.at(longest, cell, np.sqrt((x**2).sum(1)))
            score = (x * pivots[cell]).sum(1)
            order = np.lexsort((-score, cell))
            borders = np.flatnonzero(np.diff(cell[order], prepend=-1, append=cells))
            for start, end in zip(borders[:-1], borders[1:]):
                kept = best.setdefault(int(cell[order[start]]), {})
                for at in order[start:end]:
                    if len(kept) > k and score[at] <= min(kept.values()):
                        break
                    i = int(ids[at])
                    kept[i] = max(kept.get(i, -np.inf), float(score[at]))
                    if len(kept) > k + 1:
                        del kept[min(kept, key=kept.get)]
        for c, kept in best.items():
            same = [n[c], most[c], longest[c]]
            first = pa.array([True] + [False] * (len(kept) - 1))
            columns = [pa.array([v] * len(kept)) for v in (c, *same)]
            yield pa.RecordBatch.from_arrays(
                [*columns, first, pa.array(kept.keys(), pa.int64()), pa.array(kept.values(), pa.float64())],
                ["cell", "n", "most", "longest", "first", "id", "score"],
            )

    told = data.mapInArrow(run, "cell bigint, n bigint, most double, longest double, first boolean, id bigint, score double")
    told = settle(told)
    numbers = {"n": np.zeros(len(pivots), np.int64), "most": np.full(len(pivots), -1.0), "longest": np.full(len(pivots), -1.0)}
    sums = told.where("first").groupBy("cell").agg(F.sum("n").alias("n"), F.max("most").alias("most"), F.max("longest").alias("longest"))
    for r in sums.collect():
        for name, column in numbers.items():
            column[r["cell"]] = r[name]
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.col("score").desc(), "id"))
    ids = told.groupBy("cell", "id").agg(F.max("score").alias("score")).withColumn("rank", rank).where(F.col("rank") <= k + 1)
    # at most k + 1 ids for each of the bounded number of cells
    members = data.join(F.broadcast(ids.select("id").distinct()), "id", "left_semi")
    return numbers, members.distinct()


def _needed(pivots: np.ndarray, radii: np.ndarray, numbers: dict[str, np.ndarray], reached: np.ndarray) -> np.ndarray:
    """For each cell of queries the cells of rows whose summary reaches its bound."""
    length = np.sqrt((pivots**2).sum(1))
    middle = pivots @ pivots.T
    spread = radii[:, None] * length + (length + radii)[:, None] * numbers["most"]
    upper = np.minimum(middle + spread, (length + radii)[:, None] * numbers["longest"])
    upper = upper + 1e-9 * (np.abs(middle) + np.abs(spread)) + 1e-6
    return (upper >= reached[:, None]) & (radii >= 0)[:, None] & (numbers["n"] > 0)


def _groups(pivots: np.ndarray, number: np.ndarray, block: int) -> np.ndarray:
    """The group of each cell: cells are halved along their widest dimension until a part has at most ``block`` queries."""
    group = np.zeros(len(pivots), np.int64)
    parts, made = [np.flatnonzero(number)], 0
    while parts:
        cells = parts.pop()
        if len(cells) < 2 or number[cells].sum() <= block:
            group[cells], made = made, made + 1
            continue
        x = pivots[cells]
        order = cells[np.argsort(x[:, np.argmax(x.max(0) - x.min(0))], kind="stable")]
        parts += [order[: len(order) // 2], order[len(order) // 2 :]]
    return group


def _bounds(x: np.ndarray, pivots: np.ndarray, radii: np.ndarray, sign: int) -> np.ndarray:
    """Upper (sign 1) or lower (-1) bounds of every row's score in every cell, with room for rounding."""
    middle, spread = x @ pivots.T, np.sqrt((x**2).sum(1))[:, None] * radii
    return middle + sign * (spread + 1e-9 * (np.abs(middle) + spread) + 1e-6)


def _reached(rows: DataFrame, pivots: np.ndarray, radii: np.ndarray, k: int) -> np.ndarray:
    """A score that every query of a cell reaches with k rows besides its own.

    A query may stand on several rows, so each id counts once, with its best bound.
    """

    def best_of(low: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k + 1 largest bounds of each cell with their ids, each id once."""
        order = np.argsort(-low, axis=0, kind="stable")
        low, ids = np.take_along_axis(low, order, 0), np.take_along_axis(ids, order, 0)
        for i in range(1, len(ids)):
            low[i, (ids[:i] == ids[i]).any(axis=0)] = -np.inf
        order = np.argsort(-low, axis=0, kind="stable")[: k + 1]
        return np.take_along_axis(low, order, 0), np.take_along_axis(ids, order, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, names = np.empty((0, len(pivots))), np.empty((0, len(pivots)), np.int64)
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0).to_numpy()
                low = _bounds(matrix(batch.column(1)).astype(np.float64), pivots, radii, -1)
                order = np.argsort(ids, kind="stable")
                ids, starts = np.unique(ids[order], return_index=True)
                low = np.maximum.reduceat(low[order], starts, axis=0)
                top = np.argsort(-low, axis=0, kind="stable")[: k + 1]
                best, names = best_of(np.vstack([best, np.take_along_axis(low, top, 0)]), np.vstack([names, ids[top]]))
        cells = np.repeat(np.arange(len(pivots)), len(best))
        low, ids = best.T.ravel(), names.T.ravel()
        real = low > -np.inf
        yield pa.RecordBatch.from_arrays([pa.array(cells[real]), pa.array(ids[real]), pa.array(low[real])], ["cell", "id", "low"])

    rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.col("low").desc()))
    found = rows.mapInArrow(run, "cell bigint, id bigint, low double").groupBy("cell", "id").agg(F.max("low").alias("low"))
    found = found.withColumn("rank", rank).where(F.col("rank") == k + 1)
    reached = np.full(len(pivots), -np.inf)
    for r in found.collect():
        reached[r["cell"]] = r["low"]
    return reached


def _solve(query_ids, queries, ids, rows, k: int):
    """The k best rows of each query: parallel lists of query, row and score."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    largest = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0))
    kind = np.float64 if largest < EXACT and rows.shape[1] <= 4096 else np.int64
    rows, out = rows.astype(kind).T, []
    lowest = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
    for start in range(0, len(queries), 64):
        scores = queries[start : start + 64].astype(kind) @ rows
        for q, s in zip(query_ids[start : start + 64], scores):
            s[np.searchsorted(ids, q, "left") : np.searchsorted(ids, q, "right")] = lowest
            m = min(k, len(s))
            at = np.flatnonzero(s >= np.partition(s, len(s) - m)[len(s) - m])
            at = at[s[at] > lowest]
            at = at[np.argsort(-s[at], kind="stable")][:k]
            out.append((np.full(len(at), q), ids[at], s[at].astype(np.int64)))
    return [np.concatenate(x) for x in zip(*out)]


def search(
    vectors: DataFrame, is_query: Column, search: Search | None = None, scale: float = 256.0,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of every row that ``is_query``, among all rows."""
    own = search or Search()
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    rows = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), whole(F.col(vector), scale).alias("v"), is_query.alias("asks")
    )
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    _, _, dim, n, asked = max((r["n"], -r["dim"], r["dim"], r["n"], r["q"]) for r in sizes)
    rows = rows.where(F.size("v") == dim)
    queries = rows.where("asks").select("id", "v").distinct()
    data = rows.select("id", "v")
    if not asked:
        return spark.createDataFrame([], schema)
    with scratch(spark):
        pivots = _pivots(data, max(1, min(own.most_cells, math.isqrt(n))))
        radii, number = _query_cells(queries, pivots)
        numbers, members = _row_cells(data, pivots, own.k)
        reached = _reached(members, pivots, radii, own.k)
    needed = _needed(pivots, radii, numbers, reached)
    group = _groups(pivots, number, own.block)
    groups = int(group.max()) + 1
    cells_of = [np.flatnonzero((group == g) & (number > 0)) for g in range(groups)]
    shards = -(-n // own.shard)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = _cells(matrix(batch.column(1)).astype(np.float64), pivots)
                yield pa.RecordBatch.from_arrays([pa.array(group[cell]), *batch.columns], ["cell", "id", "v"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = needed.any(axis=0)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1)).astype(np.float64)
            cell = _cells(x, pivots)
            at = np.flatnonzero(wanted[cell])
            reaches = (_bounds(x[at], pivots, radii, 1) >= reached) & needed[:, cell[at]].T
            for g, cells in enumerate(cells_of):
                kept = batch.take(pa.array(at[reaches[:, cells].any(axis=1)]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(kept.num_rows, g)), *kept.columns], ["cell", "id", "v"])

    placed = queries.mapInArrow(place, "cell bigint, id bigint, v array<bigint>")
    counts = [max(1, -(-int(number[cells].sum()) // own.block)) for cells in cells_of]
    blocks = F.element_at(F.lit(counts), (F.col("cell") + 1).cast("int"))
    asking = placed.withColumn("block", F.pmod(F.xxhash64("id"), blocks)).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    sent = data.mapInArrow(send, "cell bigint, id bigint, v array<bigint>").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1))
    ).withColumn("shard", F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards)).cast("int"))

    def solve(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        found = _solve(left["id"].to_numpy(), matrix(left["v"]), right["id"].to_numpy(), matrix(right["v"]), own.k)
        return pa.table(dict(zip(names, map(pa.array, found))))

    unit = ["cell", "block", "shard"]
    asking = asking.select(*[F.col(c).cast("long").alias(c) for c in unit], "id", "v")
    sent = sent.select(*[F.col(c).cast("long").alias(c) for c in unit], "id", "v")
    local = asking.groupBy(*unit).cogroup(sent.groupBy(*unit)).applyInArrow(solve, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return local.withColumn("rank", rank).where(F.col("rank") <= own.k).select("query_id", "rank", "vec_id", "score")
