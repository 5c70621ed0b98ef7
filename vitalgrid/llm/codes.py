"""Vector code compression: product codes by k-means with adaptive bounds.

A vector is cut into equal consecutive parts; each part position has a codebook
of entries, and a vector's code is the nearest entry of each of its parts.
Rounds of assigning and averaging run on whole numbers, so every result is
exact and does not depend on the order of rows.

Bounds after Drake and Hamerly. Between rounds a table keeps for each part the
nearest entry with an upper bound of its distance, its ``b`` closest other
entries with a lower bound each, and one outer bound for all entries beyond.
When entries move, bounds move by as much. A part whose upper bound lies below
all lower bounds keeps its entry without any distance; else the integer
distances of the entries up to the first safe bound decide, ties to the lower
index, and only where the outer bound does not hold are all entries compared.
After each round ``b`` shrinks to the least number that was enough for all but
a small share of the parts.

One round is one pass over the written table: tasks write their rows and one
row of sums (a task's sums, counts and depths), so what reaches the driver is
one number for each codebook component, whatever the number of rows. No vector
is shuffled. The table of a round is deleted when the next one is written.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, nor do those of another dimension than the most common
one (it must be a multiple of the number of parts). Null ids come last in the
choice of the first entries; equal ids are ordered by their vectors. Repeated
rows are coded each. Fewer rows than entries make fewer entries. Null labels
are one group. Without rows there are no results. Only id, vector and label are
read, so other columns cannot clash. The square of the largest scaled component
times the part's length must stay below ``2**53`` (components of about 8,000 for
parts of eight and a scale of 4096), which keeps distances within 64 bits; a
larger one is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.topk import matrix, usable, whole
from vitalgrid.session import remove, scratch, settle

#: Room for rounding where two bounds are compared.
ROOM = 1e-9
UP, DOWN = np.float32(np.inf), np.float32(-np.inf)


@dataclass(frozen=True)
class Codes:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: float = 4096.0
    #: Other entries that a part keeps a bound for: at first, and at least.
    near: int = 4
    least_near: int = 1
    #: Share of parts that may need more entries than are kept.
    rarely: float = 0.01


def rounded(x: np.ndarray, towards: np.float32) -> np.ndarray:
    """As four-byte floats that lie on the given side of the values."""
    out = x.astype(np.float32)
    wrong = out < x if towards > 0 else out > x
    return np.where(wrong, np.nextafter(out, towards), out)


def _ranked(x: np.ndarray, entries: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers (m, k) by integer distance and number, with these distances.

    ``x`` is (m, d), ``entries`` (m, k, d) or (k, d), ``names`` (m, k) or (k,).
    """
    found = ((x[:, None, :] - entries) ** 2).sum(2)
    key = found * 256 + names
    key.sort(axis=1)
    return (key & 255).astype(np.uint8), key >> 8


def full_scan(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """State of parts (m, d) of one position from all distances: near entries (m, b + 1) and bounds (m, b + 2)."""
    names, far = _ranked(x, book, np.arange(len(book)))
    roots = np.sqrt(far.astype(np.float64))
    bounds = np.full((len(x), b + 2), np.inf, np.float32)
    bounds[:, 0] = rounded(roots[:, 0] * (1 + ROOM), UP)
    kept = min(b + 2, len(book))
    bounds[:, 1:kept] = rounded(roots[:, 1:kept] * (1 - ROOM), DOWN)
    near = np.zeros((len(x), b + 1), np.uint8)
    near[:, : min(b + 1, len(book))] = names[:, : b + 1]
    return near, bounds


def advance(x, book, moves, near, bounds, b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The state of one position's parts after its entries moved, with ``b`` bounds kept, and each part's depth.

    Depth 0: kept without a distance; i: the first i + 1 near entries were
    compared; one more than there are near entries: all were.
    """
    had = near.shape[1] - 1
    at = bounds.astype(np.float64)
    at[:, 0] += moves[near[:, 0]]
    at[:, 1:-1] -= moves[near[:, 1:]]
    at[:, -1] -= moves.max(initial=0)
    safe = np.minimum.accumulate(at[:, :0:-1], axis=1)[:, ::-1]
    below = at[:, :1] * (1 + ROOM) < safe * (1 - ROOM)
    depth = np.where(below.any(axis=1), below.argmax(axis=1), had + 1)
    near = near.copy()
    for i in range(1, had + 1):
        some = np.flatnonzero(depth == i)
        if len(some):
            names = near[some, : i + 1]
            names, far = _ranked(x[some], book[names], names.astype(np.int64))
            near[some, : i + 1] = names
            roots = np.sqrt(far.astype(np.float64))
            at[some, 0] = roots[:, 0] * (1 + ROOM)
            at[some, 1 : i + 1] = roots[:, 1:] * (1 - ROOM)
    out = np.empty((len(x), b + 2), np.float32)
    out[:, 0] = rounded(at[:, 0], UP)
    out[:, 1 : b + 1] = rounded(at[:, 1 : b + 1], DOWN)
    out[:, b + 1] = rounded(at[:, b + 1 :].min(axis=1), DOWN)
    near = near[:, : b + 1].copy()
    some = np.flatnonzero(depth == had + 1)
    if len(some):
        near[some], out[some] = full_scan(x[some], book, b)
    return near, out, depth


def _flat(column: pa.Array, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _binary(x: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    raw = np.ascontiguousarray(x).reshape(len(x), -1).view(np.uint8)
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(raw.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])


def _round(rows: DataFrame, book: np.ndarray, moves: np.ndarray | None, b_had: int, b: int) -> DataFrame:
    """One pass: rows with their new state, and a row of sums for each task.

    The sums are, one after the other: of each component by entry, of parts by
    entry, and of parts by depth.
    """
    parts, entries, d = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, depths = np.zeros(book.shape, np.int64), np.zeros((parts, entries), np.int64), np.zeros(258, np.int64)
        names = ["id", "label", "v", "near", "bounds", "sums"]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = matrix(batch.column(2)).reshape(n, parts, d)
            near, bounds = np.empty((n, parts, b + 1), np.uint8), np.empty((n, parts, b + 2), np.float32)
            if moves is not None:
                old_near, old_bounds = _flat(batch.column(3), np.uint8, parts, b_had + 1), _flat(batch.column(4), np.float32, parts, b_had + 2)
            for p in range(parts):
                if moves is None:
                    near[:, p], bounds[:, p] = full_scan(x[:, p], book[p], b)
                else:
                    near[:, p], bounds[:, p], depth = advance(x[:, p], book[p], moves[p], old_near[:, p], old_bounds[:, p], b)
                    depths += np.bincount(depth, minlength=len(depths))
                own = near[:, p, 0]
                counts[p] += np.bincount(own, minlength=entries)
                order = np.argsort(own, kind="stable")
                there, starts = np.unique(own[order], return_index=True)
                sums[p, there] += np.add.reduceat(x[order, p], starts, axis=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), _binary(near), _binary(bounds), pa.nulls(n, pa.list_(pa.int64()))], names
            )
        none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())]
        made = pa.array([np.concatenate([sums.ravel(), counts.ravel(), depths])], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*none, made], names)

    schema = "id bigint, label bigint, v array<bigint>, near binary, bounds binary, sums array<bigint>"
    return settle(rows.mapInArrow(run, schema))


def _summed(state: DataFrame, length: int) -> np.ndarray:
    """The tasks' sums added up: one row for each place of the list."""
    out = np.zeros(length, np.int64)
    for r in state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def _next_near(depths: np.ndarray, b: int, own: Codes) -> int:
    """The least number of near entries that was enough for nearly all parts of a round."""
    if not depths.sum():
        return b
    beyond = 1 - np.cumsum(depths) / depths.sum()
    enough = np.flatnonzero(beyond <= own.rarely)
    return max(own.least_near, min(b, int(enough[0])))


def _first_entries(rows: DataFrame, own: Codes, dim: int) -> np.ndarray:
    """The vectors of the smallest ids, cut into parts: (parts, entries, length)."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(own.entries).collect()
    found = np.array([r["v"] for r in first], np.int64).reshape(len(first), own.parts, dim // own.parts)
    return found.transpose(1, 0, 2).copy()


def train(rows: DataFrame, own: Codes, dim: int) -> tuple[DataFrame, np.ndarray, list[dict]]:
    """Rows (id, label, v) to their last state, the codebooks, and what each round needed."""
    spark = rows.sparkSession
    book = _first_entries(rows, own, dim)
    if own.entries > 256 or dim % own.parts:
        raise ValueError("at most 256 entries, and equal parts")
    b = b_had = min(own.near, max(1, len(book[0]) - 1))
    moves, state, story = None, None, []
    for i in range(own.rounds + 1):
        before = state
        state = _round(rows if state is None else state.where("sums IS NULL"), book, moves, b_had, b)
        if before is not None:
            remove(spark, before.inputFiles()[0].rsplit("/", 1)[0])
        found = _summed(state, book.size + book.shape[0] * book.shape[1] + 258)
        sums, rest = found[: book.size].reshape(book.shape), found[book.size :]
        counts, depths = rest[: -258].reshape(book.shape[:2]), rest[-258:]
        story.append({"near": b, "depths": depths[: b_had + 2].tolist()})
        if i < own.rounds:
            after = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], book)
            moves = np.sqrt(((after - book).astype(np.float64) ** 2).sum(2)) * (1 + ROOM)
            b_had, b, book = b, _next_near(depths, b, own), after
    return state, book, story


def codes_of(state: DataFrame, book: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every row of a state."""
    parts, _, d = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                x = matrix(batch.column(2)).reshape(n, parts, d)
                code = _flat(batch.column(3), np.uint8, parts, -1)[:, :, 0]
                error = ((x - book[np.arange(parts), code]) ** 2).sum((1, 2))
                text = [c.tobytes().hex() for c in code]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text), pa.array(error)], ["id", "label", "code", "error"])

    return state.where("sums IS NULL").select("id", "label", "v", "near").mapInArrow(run, "id bigint, label bigint, code string, error bigint")


def compress(
    vectors: DataFrame, own: Codes | None = None, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row."""
    own = own or Codes()
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), whole(F.col(vector), own.scale).alias("v")
    )
    largest = F.max(F.array_max(F.transform("v", F.abs)))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), largest.alias("largest")).collect()
    if not sizes:
        return spark.createDataFrame([], f"{vec_id} bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    _, _, dim, most = max((r["n"], -r["dim"], r["dim"], r["largest"]) for r in sizes)
    if most**2 * (dim // own.parts) >= 1 << 53:
        raise ValueError(f"component {most} is too large for distances of 64 bits")
    with scratch(spark):
        state, book, _ = train(rows.where(F.size("v") == dim), own, dim)
        coded = settle(codes_of(state, book), lasting=True)
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(vec_id), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
