"""Hard negatives: candidate blocks along a Hilbert curve, with zone maps.

For each anchor and each of its positives (the best rows of the anchor's label)
a window of scores is searched among the rows of other labels.

1. Rows are range-sorted by label and by their place on a Hilbert curve through
   the components of largest variance, and written as Parquet blocks: one row a
   block, all of one label, with the least and largest value of each component
   (its zone map) in columns of their own, so choosing blocks reads no vectors.
2. Positives. An anchor's own block gives a score that its k-th positive surely
   reaches. Interval arithmetic over a zone map bounds an anchor's scores with
   all rows of a block; blocks of its label are read where the upper bound gets
   to that score.
3. Negatives. One promising block of each page of zone maps is read first and
   gives each window a score that its last place surely reaches. Then all blocks
   of other labels are read whose interval meets a window above that score.

Anchors are packed in tiles and zone maps in pages; each tile meets each page
once (a stated set of queries against all rows, in blocks), and what comes out
are the chosen blocks with their anchors, joined with the block rows. A task's
unit is one block against one tile, whatever label or vector is frequent; places
on the curve with equal vectors are cut by id. All products are whole numbers.

Defined results: rows with a null id or label, and vectors that are null, empty,
or hold null or non-finite components take no part, nor do those of another
dimension than the most common one. Rows with the anchor's id are its own:
neither positives nor negatives. A repeated anchor row asks once; repeated other
rows count each. Ties go to the smaller id. Windows of negative positives are
empty. Without rows there are no results. Only id, vector and label are read,
so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm.topk import matrix, usable, whole
from vitalgrid.session import scratch, settle

LOWEST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 10
    #: A negative's score in percent of the positive's, at least and at most.
    least: int = 30
    most: int = 90
    scale: float = 256.0
    #: Rows of a block, anchors of a tile, zone maps of a page.
    block: int = 1024
    tile: int = 128
    page: int = 64
    #: Components that the curve runs through, and bits of each.
    curve_dims: int = 8
    curve_bits: int = 7


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (n, dims) on the Hilbert curve; dims * bits is at most 63."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> level) & 1, turn ^ ((1 << level) - 1), turn)
    place = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            place = (place << 1) | (((axis ^ turn) >> level) & 1)
    return place


def interval(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible scores of anchors (a, d) with any row between ``low`` and ``high`` (z, d): both (a, z)."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


@dataclass(frozen=True)
class _Kind:
    """How vectors are stored and multiplied: exact for the largest component there is."""

    dim: int
    stored: str
    exact: str

    def rows(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.stored).reshape(-1, self.dim).astype(self.exact)


def _summary(rows: DataFrame, dim: int) -> np.ndarray:
    """Least, largest, sum and sum of squares of each component: (4, dim)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0)).astype(np.float64)
                found = [x.min(0), x.max(0), x.sum(0), (x**2).sum(0)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), *map(pa.array, found)], ["at", "a", "b", "s", "q"])

    out = np.zeros((4, dim))
    made = rows.select("v").mapInArrow(run, "at bigint, a double, b double, s double, q double")
    for r in made.groupBy("at").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect():
        out[:, r["at"]] = r["a"], r["b"], r["s"], r["q"]
    return out


def _first_number() -> int:
    """Numbers that only this task gives out; a repeated task gives the same."""
    return TaskContext.get().partitionId() << 36


def blocks(rows: DataFrame, own: Mining, kind: _Kind, facts: np.ndarray, n: int) -> DataFrame:
    """Rows (id, label, asks, v) as written blocks in curve order, one row a block.

    ``ids`` are ascending; ``asks`` marks anchors, of equal rows the first.
    """
    least, most = facts[0], facts[1]
    spread = facts[3] / n - (facts[2] / n) ** 2
    axes = np.argsort(-spread, kind="stable")[: own.curve_dims]
    steps = (1 << own.curve_bits) / np.maximum(most[axes] - least[axes] + 1, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(3))
                cells = np.clip((x[:, axes] - least[axes]) * steps, 0, (1 << own.curve_bits) - 1)
                raw = [r.tobytes() for r in x.astype(kind.stored)]
                columns = [*batch.columns[:3], pa.array(hilbert(cells, own.curve_bits)), pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "asks", "h", "v"])

    schema = pa.schema(
        [("block", pa.int64()), ("label", pa.int64()), ("n", pa.int32()), ("low", pa.binary()), ("high", pa.binary()),
         ("ids", pa.binary()), ("asks", pa.binary()), ("vs", pa.binary())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before = _first_number(), None
        held: list[tuple] = []

        def made() -> pa.RecordBatch:
            nonlocal number
            held.sort(key=lambda r: r[0])
            raw = b"".join(r[3] for r in held)
            x = np.frombuffer(raw, kind.stored).reshape(-1, kind.dim)
            ids, asks = np.array([r[0] for r in held], np.int64), np.array([r[2] for r in held], bool)
            row = [number, held[0][1], len(held), x.min(0).tobytes(), x.max(0).tobytes(), ids.tobytes(), asks.tobytes(), raw]
            number += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, schema.types)], schema=schema)

        for batch in batches:
            for i, label, asks, v in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (len(held) >= own.block or held[0][1] != label):
                    yield made()
                row = (i, label, v)
                held.append((i, label, asks and row != before, v))
                before = row
        if held:
            yield made()

    order = ["label", "h", "id"]
    placed = rows.select("id", "label", "asks", "v").mapInArrow(place, "id bigint, label bigint, asks boolean, h bigint, v binary")
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order, "v").select("id", "label", "asks", "v")
    ddl = "block bigint, label bigint, n int, low binary, high binary, ids binary, asks binary, vs binary"
    return settle(ranged.mapInArrow(pack, ddl))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores; ``ids`` ascend, so ties go to the smaller one."""
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return at[np.argsort(-scores[at], kind="stable")][:k]
    return np.argsort(-scores, kind="stable")[:k]


def anchors_of(stored: DataFrame, own: Mining, kind: _Kind) -> DataFrame:
    """(akey, id, label, v, reach): anchors in curve order, with a score their last positive reaches within their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _first_number()
        for batch in batches:
            out = []
            for label, ids, asks, vs in zip(*[c.to_pylist() for c in batch.columns]):
                ids, at, x = np.frombuffer(ids, np.int64), np.flatnonzero(np.frombuffer(asks, bool)), kind.rows(vs)
                scores = x[at] @ x.T
                for a, s in zip(at, scores):
                    others = s[ids != ids[a]]
                    k = own.positives
                    reach = int(np.partition(others, len(others) - k)[len(others) - k]) if len(others) >= k else LOWEST
                    out.append((number, int(ids[a]), label, x[a].astype(kind.stored).tobytes(), reach))
                    number += 1
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, ["akey", "id", "label", "v", "reach"])

    wanted = stored.select("label", "ids", "asks", "vs")
    return settle(wanted.mapInArrow(run, "akey bigint, id bigint, label bigint, v binary, reach bigint"))


def pages(stored: DataFrame, own: Mining) -> tuple[DataFrame, int]:
    """Zone maps packed in pages (shard, blocks, zone_labels, low, high), and the number of shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def made() -> pa.RecordBatch:
            number, label, low, high = zip(*held)
            held.clear()
            row = [np.array(number, np.int64).tobytes(), np.array(label, np.int64).tobytes(), b"".join(low), b"".join(high)]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in row], ["blocks", "zone_labels", "low", "high"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                held.append(row)
                if len(held) >= own.page:
                    yield made()
        if held:
            yield made()

    made = settle(stored.select("block", "label", "low", "high").mapInArrow(run, "blocks binary, zone_labels binary, low binary, high binary"))
    shards = max(1, made.count())
    return made.withColumn("shard", F.pmod(F.xxhash64("blocks"), F.lit(shards))), shards


def tiles(anchors: DataFrame, own: Mining) -> DataFrame:
    """Anchors packed in tiles (akeys, ids, labels, vs, marks); ``marks`` is the anchor's array of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, own.tile):
                part = batch.slice(start, own.tile)
                numbers = [part.column(i).to_numpy().tobytes() for i in range(3)]
                vs, marks = b"".join(part.column(3).to_pylist()), part.column(4).flatten().to_numpy().tobytes()
                columns = [pa.array([c], pa.binary()) for c in (*numbers, vs, marks)]
                yield pa.RecordBatch.from_arrays(columns, ["akeys", "ids", "labels", "vs", "marks"])

    wanted = anchors.select("akey", "id", "label", "v", "marks")
    return wanted.mapInArrow(run, "akeys binary, ids binary, labels binary, vs binary, marks binary")


Choice = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
Solver = Callable[[np.ndarray, int, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def chosen(tiled: DataFrame, paged: DataFrame, shards: int, kind: _Kind, choose: Choice) -> DataFrame:
    """(block, akeys, ids, vs, marks): for each tile the blocks that some of its anchors must read, with these anchors.

    ``choose(same label, least scores, largest scores, marks)`` gives the pairs as a matrix (anchors, blocks).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for akeys, ids, labels, vs, marks, numbers, zone_labels, low, high in zip(*[c.to_pylist() for c in batch.columns]):
                akeys, ids, labels, numbers, zone_labels = (np.frombuffer(c, np.int64) for c in (akeys, ids, labels, numbers, zone_labels))
                x, marks = kind.rows(vs), np.frombuffer(marks, np.int64).reshape(len(ids), -1)
                least, most = interval(x, kind.rows(low), kind.rows(high))
                wanted = choose(labels[:, None] == zone_labels, least, most, marks)
                stored, out = x.astype(kind.stored), []
                for z in np.flatnonzero(wanted.any(axis=0)):
                    at = np.flatnonzero(wanted[:, z])
                    out.append((int(numbers[z]), akeys[at].tobytes(), ids[at].tobytes(), stored[at].tobytes(), marks[at].tobytes()))
                columns = [pa.array([r[i] for r in out], pa.binary() if i else pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "akeys", "ids", "vs", "marks"])

    asking = tiled.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    pairs = asking.join(paged, "shard").select("akeys", "ids", "labels", "vs", "marks", "blocks", "zone_labels", "low", "high")
    return pairs.mapInArrow(run, "block bigint, akeys binary, ids binary, vs binary, marks binary")


def read_blocks(wanted: DataFrame, stored: DataFrame, kind: _Kind, solve: Solver) -> DataFrame:
    """(akey, anchor_id, win, id, score): what ``solve(scores, own id, row ids, marks)`` keeps of each anchor's scores with a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for akeys, asked, vs, marks, ids, rows in zip(*[c.to_pylist() for c in batch.columns]):
                akeys, asked, ids = (np.frombuffer(c, np.int64) for c in (akeys, asked, ids))
                scores = (kind.rows(vs) @ kind.rows(rows).T).astype(np.int64)
                marks = np.frombuffer(marks, np.int64).reshape(len(asked), -1)
                found: list[list[np.ndarray]] = [[], [], [], [], []]
                for a in range(len(asked)):
                    for win, at in solve(scores[a], int(asked[a]), ids, marks[a]):
                        for out, c in zip(found, (np.full(len(at), akeys[a]), np.full(len(at), asked[a]), np.full(len(at), win), ids[at], scores[a][at])):
                            out.append(c)
                columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in found]
                columns = [pa.array(c.astype(np.int32) if i == 2 else c) for i, c in enumerate(columns)]
                yield pa.RecordBatch.from_arrays(columns, ["akey", "anchor_id", "win", "id", "score"])

    block = stored.select("block", F.col("ids").alias("row_ids"), F.col("vs").alias("row_vs"))
    both = wanted.join(block, "block").select("akeys", "ids", "vs", "marks", "row_ids", "row_vs")
    return both.mapInArrow(run, "akey bigint, anchor_id bigint, win int, id bigint, score bigint")


def _hundredth(x: Column) -> Column:
    """A hundredth of a whole number, rounded down."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each anchor's window, with their ``rank``."""
    rank = F.row_number().over(Window.partitionBy("akey", "win").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _near(same: np.ndarray, least: np.ndarray, most: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Blocks that may hold one of the best rows of the label."""
    return same & (most >= marks[:, :1])


def _windows(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest scores (anchors, windows); the lowest is the floor that was found so far."""
    half = marks.shape[1] // 2
    return marks[:, :half], marks[:, half:]


def _probe(same: np.ndarray, least: np.ndarray, most: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Of the page, the block of another label whose interval lies most within the windows."""
    low, high = _windows(marks)
    any_window = low <= high
    bottom = np.where(any_window, low, np.iinfo(np.int64).max).min(1)[:, None]
    top = np.where(any_window, high, LOWEST).max(1)[:, None]
    inside = np.minimum(most, top) - np.maximum(least, bottom)
    share = np.where(same | (inside < 0), -1.0, inside / np.maximum(most - least, 1))
    out = np.zeros(same.shape, bool)
    best = share.argmax(1)
    out[np.arange(len(best)), best] = share[np.arange(len(best)), best] >= 0
    return out


def _meeting(same: np.ndarray, least: np.ndarray, most: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Blocks of other labels whose interval meets a window above its floor."""
    low, high = _windows(marks)
    out = np.zeros(same.shape, bool)
    for i in range(low.shape[1]):
        out |= (low[:, i] <= high[:, i])[:, None] & (most >= low[:, i : i + 1]) & (least <= high[:, i : i + 1])
    return out & ~same


def _label_best(own: Mining) -> Solver:
    def solve(scores: np.ndarray, asked: int, ids: np.ndarray, marks: np.ndarray):
        at = np.flatnonzero((ids != asked) & (scores >= marks[0]))
        yield 0, at[_best(scores[at], ids[at], own.positives)]

    return solve


def _window_best(own: Mining) -> Solver:
    def solve(scores: np.ndarray, asked: int, ids: np.ndarray, marks: np.ndarray):
        low, high = _windows(marks[None, :])
        low, high = low[0], high[0]
        at = np.flatnonzero((scores >= low.min()) & (scores <= high.max()) & (ids != asked))
        at = at[np.argsort(-scores[at], kind="stable")]
        falling = -scores[at]
        for i in range(len(low)):
            first = np.searchsorted(falling, -high[i], "left")
            last = np.searchsorted(falling, -low[i], "right")
            if first < last:
                yield i + 1, at[first : min(last, first + own.negatives)]

    return solve


def mine(
    vectors: DataFrame, is_anchor: Column, own: Mining | None = None,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every row that ``is_anchor``."""
    own = own or Mining()
    spark = vectors.sparkSession
    ddl = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), is_anchor.alias("asks"),
        whole(F.col(vector), own.scale).alias("v"),
    )
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()
    if not sizes:
        return spark.createDataFrame([], ddl)
    n, _, dim = max((r["n"], -r["dim"], r["dim"]) for r in sizes)
    rows = rows.where(F.size("v") == dim)
    with scratch(spark):
        facts = _summary(rows, dim)
        largest = int(np.abs(facts[:2]).max())
        stored_kind = "int16" if largest < 1 << 15 else "int32" if largest < 1 << 31 else "int64"
        kind = _Kind(dim, stored_kind, "float64" if largest**2 * dim < 1 << 53 else "int64")
        stored = blocks(rows, own, kind, facts, n)
        paged, shards = pages(stored, own)
        anchors = anchors_of(stored, own, kind)

        asking = tiles(anchors.withColumn("marks", F.array("reach")), own)
        near = read_blocks(chosen(asking, paged, shards, kind, _near), stored, kind, _label_best(own))
        positives = settle(_first(near, own.positives), lasting=True)

        # at most ``positives`` windows an anchor, in the order of their ranks
        low, high = -_hundredth(-F.col("score") * own.least), _hundredth(F.col("score") * own.most)
        wins = positives.select("akey", F.col("rank").alias("win"), low.alias("low"), high.alias("high"))
        anchors = anchors.select("akey", "id", "label", "v")
        probe = read_blocks(
            chosen(_with_windows(anchors, wins, own), paged, shards, kind, _probe), stored, kind, _window_best(own)
        )
        floors = _first(probe, own.negatives).where(F.col("rank") == own.negatives).select("akey", "win", F.col("score").alias("floor"))
        wins = settle(wins.join(floors, ["akey", "win"], "left").select("akey", "win", F.coalesce("floor", "low").alias("low"), "high"))
        meeting = chosen(_with_windows(anchors, wins, own), paged, shards, kind, _meeting)
        negatives = settle(_first(read_blocks(meeting, stored, kind, _window_best(own)), own.negatives), lasting=True)
    asked = positives.select("akey", F.col("rank").alias("win"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(asked, ["akey", "win"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _with_windows(anchors: DataFrame, wins: DataFrame, own: Mining) -> DataFrame:
    """Tiles of the anchors that have windows, in curve order; a missing window is an empty one (low 1, high 0)."""
    one = F.map_from_entries(F.collect_list(F.struct("win", F.struct("low", "high").alias("w"))))
    per = wins.where("low <= high").groupBy("akey").agg(one.alias("w"))
    each = [F.try_element_at("w", F.lit(i + 1)) for i in range(own.positives)]
    marks = F.array(*[F.coalesce(w["low"], F.lit(1).cast("long")) for w in each], *[F.coalesce(w["high"], F.lit(0).cast("long")) for w in each])
    ready = anchors.join(per, "akey").withColumn("marks", marks)
    return tiles(ready.repartitionByRange("akey").sortWithinPartitions("akey"), own)
