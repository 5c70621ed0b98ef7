"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections.

A document's set is its distinct word n-grams, as 64-bit hashes. Two sets can
only reach the threshold if their sizes are close, so sizes are cut into bands.
In a band at most D elements may differ; the set is dealt by hash into D + 1 + m
parts, so two linked sets agree in at least m + 1 whole parts, one of which is
not empty for a set with at most m empty parts (sets with more also show their
empty ones). Sets that show an equal part in a band share a tile; all others
cannot be linked and are never compared.

1. Every set with a shared part goes to the tile of the neighbour it shares most
   parts with. Large tiles are cut into blocks, each with the tile's first set.
   In a block, parity bitmaps (one bit toggled per element) bound the overlap
   from above: ``(a + b - differing bits) / 2``; what passes is intersected
   exactly, until all sets of the block are connected or compared. A large set
   has a large bitmap, folded to the smaller set's size for a comparison.
2. Links give components. Parts that are still shared between different
   components are compared over all block pairs by bitmaps. A block in which few
   pairs pass the bound hands these on, to tiles of one set and its partners; a
   block in which many pass becomes a tile of its own, with its components
   carried along. These tiles are solved like the first ones, so only links leave them.

No link is lost: each linked pair shares a part, and is either connected or
compared. Equal sets are one node from the start, so copies cost nothing; no
group is expanded into pairs. Intermediate tables go when the labels are written.

Defined results: a null text, an empty one or one without words has no n-grams
and is linked with nothing; fewer words than an n-gram make one element of all
words. Repeated rows are copies of each other; rows with a null id are linked
like others, and a component of null ids only has a null id. Only the id and
the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.session import scratch, settle

U = np.uint64
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 1
#: Texts are hashed in stretches of about this many bytes.
STRETCH = 1 << 22
#: Bits of the smallest bitmap.
BITS = 1024


@dataclass(frozen=True)
class Join:
    gram: int = 3
    #: Linked if 100 * intersection >= percent * union.
    percent: int = 90
    #: Largest size of a band against its smallest.
    band: float = 1.3
    #: Parts that may stay empty, at least; more where a band's parts are small.
    spare_parts: int = 3
    #: Sets of a block in the first and in the second step.
    block: int = 256
    pair_block: int = 256
    #: Pairs for each of its sets that a block may hand on; with more it becomes a tile.
    pairs_each: int = 16


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(n, BASE, U), np.full(n, inverse, U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _stretches(raw: bytes) -> Iterator[bytes]:
    """The text in pieces that end between words."""
    start = 0
    while start < len(raw):
        end = start + STRETCH
        if end < len(raw):
            rest = np.flatnonzero(SPACES[np.frombuffer(raw, np.uint8, offset=end)])
            end = end + int(rest[0]) if len(rest) else len(raw)
        yield raw[start:end]
        start = end


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, A-Z as a-z."""
    found = []
    for piece in _stretches(text.encode().lower()):
        raw = np.frombuffer(piece, np.uint8)
        gap = SPACES[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        up, down = _powers(1 << max(16, int(len(raw)).bit_length()))
        total = np.concatenate([np.zeros(1, U), np.cumsum(_letters()[raw] * up[: len(raw)], dtype=U)])
        found.append(mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93)))
    return np.concatenate(found) if found else np.empty(0, U)


def shingles(text: str | None, gram: int) -> np.ndarray:
    """The distinct n-grams of a text, sorted."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    n = min(gram, len(words))
    size = len(words) - n + 1
    made = np.full(size, n * 0x632BE59BD9B4E019 & (1 << 64) - 1, U)
    for i in range(n):
        made = mix(made + words[i : i + size] * U(2 * i + 3))
    return np.unique(made)


def node_of(own: np.ndarray) -> int:
    """One number for a set."""
    x = np.add.reduce(mix(own ^ U(0xA0761D6478BD642F)), dtype=U, keepdims=True) + np.array([len(own)], U) * U(0xE7037ED1A0B428DB)
    return int(mix(x).view(np.int64)[0])


def _spare(low: int, differ: int, least: int) -> int:
    """How many parts to spare, so that sets of ``low`` elements hardly ever have more empty ones.

    Sets with more also show their empty parts, which all sets of the band share.
    """
    spare = least
    while spare < least + 64 + low:
        parts = differ + 1 + spare
        filling = low / parts
        empty = parts * math.exp(-filling)
        if spare >= empty + 4 * math.sqrt(max(0.0, empty * (1 - (1 + filling) * math.exp(-filling)))):
            break
        spare += max(1, spare // 8)
    return spare


@lru_cache(maxsize=4)
def bands(join: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest size of each band, its number of parts (0: only equal sets are linked) and how many of them may be empty."""
    lows, parts, spares, low = [], [], [], 1
    while low < 1 << 40:
        high = max(low, int(low * join.band))
        larger = 100 * high // join.percent
        differ = (100 - join.percent) * (high + larger) // (100 + join.percent)
        lows.append(low)
        spares.append(_spare(low, differ, join.spare_parts) if differ else 0)
        parts.append(differ + 1 + spares[-1] if differ else 0)
        low = high + 1
    return np.array(lows), np.array(parts), np.array(spares)


def part_keys(own: np.ndarray, join: Join) -> np.ndarray:
    """Keys of the parts by which a set can meet linked ones: in its band, and in those of smaller sets."""
    lows, parts, spares = bands(join)
    n = len(own)
    least = -(-join.percent * n // 100)
    first, last = np.searchsorted(lows, [least, n], "right") - 1
    place, value, keys = mix(own ^ U(0x8BB84B93962EACC9)), mix(own ^ U(0x4B33A62ED433D4A3)), []
    for band in range(first, last + 1):
        p = int(parts[band])
        if not p:
            continue
        at = (place % U(p)).astype(np.int64)
        sums = np.zeros(p, U)
        np.add.at(sums, at, value)
        filled = np.bincount(at, minlength=p) > 0
        shown = np.arange(p) if p - filled.sum() > spares[band] else np.flatnonzero(filled)
        keys.append(mix(sums[shown] + mix(shown.astype(U) + U(band << 40))))
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)


def bitmap_size(n: int) -> int:
    """Places for a set of n elements: a power of two, five fourths of n or more, so that unrelated sets differ in too many."""
    return max(BITS, 1 << (5 * n // 4).bit_length())


def bitmap(own: np.ndarray, size: int = BITS) -> np.ndarray:
    """Parity of the elements at each place: two bitmaps differ in no more places than the sets in elements."""
    odd = np.bincount((mix(own ^ U(0x2D358DCCAA6C78A5)) % U(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(U)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def may_differ(n: np.ndarray, m, percent: int) -> np.ndarray:
    """How many elements linked sets of these sizes may differ in."""
    return n + m - 2 * (-(-percent * (n + m) // (100 + percent)))


def row_key(doc_id: str, text: str):
    """Tells rows apart where an id may be null or repeated."""
    return F.xxhash64(F.col(doc_id).cast("string"), F.lit("|"), F.col(text))


def sketch(docs: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    """(id, rk, n, node, keys) of every row, written. A task shows the keys of equal sets once."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, nodes, keys = [], [], []
            for body in batch.column(2):
                own = shingles(body.as_py(), join.gram)
                node = node_of(own) if len(own) else None
                sizes.append(len(own))
                nodes.append(node)
                if node is None or node in seen:
                    keys.append(np.empty(0, np.int64))
                else:
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(node)
                    keys.append(part_keys(own, join))
            ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), lists],
                ["id", "rk", "n", "node", "keys"],
            )

    rows = docs.select(F.col(doc_id).alias("id"), row_key(doc_id, text).alias("rk"), F.col(text).alias("text"))
    return settle(rows.mapInArrow(run, f"id {kind}, rk bigint, n bigint, node bigint, keys array<bigint>"))


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, node, hub): the keys that several nodes show, with the smallest of those nodes."""
    shown = rows.where(F.size("keys") > 0).select(F.explode("keys").alias("key"), "node")
    group = "PARTITION BY key"
    least, most = F.expr(f"min(node) OVER ({group})"), F.expr(f"max(node) OVER ({group})")
    found = shown.select("key", "node", least.alias("hub"), most.alias("top")).where("hub < top")
    return found.groupBy("key", "node").agg(F.first("hub").alias("hub"))


def deal(own: DataFrame, join: Join) -> DataFrame:
    """(node, tile, block) of (node, tile): the tile's nodes in blocks; its hub, which it is named after, goes to all of them."""
    sizes = own.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(join.block)).cast("int").alias("blocks"))
    member = own.where("node <> tile").join(sizes, "tile").select("node", "tile", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    hubs = sizes.select(F.col("tile").alias("node"), "tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    return member.unionByName(hubs)


def tiles(shared: DataFrame, join: Join) -> DataFrame:
    """(node, places): the tiles and blocks a node goes to."""
    votes = shared.groupBy("node", "hub").count()
    own = votes.groupBy("node").agg(F.max(F.struct("count", "hub"))["hub"].alias("tile"))
    return deal(own, join).groupBy("node").agg(F.collect_list(F.struct("tile", "block")).alias("places"))


def fetch_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    """(node, places, n, elements, bits) of the wanted nodes, each read from one of its rows, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out = []
            for node, body in zip(batch.column(0).to_pylist(), batch.column(2)):
                again = node in seen
                seen.add(node)
                own = shingles(None if again else body.as_py(), join.gram)
                right = len(own) > 0 and node_of(own) == node
                out.append((len(own), own.tobytes() if right else None, bitmap(own, bitmap_size(len(own))).tobytes() if right else None))
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["node", "places", "n", "elements", "bits"])

    first = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("rk").alias("rk"))
    want = first.join(wanted, "node")
    texts = docs.select(row_key(doc_id, text).alias("rk"), F.col(text).alias("text"))
    places = "places array<struct<tile:bigint,block:int>>"
    made = texts.join(want, "rk").select("node", "places", "text").mapInArrow(run, f"node bigint, {places}, n bigint, elements binary, bits binary")
    return settle(made.where("elements IS NOT NULL"))


def few_files(found: DataFrame) -> DataFrame:
    """For rows that are few beside those they were found in: the groups are worked through one after another by four tasks a core."""
    return found.coalesce(4 * found.sparkSession.sparkContext.defaultParallelism)


def _root(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def _folded(raw: list[bytes]) -> dict[int, tuple[int, np.ndarray]]:
    """By the bytes of a bitmap: which is the first of that size, and it and all after it folded to that size.

    The bitmaps are in the order of their sizes. Folding adds up places that agree modulo the smaller
    size, so folded bitmaps are those that the smaller size would have given.
    """
    sizes = np.array([len(x) for x in raw])
    kinds, firsts = np.unique(sizes, return_index=True)
    maps = [np.frombuffer(b"".join(raw[a:b]), U).reshape(b - a, -1) for a, b in zip(firsts, [*firsts[1:], len(raw)])]
    found = {}
    for k, (size, first) in enumerate(zip(kinds.tolist(), firsts.tolist())):
        found[size] = first, np.concatenate([np.bitwise_xor.reduce(m.reshape(len(m), -1, size // 8), axis=1) for m in maps[k:]])
    return found


def link_tiles(placed: DataFrame, join: Join) -> DataFrame:
    """(a, b): links that connect each block's sets as far as any links do.

    ``placed`` has (tile, block, node, label, n, elements, bits); sets of one label are connected already.
    """

    def run(table: pa.Table) -> pa.Table:
        n = table["n"].to_numpy()
        order = np.argsort(n, kind="stable")
        n, nodes = n[order], table["node"].to_numpy()[order]
        bits, raw = table["bits"].take(order).to_pylist(), table["elements"].to_pylist()
        folded = _folded(bits)
        own = [np.frombuffer(raw[i], U) for i in order]
        known: dict[int, int] = {}
        up, links = [known.setdefault(m, i) if m is not None else i for i, m in enumerate(table["label"].take(order).to_pylist())], []
        ends = np.searchsorted(n, 100 * n // join.percent, "right")
        for i in range(len(n)):
            j = np.arange(i + 1, ends[i])
            first, maps = folded[len(bits[i])]
            differ = np.bitwise_count(maps[i - first] ^ maps[i + 1 - first : ends[i] - first]).sum(axis=1)
            for k in j[differ <= may_differ(n[j], n[i], join.percent)]:
                a, b = _root(up, i), _root(up, int(k))
                if a != b and (nodes[i] == nodes[k] or linked(own[i], own[k], join.percent)):
                    up[b] = a
                    links.append((nodes[i], nodes[k]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return few_files(placed.groupBy("tile", "block").applyInArrow(run, "a bigint, b bigint"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that is reachable, for every node of a written edge.

    A round's rows are few, so that it writes a file a core, or one for a million edges, and not one a shuffle partition.
    """
    files = max(edges.sparkSession.sparkContext.defaultParallelism, edges.count() // 1_000_000 + 1)
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a"))
    links = settle(both.distinct().coalesce(files))
    labels = settle(links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")).coalesce(files))
    while True:
        seen = links.join(labels.withColumnsRenamed({"node": "b", "label": "near"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        after = settle(lower.join(jump, "low", "left").select("node", "label", F.least("low", F.coalesce("far", "low")).alias("next")).coalesce(files))
        changed = not after.where("next <> label").isEmpty()
        labels = after.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def compare(shared: DataFrame, labels: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """(tile, a, b): what may still link different components, by bitmaps, written.

    Without a tile, ``a`` and ``b`` are two nodes that pass the bound. A block
    in which more than ``pairs_each`` pairs a row pass gives its nodes instead,
    with their labels as ``b``, as a tile of its own. So what leaves a block grows
    with its rows and not with their square.
    """
    named = shared.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    groups = named.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"), F.min("node").alias("first"), F.max("node").alias("last"),
        F.bit_xor("node").alias("members"), F.bit_xor(F.xxhash64("node")).alias("mixed_members"),
    )
    # parts with the same members need one look: two members are told by first and last, more by 128 bits besides
    same = ["size", "first", "last", "members", "mixed_members"]
    mixed = groups.where("low < high").groupBy(*same).agg(F.min("key").alias("key"))
    cut = mixed.select("key", F.ceil(F.col("size") / F.lit(join.pair_block)).cast("int").alias("blocks"))
    rows = named.join(cut, "key").join(sets.select("node", "n", "bits"), "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label", "n", "bits", "own")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        n = table["n"].to_numpy()
        order = np.argsort(n, kind="stable")
        n, nodes, label = n[order], table["node"].to_numpy()[order], table["label"].to_numpy()[order]
        side, bits = table["own"].to_numpy()[order], table["bits"].take(order).to_pylist()
        folded = _folded(bits)
        across, ends = key[1].as_py() != key[2].as_py(), np.searchsorted(n, 100 * n // join.percent, "right")
        found, count = [], 0
        for x in range(len(n)):
            y = np.arange(x + 1, ends[x])
            y = y[label[y] != label[x]]
            if across:
                y = y[side[y] != side[x]]
            first, maps = folded[len(bits[x])]
            differ = np.bitwise_count(maps[x - first] ^ maps[y - first]).sum(axis=1).astype(np.int64)
            y = y[differ <= may_differ(n[y], n[x], join.percent)]
            count += len(y)
            if count > join.pairs_each * len(n):
                tile = node_of(np.array([k.as_py() for k in key], np.int64).view(U))
                return pa.table({"tile": pa.array(np.full(len(n), tile)), "a": pa.array(nodes), "b": pa.array(label)})
            if len(y):
                found.append(np.stack([np.minimum(nodes[x], nodes[y]), np.maximum(nodes[x], nodes[y])]))
        a, b = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
        return pa.table({"tile": pa.nulls(len(a), pa.int64()), "a": pa.array(a), "b": pa.array(b)})

    return settle(few_files(rows.groupBy("key", "i", "j").applyInArrow(run, "tile bigint, a bigint, b bigint")))


def node_labels(docs: DataFrame, rows: DataFrame, shared: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    """(node, label) of every node that is linked with another, written to last."""
    sets = fetch_sets(docs, rows, tiles(shared, join), join, doc_id, text)
    placed = sets.select("node", "n", "elements", "bits", F.lit(None).cast("long").alias("label"), F.explode("places").alias("p"))
    edges = settle(link_tiles(placed.select("p.tile", "p.block", "node", "label", "n", "elements", "bits"), join))
    left = compare(shared, components(edges), sets, join)
    pairs = left.where("tile IS NULL").select(F.col("b").alias("node"), F.col("a").alias("tile")).distinct()
    partners = deal(pairs, join).select("tile", "block", "node", F.lit(None).cast("long").alias("label"))
    crowded = left.where("tile IS NOT NULL").select("tile", F.lit(0).alias("block"), F.col("a").alias("node"), F.col("b").alias("label"))
    placed = partners.unionByName(crowded).join(sets.drop("places"), "node")
    edges = edges.unionByName(settle(link_tiles(placed, join)))
    return settle(components(edges), lasting=True)


def linked_nodes(docs: DataFrame, join: Join, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, rk, n, node), and of every node its ``label`` with the id and rk that stand for it."""
    with scratch(docs.sparkSession) as folder:
        with scratch(docs.sparkSession):  # all keys are needed only until the shared ones are known
            keyed = sketch(docs, join, doc_id, text)
            shared = settle(shared_keys(keyed), home=folder)
            rows = settle(keyed.select("id", "rk", "n", "node"), lasting=True)
        labels = node_labels(docs, rows, shared, join, doc_id, text)
    # the first row of each node before the join, so that a node of many copies is one row there
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "rk")).alias("first")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(first).join(labels, "node", "left")
    return rows, nodes.select("node", F.coalesce("label", "node").alias("label"), "first")


def link(docs: DataFrame, join: Join | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: the id, rk (see ``row_key``), n_shingles, component_id and ``label`` (null without n-grams)."""
    rows, nodes = linked_nodes(docs, join or Join(), doc_id, text)
    least = nodes.groupBy("label").agg(F.min("first.id").alias("least"))
    named = nodes.join(least, "label").select("node", "label", "least")
    return rows.join(named, "node", "left").select(
        F.col("id").alias(doc_id), "rk", F.col("n").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"), "label",
    )


def deduplicate(docs: DataFrame, join: Join | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each component: that of the smallest id. Rows without n-grams stay."""
    rows, nodes = linked_nodes(docs, join or Join(), doc_id, text)
    one = nodes.groupBy("label").agg(F.min("first")["rk"].alias("_rk")).select("_rk", F.lit(False).alias("_all"))
    bare = rows.where("node IS NULL").select(F.col("rk").alias("_rk"), F.lit(True).alias("_all"))
    keep = one.union(bare).groupBy("_rk").agg(F.max("_all").alias("_all"))
    rows = docs.select(F.struct("*").alias("_row"), row_key(doc_id, text).alias("_rk")).join(keep, "_rk")
    rows = rows.withColumn("_n", F.expr("row_number() OVER (PARTITION BY _rk ORDER BY _rk)"))
    return rows.where("_all OR _n = 1").select("_row.*")
