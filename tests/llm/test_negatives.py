"""Hard negatives against a search over all rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from vitalgrid.llm import negatives
from vitalgrid.llm.negatives import Mining

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, _label string"


def brute(rows, asks, own):
    kept = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, label, tuple(math.floor(own.scale * x) for x in v)))
    dims = {}
    for r in kept:
        dims[len(r[2])] = dims.get(len(r[2]), 0) + 1
    dim = max(dims, key=lambda d: (dims[d], -d)) if dims else 0
    kept = [r for r in kept if len(r[2]) == dim]
    out = []
    for i, label, v in sorted(set(r for r in kept if asks(r[0]))):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in kept if j != i)
        for s, j, _ in [r for r in scored if r[2] == label][: own.positives]:
            fits = [r for r in scored if r[2] != label and own.least * -s <= 100 * -r[0] <= own.most * -s]
            out += [(i, j, n + 1, r[1], -s, -r[0]) for n, r in enumerate(fits[: own.negatives])]
    return sorted(out)


def made(spark, rows, every, own):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    out = negatives.mine(df, F.col("vec_id") % every == 0, own).collect()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in names) for r in out)


SMALL_UNITS = Mining(block=16, tile=4, page=3)


def test_equals_search_over_all_rows(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 12))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(scale=0.6, size=12)], i % 4) for i in range(400)]
    rows += [(None, rows[1][1], 1), (1000, None, 1), (1010, [], 1), (1020, rows[2][1], None), (1030, [float("inf")] * 12, 1),
             (1040, [None] * 12, 2), (1050, [1.0] * 5, 2)]
    rows += [rows[10], rows[11], rows[11]]  # repeated rows, one of them an anchor
    assert made(spark, rows, 10, SMALL_UNITS) == brute(rows, lambda i: i % 10 == 0, SMALL_UNITS)


def test_ties_copies_and_one_large_label(spark):
    # small whole components: many equal scores; one vector and one label hold most rows
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(0, 3, 4)], int(rng.integers(0, 2)) * int(rng.integers(0, 3))) for i in range(150)]
    rows += [(i, [2.0, 1.0, 1.0, 0.0], 0) for i in range(150, 260)]
    own = Mining(scale=1.0, block=16, tile=4, page=3)
    assert made(spark, rows, 13, own) == brute(rows, lambda i: i % 13 == 0, own)


def test_few_rows_negative_scores_and_none(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [0.5, 0.0], 1), (3, [0.0, 0.0], 1)]
    assert made(spark, rows, 1, SMALL_UNITS) == brute(rows, lambda i: True, SMALL_UNITS)
    assert made(spark, [], 1, SMALL_UNITS) == []
    assert made(spark, [(1, [1.0], None)], 1, SMALL_UNITS) == []
    assert made(spark, [(1, [1.0], 2)], 1, SMALL_UNITS) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=3) * 3e5], i % 2) for i in range(60)]
    assert made(spark, rows, 6, SMALL_UNITS) == brute(rows, lambda i: i % 6 == 0, SMALL_UNITS)


def test_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2), (1, 4), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = negatives.hilbert(grid, bits)
        assert sorted(place) == list(range(len(grid)))
        way = grid[np.argsort(place)]
        assert (np.abs(np.diff(way, axis=0)).sum(1) == 1).all()


def test_zone_maps_bound_scores_and_spare_blocks(spark):
    rng = np.random.default_rng(4)
    x, a = rng.integers(-9, 9, (50, 6)), rng.integers(-9, 9, (7, 6))
    least, most = negatives.interval(a, x.min(0)[None], x.max(0)[None])
    assert (least[:, :1] <= a @ x.T).all() and (a @ x.T <= most[:, :1]).all()

    # clusters far apart: an anchor's windows meet few of the blocks
    centres = rng.normal(size=(20, 4)) * 4
    points = [[float(x) for x in centres[i % 20] + rng.normal(scale=0.05, size=4)] for i in range(2000)]
    df = spark.createDataFrame([(i, i % 20 // 2, i % 40 == 0, [math.floor(256 * x) for x in p]) for i, p in enumerate(points)],
                               "id long, label long, asks boolean, v array<long>")
    own = Mining(block=32)
    kind = negatives._Kind(4, "int16", "float64")
    stored = negatives.blocks(df, own, kind, negatives._summary(df, 4), 2000)
    paged, shards = negatives.pages(stored, own)
    anchors = negatives.anchors_of(stored, own, kind)
    read = negatives.chosen(negatives.tiles(anchors.withColumn("marks", F.array("reach")), own), paged, shards, kind, negatives._near)
    pairs = read.select((F.octet_length("akeys") / 8).alias("n")).agg(F.sum("n")).first()[0]
    assert stored.agg(F.sum("n")).first()[0] == 2000 and anchors.count() == 50
    assert pairs < 0.2 * stored.count() * 50
