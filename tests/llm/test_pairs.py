import math
import random
from collections import defaultdict

import pytest
from odd_documents import none, odd  # noqa: F401
from pyspark.sql import functions as F

from vitalgrid.llm import jaccard, topk


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())


def brute(rows):
    """(n_shingles, smallest reachable id) of each row."""
    sets = [sets_of(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    return [(d, len(sets[i]), d if not sets[i] else min((x for x in least[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def copies(seed, n=60, words=80):
    """Texts, and chains of copies with a few changed words."""
    rnd, rows = random.Random(seed), []
    for _ in range(n // 6):
        text = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(3, words))]
        for _ in range(6):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(rnd.randint(0, max(1, len(text) // 25))):
                text[rnd.randrange(len(text))] = f"x{rnd.randint(0, 99)}"
            if rnd.random() < 0.3:
                text.append("tail")
    return rows


@pytest.mark.parametrize("seed,block,pairs,each", [(1, 256, 512, 16), (2, 2, 2, 0), (3, 1, 3, 1), (4, 1, 256, 0)])
def test_join_against_brute_force(spark, seed, block, pairs, each):
    rows = copies(seed)
    join = jaccard.Join(block=block, pair_block=pairs, pairs_each=each)
    got = jaccard.link(spark.createDataFrame(rows, "doc_id long, text string"), join).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute(rows))


def test_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(202)]
    rows = [(1, " ".join(words))] + [(2 + k, " ".join([*words[: 202 - k], *(f"y{i}" for i in range(k))])) for k in range(1, 16)]
    got = jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute(rows))


def test_linked_sets_share_a_part():
    rnd, join = random.Random(9), jaccard.Join()
    import numpy as np

    for n in (9, 10, 11, 19, 20, 37, 100, 555, 3000):
        for _ in range(20):
            a = np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64))
            most = (len(a) * 10) // 190
            drop, add = rnd.randint(0, most), 0
            b = np.unique(np.concatenate([a[drop:], np.array([rnd.getrandbits(64) for _ in range(add)], np.uint64)]))
            if jaccard.linked(a, b, 90) and len(b) != len(a):
                assert np.intersect1d(jaccard.part_keys(a, join), jaccard.part_keys(b, join)).size
                assert np.bitwise_count(jaccard.bitmap(a) ^ jaccard.bitmap(b)).sum() <= len(np.setxor1d(a, b))


def test_unrelated_sets_share_no_part_at_four_fifths():
    import numpy as np

    rnd, join = np.random.default_rng(3), jaccard.Join(gram=5, percent=80)
    for n in (30, 200, 1000, 5000):
        a, b = (np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(2))
        assert not np.intersect1d(jaccard.part_keys(a, join), jaccard.part_keys(b, join)).size
        near = np.unique(np.concatenate([a[n // 9 :], rnd.integers(0, 1 << 63, n // 9, dtype=np.uint64)]))
        assert jaccard.linked(a, near, 80)
        assert np.intersect1d(jaccard.part_keys(a, join), jaccard.part_keys(near, join)).size


def test_groups_of_equal_short_sums_are_all_compared(spark):
    import numpy as np

    half = F.xxhash64("id").bitwiseAND(F.lit((1 << 31) - 1))
    short = spark.range(600_000).select(half.alias("h")).toPandas()["h"].to_numpy()
    sums = short[::2] + short[1::2]
    order = np.argsort(sums, kind="stable")
    at = order[np.flatnonzero(np.diff(sums[order]) == 0)[0] :][:2]
    pairs = [(int(2 * i), int(2 * i + 1)) for i in at]
    shared = spark.createDataFrame([(k, n) for k, pair in enumerate(pairs) for n in pair], "key long, node long")
    bits = bytes(jaccard.bitmap(np.arange(20, dtype=np.uint64)))
    sets = spark.createDataFrame([(n, 20, bytearray(bits)) for pair in pairs for n in pair], "node long, n long, bits binary")
    labels = spark.createDataFrame([], "node long, label long")
    found = jaccard.compare(shared, labels, sets, jaccard.Join()).where("tile IS NULL").collect()
    assert sorted((r["a"], r["b"]) for r in found) == sorted(pairs)


def test_crowd_of_unlinked_near_copies_gives_few_rows(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
    owned = [np.unique(np.concatenate([base[:176], rng.integers(0, 1 << 62, 22, dtype=np.uint64)])) for _ in range(300)]
    sets = spark.createDataFrame([(i, len(x), bytearray(jaccard.bitmap(x))) for i, x in enumerate(owned)], "node long, n long, bits binary")
    shared = spark.range(300).selectExpr("7L AS key", "id AS node")
    join, labels = jaccard.Join(percent=75, pair_block=100, pairs_each=8), spark.createDataFrame([], "node long, label long")
    found = jaccard.compare(shared, labels, sets, join).collect()
    assert all(r["tile"] is not None for r in found) and len(found) <= 3 * 3 * 2 * 300
    assert {r["a"] for r in found} == set(range(300))


def test_large_texts_with_a_common_passage_are_told_apart_by_bitmaps(spark):
    rnd, join = random.Random(12), jaccard.Join(gram=5, percent=80)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [(i, passage + " " + " ".join(f"w{rnd.getrandbits(40)}" for _ in range(rnd.randint(2500, 2700)))) for i in range(12)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = jaccard.sketch(docs, join, "doc_id", "text")
    wanted = rows.select("node", F.array(F.struct(F.col("node").alias("tile"), F.lit(0).alias("block"))).alias("places"))
    sets = jaccard.fetch_sets(docs, rows, wanted, join, "doc_id", "text")
    labels = spark.createDataFrame([], "node long, label long")
    assert sets.count() == 12 and jaccard.compare(rows.selectExpr("7L AS key", "node"), labels, sets, join).count() == 0


@pytest.mark.parametrize("block,each", [(256, 16), (2, 0), (2, 16)])
def test_threshold_is_exact_where_bitmaps_have_two_sizes(spark, block, each):
    words = [f"w{i}" for i in range(850)]
    rows = [(k, " ".join([*words[: 850 - k], *(f"y{i}" for i in range(k % 7))])) for k in range(0, 100, 3)]
    rows += [(1000 + k, " ".join([*words[:k], f"z{k}", *words[k:]])) for k in range(0, 800, 100)]
    got = jaccard.link(spark.createDataFrame(rows, "doc_id long, text string"), jaccard.Join(block=block, pair_block=block, pairs_each=each)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute(rows))


def test_folded_bitmaps_are_those_of_the_smaller_size():
    import numpy as np

    owned = [np.unique(np.random.default_rng(n).integers(0, 1 << 62, n, dtype=np.uint64)) for n in (5, 700, 900, 1500, 2000, 9000)]
    sizes = [jaccard.bitmap_size(len(x)) for x in owned]
    folded = jaccard._folded([jaccard.bitmap(x, size).tobytes() for x, size in zip(owned, sizes)])
    assert sizes == sorted(sizes) and sorted(folded) == sorted({s // 8 for s in sizes})
    for size, (first, maps) in folded.items():
        assert first == sizes.index(8 * size) and len(maps) == len(owned) - first
        assert all((m == jaccard.bitmap(x, 8 * size)).all() for m, x in zip(maps, owned[first:]))


def test_rounds_of_components_write_few_files(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(before, ("40", "false")):
        spark.conf.set(k, v)
    labels = jaccard.components(spark.range(300).selectExpr("id AS a", "id + 1000 AS b"))
    for k, v in before.items():
        spark.conf.set(k, v)
    assert len(labels.inputFiles()) <= spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, labels.collect())) == sorted([(i, i) for i in range(300)] + [(i + 1000, i) for i in range(300)])


def test_join_of_odd_documents(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = jaccard.link(odd).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == sorted(brute(rows), key=key)
    assert jaccard.link(none).count() == 0


def test_one_document_of_each_group_stays(spark, odd):
    rows = copies(4)
    kept = {r["doc_id"] for r in jaccard.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {c for _, _, c in brute(rows)}
    left = jaccard.deduplicate(odd)
    assert left.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 6, None, None, 8, 9, 10]))


def exact(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in ok if i % 50 == 0}:
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block": 2, "shard": 40}, {"block": 3, "shard": 1000, "k": 9}])
def test_search_against_brute_force(spark, options):
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(rnd.choice([-1, 1]), 0.3) for _ in range(8)]) for i in range(600)]
    rows += [(i, rows[50][1]) for i in range(600, 700)] + [(700, None), (750, [float("nan")] * 8), (800, [None] * 8), (850, [float("inf")] * 8), (None, rows[0][1]), (900, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    search = topk.Search(**options)
    got = topk.search(df, F.col("vec_id") % 50 == 0, search).collect()
    assert sorted(map(tuple, got)) == exact(rows, search.k)


def test_bounds_prune(spark):
    import numpy as np

    rnd = np.random.default_rng(1)
    centers = np.eye(4) * 1000
    x = np.repeat(centers, 50, axis=0) + rnd.normal(0, 5, (200, 4))
    radii = np.array([25.0] * 4)
    high, low = topk._bounds(x, centers, radii, 1), topk._bounds(x, centers, radii, -1)
    reached = -np.sort(-low, axis=0)[5]
    assert ((high >= reached).sum(0) == 50).all()


def clustered(clusters=16, each=60, dim=16):
    """Tight groups of vectors far from each other."""
    rnd = random.Random(9)
    return [(i, [2.0 * (j == i % clusters) + rnd.gauss(0, 0.01) for j in range(dim)]) for i in range(clusters * each)]


def test_summaries_leave_cells_of_rows_out(spark):
    import numpy as np

    rows = clustered()
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    data = spark.createDataFrame(whole, "id long, v array<long>").repartition(3)
    pivots = np.array([v for _, v in whole[:16]], float)
    radii, number = topk._query_cells(data.where("id % 50 = 0"), pivots)
    numbers, members = topk._row_cells(data, pivots, 5)
    assert number.sum() == 20 and (number > 0).sum() > 1 and (numbers["n"] == 60).all()
    # of each cell the six ids that score best with its pivot
    score = lambda v, p: sum(a * b for a, b in zip(v, p))
    for c in range(16):
        best = sorted((-score(v, whole[c][1]), i) for i, v in whole if i % 16 == c)[:6]
        assert {i for _, i in best} <= {r["id"] for r in members.collect()}
    assert members.count() == 16 * 6
    needed = topk._needed(pivots, radii, numbers, topk._reached(members, pivots, radii, 5))
    # every cell of queries needs its own cell of rows, and no other reaches its bound
    assert (needed == np.diag(number > 0)).all()
    assert sorted(map(tuple, topk.search(data.select(F.col("id").alias("vec_id"), F.col("v").alias("embedding")), F.col("vec_id") % 50 == 0,
                                         topk.Search(block=3), scale=1.0).collect())) == exact([(i, [x / 256 for x in v]) for i, v in whole], 5)


def test_groups_hold_about_a_block_of_queries():
    import numpy as np

    rnd = np.random.default_rng(3)
    pivots, number = rnd.normal(size=(60, 4)), rnd.integers(0, 9, 60)
    number[7] = 100
    group = topk._groups(pivots, number, 20)
    for g in range(group.max() + 1):
        cells = np.flatnonzero((group == g) & (number > 0))
        assert len(cells) and (number[cells].sum() <= 20 or list(cells) == [7])


@pytest.mark.parametrize("copies", [2, 3, 9])
def test_repeated_query_rows_leave_no_rank_out(spark, monkeypatch, copies):
    import numpy as np

    monkeypatch.setattr(topk, "_pivots", lambda rows, n: np.array([[2560.0, 0.0]]))
    rows = [(0, [10.0, 0.0])] * copies + [(i, [10.0 - i, float(i)]) for i in range(1, 9)] + [(1, [8.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.search(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == exact(rows, 5)


def test_search_few_and_none(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(empty, F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 256 * 11)]
    assert topk.search(two, F.col("vec_id") == 77).count() == 0
