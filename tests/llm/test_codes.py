"""Vector codes against plain rounds that compare every part with every entry."""

import hashlib
import math

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from vitalgrid.llm import codes
from vitalgrid.llm.codes import Codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _label int"


def brute(rows, own):
    """(vec_id, code, error, label_error) of usable rows and the digest."""
    kept = [(i, lab, [math.floor(own.scale * x) for x in v]) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    dims = {}
    for r in kept:
        dims[len(r[2])] = dims.get(len(r[2]), 0) + 1
    dim = max(dims, key=lambda d: (dims[d], -d))
    kept = sorted((r for r in kept if len(r[2]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    d = dim // own.parts
    cut = lambda v: [v[p * d : (p + 1) * d] for p in range(own.parts)]
    data = [cut(r[2]) for r in kept]
    book = [[x[p] for x in data[: own.entries]] for p in range(own.parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(own.rounds + 1):
        near = [[min(range(len(book[p])), key=lambda k: (far(x[p], book[p][k]), k)) for p in range(own.parts)] for x in data]
        if turn < own.rounds:
            for p in range(own.parts):
                for k in range(len(book[p])):
                    mine = [x[p] for x, a in zip(data, near) if a[p] == k]
                    if mine:
                        book[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    errors = [sum(far(x[p], book[p][a[p]]) for p in range(own.parts)) for x, a in zip(data, near)]
    totals = {}
    for (_, lab, _), e in zip(kept, errors):
        totals[lab] = totals.get(lab, 0) + e
    text = ",".join(str(c) for part in book for entry in part for c in entry)
    rows = [(r[0], "".join(f"{k:02x}" for k in a), e, totals[r[1]]) for r, a, e in zip(kept, near, errors)]
    return sorted(rows, key=str), hashlib.sha256(text.encode()).hexdigest()


def made(spark, rows, own, parts=3):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(parts)
    out = codes.compress(df, own).collect()
    assert len({r["codebooks_sha256"] for r in out}) <= 1
    got = sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in out), key=str)
    return got, out[0]["codebooks_sha256"] if out else None


@pytest.mark.parametrize("near", [1, 2, 4])
def test_equals_plain_rounds(spark, near):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 8))
    rows = [(i, [float(x) for x in centres[i % 9] + rng.normal(scale=0.2, size=8)], i % 3 if i % 7 else None) for i in range(300)]
    rows += [(i, rows[i][1], 1) for i in range(0, 300, 5)]  # repeated ids and vectors
    rows += [(None, rows[3][1], None), (500, None, 1), (501, [], 1), (502, [1.0] * 7 + [float("nan")], 1), (503, [None] * 8, 1), (504, [1.0] * 4, 1)]
    own = Codes(parts=4, entries=6, near=near, scale=64.0)
    assert made(spark, rows, own) == brute(rows, own)


def test_ties_and_unused_entries(spark):
    # few distinct small vectors: many equal distances, equal entries that stay unused
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 4)], 0) for i in range(120)]
    own = Codes(parts=2, entries=10, scale=1.0)
    assert made(spark, rows, own) == brute(rows, own)
    same = [(i, [0.5, 0.25, -0.5, 1.0], None) for i in range(40)]
    assert made(spark, same, own) == brute(same, own)


def test_few_rows_and_none(spark):
    own = Codes(parts=2)
    for n in (1, 2, 5):
        rows = [(i, [float(i), 1.0, -float(i), 2.0], i) for i in range(n)]
        assert made(spark, rows, own) == brute(rows, own)
    assert made(spark, [], own) == ([], None)
    assert made(spark, [(1, None, 1)], own) == ([], None)


def test_too_large_is_said(spark):
    with pytest.raises(ValueError, match="too large"):
        made(spark, [(1, [1e9] * 8, 1)], Codes())


def test_bounds_spare_distances_and_shrink(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").withColumn("v", codes.whole(F.col("embedding"), 4096.0))
    rows = vectors.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), "v")
    _, _, story = codes.train(rows, Codes(), 64)
    assert len(story) == 7
    spared = [s["depths"][0] / sum(s["depths"]) for s in story[1:]]
    assert spared[-1] > 0.5 and spared[-1] > spared[0]
    assert story[-1]["near"] <= story[0]["near"]
