"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A text becomes two dozen statistics. Random Fourier features (cosines of a
seeded projection) approximate a Gaussian kernel over them. Ridge weights come
from normal equations that every task sums over its own rows; only the small
matrices are shuffled and solved. A part of the labelled rows that the weights
have not seen calibrates the raw scores: binned sums, made monotone by pooling
adjacent violators.

Statistics are computed once for every document and written to the shared
folder; the texts themselves are never shuffled.

Defined results: a null or empty text has statistics of zero and is scored like
any other; without labelled rows of the learning folds every score is 0.5; a
document labelled several times counts with the mean; labels of null quality are
left out. A null id is dealt into folds like an empty text and has no label.
Rows keep their id only, so no other input column can clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import doc_crc
from vitalgrid.session import settle

BYTE_CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "beyond": range(128, 256),
    "stop": b".,;:?", "shout": b"!", "mark": b"#*$%&", "bar": b"|<>", "quote": b"\"'()-", "line": b"\n",
}
CLASS_OF = np.zeros((len(BYTE_CLASSES), 256))
for _i, _members in enumerate(BYTE_CLASSES.values()):
    CLASS_OF[_i, list(_members)] = 1
MARKED = re.compile(r"[#*$%&|<>!]$")


@dataclass(frozen=True)
class Settings:
    features: int = 256
    #: Width of the Gaussian kernel over standardised statistics.
    width: float = 4.0
    ridge: float = 1e-3
    seed: int = 17
    #: Fold of the labelled rows that calibrates.
    calibrating: int = 4
    bins: int = 400
    #: Tasks that sum normal equations; each makes one matrix.
    summing_tasks: int = 64


def statistics(text: str | None) -> list[float]:
    """Length, character, word and line statistics of a text."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(1, len(raw))
    classes = CLASS_OF @ np.bincount(raw, minlength=256) / n
    words = text.split()
    m = max(1, len(words))
    counts, pairs = Counter(words), set(pairwise(words))
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    lines = [x for x in text.split("\n") if x]
    k = max(1, len(lines))
    ends = counts.items()
    return [
        *classes,
        math.log1p(len(raw)), math.log1p(len(words)), math.log1p(len(lines)),
        sizes.mean(), sizes.std(), float((sizes <= 3).mean()), min(100.0, sizes.max()),
        len(counts) / m, max(counts.values(), default=0) / m, (len(pairs) + 1) / m, len(set(lines)) / k,
        sum(c for w, c in ends if w.isupper() and len(w) > 1) / m,
        sum(c for w, c in ends if MARKED.search(w)) / m,
        sum(c for w, c in ends if w[:1].isupper()) / m,
    ]


SIZE = len(statistics(""))


def statistics_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(_id, _crc, x): the statistics of every row, in a written table."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["_id", "_crc", "x"])

    crc = doc_crc(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("_id"), crc.alias("_crc"), F.col(text).alias("_text"))
    return settle(rows.mapInArrow(run, f"_id {kind}, _crc bigint, x array<double>"))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    #: Calibrated scores at raw scores, both rising; empty until calibrated.
    raw: np.ndarray
    score: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.turn + self.shift
        return np.hstack([np.cos(z) * math.sqrt(2 / len(self.shift)), np.ones((len(x), 1))])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.predict(x), self.raw, self.score) if len(self.raw) else np.full(len(x), 0.5)


def pool_adjacent(values: list[float], weights: list[float]) -> list[float]:
    """The closest rising sequence."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return [v for v, _, n in blocks for _ in range(n)]


def fit(labelled: DataFrame, settings: Settings) -> Model:
    """Weights from (x, y, fold) rows, calibrated on one fold."""
    train = labelled.where(F.col("fold") != settings.calibrating)
    sums = train.select(*[F.col("x")[i].alias(f"x{i}") for i in range(SIZE)]).agg(
        F.count("*").alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(SIZE)], *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(SIZE)]
    ).first()
    rng = np.random.default_rng(settings.seed)
    turn = rng.normal(0, 1 / settings.width, (SIZE, settings.features))
    shift = rng.uniform(0, 2 * math.pi, settings.features)
    none = np.empty(0)
    if not sums["n"]:
        return Model(np.zeros(SIZE), np.ones(SIZE), turn, shift, np.zeros(settings.features + 1), none, none)
    scale = np.array([sums[f"s{i}"] or 1.0 for i in range(SIZE)])
    start = Model(np.array([sums[f"m{i}"] for i in range(SIZE)]), scale, turn, shift, np.zeros(settings.features + 1), none, none)
    d = settings.features + 1

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d + 1))
        for frame in frames:
            z = start.features(np.stack(frame["x"].to_numpy()))
            total += z.T @ np.hstack([z, frame[["y"]].to_numpy()])
        yield pd.DataFrame({"i": range(d), "row": list(total)})

    def added(key: tuple[int], frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "row": [np.sum(np.stack(frame["row"].to_numpy()), axis=0)]})

    parts = train.select("x", "y").coalesce(settings.summing_tasks).mapInPandas(summed, "i int, row array<double>")
    rows = parts.groupBy("i").applyInPandas(added, "i int, row array<double>").collect()
    total = np.array([r["row"] for r in sorted(rows, key=lambda r: r["i"])])
    left = total[:, :d] + settings.ridge * max(1, sums["n"]) / d * np.eye(d)
    fitted = Model(start.mean, scale, turn, shift, np.linalg.solve(left, total[:, d]), none, none)
    return calibrate(labelled.where(F.col("fold") == settings.calibrating), fitted, settings)


def calibrate(held: DataFrame, model: Model, settings: Settings) -> Model:
    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"raw": model.predict(np.stack(frame["x"].to_numpy())), "y": frame["y"].to_numpy()})

    place = F.floor((F.greatest(F.lit(-0.5), F.least(F.lit(1.5), F.col("raw"))) + 0.5) / 2 * settings.bins)
    bins = (
        held.select("x", "y").mapInPandas(scored, "raw double, y double")
        .groupBy(place.alias("bin")).agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n"))
        .orderBy("bin").collect()
    )
    if not bins:  # too few labels to set some aside: raw scores, cut to 0..1
        return Model(model.mean, model.scale, model.turn, model.shift, model.weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    score = pool_adjacent([b["y"] for b in bins], [b["n"] for b in bins])
    return Model(model.mean, model.scale, model.turn, model.shift, model.weights, np.array([b["raw"] for b in bins]), np.clip(score, 0, 1))


def classify(
    docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5, settings: Settings | None = None,
    doc_id: str = "doc_id", text: str = "text", label: str = "quality",
) -> DataFrame:
    """One row for each row: the id, held_out and score. Labels of the held-out fold are not used."""
    settings = settings or Settings()
    stats = statistics_of(docs, doc_id, text)
    fold = F.pmod("_crc", F.lit(folds))
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.avg(label).alias("y"))
    labelled = settle(stats.where(fold != held_out).join(marks, "_id").select("x", "y", fold.alias("fold")))
    model = fit(labelled, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.calibrated(x))], [doc_id, "held_out", "score"])

    kind = dict(docs.dtypes)[doc_id]
    return stats.select("_id", (fold == held_out).alias("held_out"), "x").mapInArrow(run, f"`{doc_id}` {kind}, held_out boolean, score double")
