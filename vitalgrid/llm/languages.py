"""Language identification with language-bitmask n-gram filters.

A Bloom filter is sliced by language: each of its places holds one bit a
language. Every four-byte n-gram that enough documents of a language have sets
the language's bit at a few hashed places; the AND of an n-gram's places then
names all languages that have it. A text's n-grams are counted per language,
each count is corrected for the filter's false positives (the language's share
of set bits to the power of the number of places), and the largest decides,
ties by name. The score is the corrected share of the text's n-grams.

Document counts of n-grams are exact sums over all learned documents, made per
task first. Only the filter comes to the driver: its size is a parameter.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing could be learned. A null id counts as an empty text
where folds are dealt out. Repeated rows count and are judged each; columns
other than the named ones are not read and cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Everything in ASCII but small letters becomes a space.
FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
BLANK = np.uint32(0x20202020)
WORD_BITS = 63


@dataclass(frozen=True)
class Settings:
    #: An n-gram belongs to a language that has it in this share of its documents, two at least.
    least_share: float = 0.005
    #: Places of the filter (a power of two) and places an n-gram takes.
    places: int = 1 << 19
    hashes: int = 3
    #: n-grams a task gathers before it sums them.
    gathered: int = 2_000_000


@dataclass(frozen=True)
class Filter:
    languages: list[str]
    #: One row of 63 language bits for each started 63 languages.
    masks: np.ndarray
    hashes: int

    def false_positives(self) -> np.ndarray:
        places = self.masks.shape[1]
        return np.array([((self.masks[i // WORD_BITS] >> (i % WORD_BITS)) & 1).sum() / places for i in range(len(self.languages))]) ** self.hashes


def grams(text: str) -> np.ndarray:
    """All windows of four bytes of the folded text that hold a letter."""
    folded = b" " + text.lower().encode().translate(FOLD) + b"  "
    raw = np.frombuffer(folded, np.uint8).astype(np.uint32)
    if len(raw) < 4:
        return np.empty(0, np.uint32)
    made = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    return made[made != BLANK]


def places_of(gram: np.ndarray, hashes: int, places: int) -> list[np.ndarray]:
    x = gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    step = (x >> np.uint64(20)) | np.uint64(1)
    return [((x + np.uint64(i) * step) & np.uint64(places - 1)).astype(np.int64) for i in range(hashes)]


def gram_counts(docs: DataFrame, text: str, lang: str, settings: Settings) -> DataFrame:
    """(lang, gram, docs): how many documents of a language hold an n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        total = 0

        def summed():
            for code, parts in held.items():
                keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([code] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts)], ["lang", "gram", "docs"]
                )
            held.clear()

        for batch in batches:
            for code, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.unique(grams(body.as_py()))
                held.setdefault(code, []).append((own, np.ones(len(own))))
                total += len(own)
                if total >= settings.gathered:
                    yield from summed()
                    total = 0
        yield from summed()

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    made = known.mapInArrow(run, "lang string, gram bigint, docs bigint")
    return made.groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))


def learn(docs: DataFrame, settings: Settings | None = None, text: str = "text", lang: str = "lang") -> Filter:
    """The filter of all documents with a known language."""
    settings = settings or Settings()
    totals = {
        r["lang"]: r["n"]
        for r in docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()
    }
    languages = sorted(totals)
    words = -(-max(1, len(languages)) // WORD_BITS)
    masks = np.zeros((words, settings.places), np.int64)
    if languages:
        number = {code: i for i, code in enumerate(languages)}
        least = {code: max(2, int(np.ceil(settings.least_share * n))) if n > 1 else 1 for code, n in totals.items()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes, gram, n = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
                kept = n >= np.array([least[c] for c in codes], np.int64)
                index = np.array([number[c] for c in codes], np.int64)[kept]
                for place in places_of(gram[kept].astype(np.uint32), settings.hashes, settings.places):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place), pa.array(index // WORD_BITS), pa.array(np.int64(1) << (index % WORD_BITS))], ["place", "word", "bits"]
                    )

        bits = gram_counts(docs, text, lang, settings).mapInArrow(run, "place bigint, word bigint, bits bigint")
        # at most one row for each place of the filter and 63 languages
        for r in bits.groupBy("place", "word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
            masks[r["word"], r["place"]] = r["bits"]
    return Filter(languages, masks, settings.hashes)


def identify(docs: DataFrame, known: Filter, text: str = "text", *, predicted: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the predicted language and its score. No shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((known.languages, known.masks, known.false_positives(), known.hashes))

    def judge(body: str | None) -> tuple[str, float]:
        languages, masks, wrong, hashes = shared.value
        if not body or not languages or not LETTER.search(body):
            return UNKNOWN, 0.0
        own = grams(body)
        at = places_of(own, hashes, masks.shape[1])
        hits = np.empty(len(languages))
        for word in range(masks.shape[0]):
            found = masks[word][at[0]]
            for place in at[1:]:
                found = found & masks[word][place]
            for i in range(word * WORD_BITS, min(len(languages), (word + 1) * WORD_BITS)):
                hits[i] = np.count_nonzero(found & (1 << (i - word * WORD_BITS)))
        clean = np.where(wrong < 1, (hits - len(own) * wrong) / np.maximum(1 - wrong, 1e-9), 0.0)
        best = int(np.argmax(clean))
        return languages[best], float(min(1.0, max(0.0, clean[best] / len(own))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(body.as_py()) for body in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f for f, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["row", "predicted", "score"],
            )

    keep = [c for c in docs.columns if c.lower() not in (predicted.lower(), score.lower())]
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    made = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("predicted", T.StringType()), T.StructField("score", T.DoubleType())]))
    return made.select("row.*", F.col("predicted").alias(predicted), F.col("score").alias(score))
