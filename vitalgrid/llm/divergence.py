"""Quality rules by distribution divergence.

A document's character classes and its most common function words are counted
as two histograms. Each is compared with the histograms of every reference
language by the Jensen-Shannon distance (base 2, 0 to 1), and the closest
language counts, so a wrong or missing language label rejects nothing. The
references are sums over all documents of a language.

Defined results: a null or empty text has no words, so it fails the base rule
(too few words); a text shorter than a histogram's minimum is not judged by
that histogram; without any reference (an empty table, no known language)
only the base rule decides. Repeated rows get equal verdicts. Every column of
the input stays; an input column named like an added one is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import let, split_words

#: Common function words of each reference language, matched in lower case only.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las"),
}
#: Character classes, taken out of the text one after the other; the rest is the last class.
CLASSES = ("[a-z]+", r"[\x20\x09-\x0D]+", "[A-Z]+", "[0-9]+", r"[^\x00-\x7F]+", r"""[.,;:!?'"()\-]+""")


@dataclass(frozen=True)
class Rules:
    words: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(FUNCTION_WORDS))
    #: Texts with fewer characters or words than these are not judged by the histogram.
    least_chars: int = 100
    least_words: int = 100
    #: Larger Jensen-Shannon distances reject.
    most_char_distance: float = 0.3
    most_word_distance: float = 0.25
    #: Whether the word bound is widened by the spread of a histogram of so few words.
    widened: bool = False
    #: The base rule.
    base_words: int = 20
    repeat_percent: int = 30
    window: int = 8


def _listed(rules: Rules) -> list[str]:
    return sorted({w for words in rules.words.values() for w in words})


def _class_counts(df: DataFrame, text: str) -> DataFrame:
    """``_classes`` (array of counts), ``_rest`` (text without letters, space, digits) and ``_chars``."""
    df = df.withColumn("_chars", F.length(text)).withColumn("_left0", F.col(text))
    for i, pattern in enumerate(CLASSES):
        df = df.withColumn(f"_left{i + 1}", F.regexp_replace(f"_left{i}", pattern, ""))
    last = len(CLASSES)
    size = [F.length(f"_left{i}") for i in range(last + 1)]
    counts = [size[i] - size[i + 1] for i in range(last)] + [size[last]]
    return df.withColumn("_classes", F.array(*[c.cast("double") for c in counts])).withColumn("_rest", F.col("_left5"))


def references(docs: DataFrame, rules: Rules, text: str = "text", lang: str = "lang") -> dict:
    """Both histograms of each language as shares, over all documents labelled with it."""
    known = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"), F.col(lang).alias("_lang")).where(
        F.col("_lang").isin(*rules.words)
    )
    n = len(CLASSES) + 1
    sums = (
        _class_counts(known, "_text")
        .groupBy("_lang")
        .agg(*[F.sum(F.col("_classes")[i]).alias(f"c{i}") for i in range(n)])
        .collect()
    )
    words = split_words(F.col("_text"))
    listed = F.filter(words, lambda w: w.isin(_listed(rules)))
    spread = known.select("_lang", F.explode(listed).alias("w")).groupBy("_lang", "w").count()
    totals = known.groupBy("_lang").agg(F.sum(F.size(words)).alias("n"))
    found: dict[str, dict] = {}
    counted = {(r["_lang"], r["w"]): r["count"] for r in spread.collect()}
    all_words = {r["_lang"]: r["n"] for r in totals.collect()}
    for r in sums:
        code, chars = r["_lang"], [float(r[f"c{i}"] or 0) for i in range(n)]
        own = [float(counted.get((code, w), 0)) for w in rules.words[code]]
        total = float(all_words.get(code) or 0)
        if sum(chars) and total:
            found[code] = {
                "chars": [c / sum(chars) for c in chars],
                "words": [c / total for c in own] + [(total - sum(own)) / total],
            }
    return found


def distance(counts: Column, total: Column, share: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram of counts to one of shares."""
    zero = F.lit(0.0)

    def term(count: Column, q: Column) -> Column:
        return let(
            count / total,
            lambda p: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(zero)
            + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(zero),
        )

    parts = F.zip_with(counts, F.array(*[F.lit(x) for x in share]), term)
    return F.sqrt(F.greatest(zero, F.aggregate(parts, zero, lambda a, x: a + x) / 2))


def _word_distance(common: Column, n_words: Column, listed: tuple[str, ...], share: list[float]) -> Column:
    """Distance of the listed words, and all others, to a language's shares."""

    def count(word: str) -> Column:
        return F.size(F.filter(common, lambda x: x == word)).cast("double")

    def with_rest(counts: Column) -> Column:
        rest = n_words - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return distance(F.concat(counts, F.array(rest)), n_words.cast("double"), share)

    return let(F.array(*[count(w) for w in listed]), with_rest)


def repeated_words(words: Column, window: int) -> Column:
    """Words inside windows whose words occur twice or more in the text.

    Windows are compared by a 64-bit hash. Only texts with an equal pair sort
    their windows.
    """
    starts = F.when(
        F.size(words) >= window,
        F.transform(F.sequence(F.lit(1), F.size(words) - window + 1), lambda i: F.xxhash64(F.slice(words, i, window))),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(
            ordered,
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                    | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)),
                ),
                lambda e: e["i"],
            ),
        )
        steps = let(
            F.array_sort(again),
            lambda p: F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))),
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(starts, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def word_bound(rules: Rules) -> Column:
    """The largest word distance of a text that stays.

    A sample of n words from a histogram of k + 1 shares has an expected squared
    distance of k / (8 n ln 2) to it; that is added to the square of the bound.
    """
    if not rules.widened:
        return F.lit(rules.most_word_distance)
    listed = max(map(len, rules.words.values()))
    return F.sqrt(rules.most_word_distance**2 + listed / (8 * math.log(2)) / F.greatest(F.col("n_words"), F.lit(1)))


def judge(docs: DataFrame, rules: Rules | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """All rows and columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    char_distance, word_distance, base_failed and kept. One pass for the references, one for the verdicts,
    no shuffle of texts.
    """
    rules = rules or Rules()
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance"]
    keep = [c for c in docs.columns if c.lower() not in {*added, "base_failed", "kept"}]
    reference = references(docs, rules, text, lang)
    df = docs.select(F.struct(*keep).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = _class_counts(df, "_text")
    char_to = [distance(F.col("_classes"), F.col("_chars").cast("double"), r["chars"]) for r in reference.values()]

    def closest(found: list[Column], enough: Column) -> Column:
        return F.when(enough, F.least(*found) if len(found) > 1 else found[0]) if found else F.lit(None).cast("double")

    def word_distance(words: Column) -> Column:
        listed = F.filter(words, lambda w: w.isin(_listed(rules)))
        found = lambda c: closest(
            [_word_distance(c, F.size(words), rules.words[code], r["words"]) for code, r in reference.items()],
            F.size(words) >= rules.least_words,
        )
        return let(listed, found)

    def measures(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            (F.col("_chars") - F.col("_classes")[1].cast("long")).cast("long").alias("word_chars"),
            (F.length("_rest") - F.length(F.regexp_replace("_rest", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(words, rules.window).cast("long").alias("n_repeat_words"),
            closest(char_to, F.col("_chars") >= rules.least_chars).alias("char_distance"),
            word_distance(words).alias("word_distance"),
        )

    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # as a generator, so that a later filter on the measures does not compute them a second time
    df = df.select("_row", F.inline(F.array(let(split_words(F.col("_text")), measures))))
    failed = (F.col("n_words") < rules.base_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= rules.most_char_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= word_bound(rules)
    )
    return df.select("_row.*", *added, failed.alias("base_failed"), (~failed & near).alias("kept"))
