"""License scan by diagonal voting.

All rolling k-grams of a document's words are joined with the k-grams of a few
license templates. Matches on one diagonal (document position minus template
position) belong to one occurrence; neighbouring diagonals, apart by inserted or
lost words, are merged; a merged span counts if it covers enough of its template
and is not much longer than it. Beside the votes, places where a given phrase
stands word by word are counted in the row itself.

The template side is bounded by the parameter, so it is broadcast; document
k-grams are never shuffled, only their few matches are. A match compares a
64-bit and an independent 32-bit hash of the k words.

Defined results: a null or empty text has no words, no places, empty labels and
score 0. Rows with equal id and text get equal results and are scored once;
rows with equal ids and different texts are kept apart. The result has one row
for each input row, with the id and the columns below only, so no other input
column can clash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import let

#: Everything but digits, small letters and characters beyond ASCII parts two words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Public license notices, as (label, text).
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)


@dataclass(frozen=True)
class Scan:
    phrases: tuple[tuple[str, str], ...] = PHRASES
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    gram: int = 4
    #: Diagonals apart by no more words than this are one occurrence.
    slack: int = 3
    #: Share of a template's words that a span must cover, and its length at most in templates.
    least_cover: float = 0.7
    most_length: float = 1.5


def _clean(text: Column) -> Column:
    """Words in small letters, each between two single spaces.

    ``lower`` also changes letters beyond ASCII, but only into word characters,
    so word borders, numbers of words and ASCII phrases stay the same.
    """
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), GAP, " ")), F.lit(" "))


def _words(clean: Column) -> Column:
    return F.when(clean == "  ", F.array().cast("array<string>")).otherwise(F.split(F.trim(clean), " ", -1))


def _grams(words: Column, k: int) -> Column:
    """Two hashes of each k words in a row, by start."""

    def hashed(words: Column) -> Column:
        made = F.transform(
            F.sequence(F.lit(1), F.size(words) - k + 1),
            lambda i: let(F.slice(words, i, k), lambda g: F.struct(F.xxhash64(g).alias("h"), F.hash(g).alias("c"))),
        )
        return F.when(F.size(words) >= k, made).otherwise(F.array().cast("array<struct<h:bigint,c:int>>"))

    return let(words, hashed)


def _places(words: Column, clean: Column, phrase: str) -> Column:
    """0-based starts of a phrase; the rows without it skip the search."""
    parts = phrase.split(" ")

    def search(words: Column) -> Column:
        def fits(i: Column) -> Column:
            found = F.get(words, i) == parts[0]
            for j, part in enumerate(parts[1:], 1):
                found = found & (F.get(words, i + j) == part)
            return found

        return F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), fits)

    return F.when(F.contains(clean, F.lit(f" {phrase} ")), let(words, search)).otherwise(F.array().cast("array<int>"))


def _template_grams(docs: DataFrame, scan: Scan) -> DataFrame:
    spark = docs.sparkSession
    rows = [(i, label, text) for i, (label, text) in enumerate(scan.templates)]
    made = spark.createDataFrame(rows, "tpl int, label string, body string").withColumn("w", _words(_clean(F.col("body"))))
    return made.select("tpl", "label", F.size("w").alias("tpl_words"), F.posexplode(_grams(F.col("w"), scan.gram)).alias("tpos", "g")).select(
        "tpl", "label", "tpl_words", "tpos", F.col("g.h").alias("h"), F.col("g.c").alias("c")
    )


def spans(docs: DataFrame, scan: Scan, doc_id: str, text: str) -> DataFrame:
    """Merged diagonals: (_id, _hash, tpl, label, first, last, votes, cover), verified or not."""
    keyed = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), _clean(F.col(text)).alias("_clean"))
    grams = keyed.select("_id", "_hash", F.posexplode(_grams(_words(F.col("_clean")), scan.gram)).alias("dpos", "g")).select(
        "_id", "_hash", "dpos", F.col("g.h").alias("h"), F.col("g.c").alias("c")
    )
    matches = grams.join(F.broadcast(_template_grams(docs, scan)), ["h", "c"]).select(
        "_id", "_hash", "tpl", "label", "tpl_words", "dpos", "tpos"
    )
    # a diagonal holds at most as many matches as its template is long; equal rows vote once
    group = ["_id", "_hash", "tpl", "label", "tpl_words"]
    votes = (
        matches.withColumn("diagonal", F.col("dpos") - F.col("tpos"))
        .groupBy(*group, "diagonal")
        .agg(F.collect_set("tpos").alias("at"), F.min("dpos").alias("first"), F.max("dpos").alias("last"))
    )
    along = Window.partitionBy(*group).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > scan.slack, F.lit(True))
    merged = votes.withColumn("part", F.sum(apart.cast("int")).over(along)).groupBy(*group, "part").agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        F.min("first").alias("first"),
        (F.max("last") + scan.gram - 1).alias("last"),
    )
    covered = F.size(
        F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + scan.gram - 1))))
    )
    return merged.select(
        "_id", "_hash", "tpl", "label", "first", "last", F.size("at").alias("votes"),
        (covered / F.col("tpl_words")).alias("cover"),
        ((F.col("last") - F.col("first") + 1) / F.col("tpl_words")).alias("length"),
    )


def scan_licenses(docs: DataFrame, scan: Scan | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: the id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    scan = scan or Scan()
    found = (
        spans(docs, scan, doc_id, text)
        .withColumn("verified", (F.col("cover") >= scan.least_cover) & (F.col("length") <= scan.most_length))
        .groupBy("_id", "_hash")
        .agg(
            F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("voted"),
            F.max("cover").alias("cover"),
            F.sort_array(F.collect_list(F.when(F.col("verified"), F.struct("first", "last", "label", "cover")))).alias("spans"),
        )
        .withColumnsRenamed({"_id": "_id2", "_hash": "_hash2"})
    )
    rows = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), _clean(F.col(text)).alias("_clean"))
    rows = rows.withColumn("_words", _words(F.col("_clean")))
    starts = [_places(F.col("_words"), F.col("_clean"), phrase) for phrase, _ in scan.phrases]
    rows = rows.select("_id", "_hash", F.size("_words").cast("long").alias("n_words"), F.array(*starts).alias("_starts"))
    places = F.flatten("_starts")
    base = F.array_distinct(
        F.filter(
            F.zip_with("_starts", F.array(*[F.lit(label) for _, label in scan.phrases]), lambda s, label: F.when(F.size(s) > 0, label)),
            lambda label: label.isNotNull(),
        )
    )
    rows = rows.select(
        "_id", "_hash", "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        base.alias("_base"),
    )
    joined = rows.join(found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_hash") == F.col("_hash2")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("_id").alias(doc_id), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.sort_array("_base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("_base", F.coalesce("voted", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.coalesce("cover", F.lit(0.0)))).alias("score"),
        "spans",
    )
