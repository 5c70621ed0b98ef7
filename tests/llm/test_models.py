import zlib

import numpy as np
import pytest
from odd_documents import SMALL, none, odd  # noqa: F401

from vitalgrid.llm import languages, quality, urls
from vitalgrid.llm.queries import QUERIES

MIDDLE = SMALL.replace("0.001", "0.01")


def test_language_on_held_out_documents(spark):
    got = QUERIES["op6_language_id"](spark, MIDDLE).toPandas()
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs)
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99 and got.score.between(0, 1).all()


def test_language_filter_names_every_language_of_a_gram(spark):
    rows = [("der hund und die katze", "de"), ("the dog and the cat", "en"), ("el perro y la gata", "es")] * 5 + [(None, "en"), ("x", None)]
    known = languages.learn(spark.createDataFrame(rows, "text string, lang string"), languages.Settings(places=1 << 14))
    assert known.languages == ["de", "en", "es"]
    for text, lang in rows[:3]:
        at = languages.places_of(languages.grams(text), known.hashes, known.masks.shape[1])
        bits = known.masks[0][at[0]] & known.masks[0][at[1]] & known.masks[0][at[2]]
        assert ((bits >> known.languages.index(lang)) & 1).all()


def test_many_languages_need_more_words(spark):
    rows = [(chr(97 + i % 26) * 3 + chr(97 + i // 26) * 5, f"l{i:03d}") for i in range(130)] * 2
    docs = spark.createDataFrame(rows, "text string, lang string")
    known = languages.learn(docs)
    assert known.masks.shape[0] == 3
    got = languages.identify(docs, known).collect()
    assert all(r["lang"] == r["lang_pred"] for r in got)


def test_language_of_odd_documents(spark, odd, none):
    known = languages.learn(odd)
    got = languages.identify(odd, known).collect()
    assert len(got) == odd.count() and all(r["kept"] == 7 for r in got)
    letterless = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert letterless == {1, 2, 3, None}
    nothing = languages.learn(none)
    assert languages.identify(none, nothing).count() == 0
    assert {r["lang_pred"] for r in languages.identify(odd, nothing).collect()} == {"und"}


def area(good, bad):
    bad = np.sort(bad)
    return (np.searchsorted(bad, good, "left") + np.searchsorted(bad, good, "right")).mean() / 2 / len(bad)


def test_quality_on_held_out_documents(spark):
    got = QUERIES["op5_quality_classifier"](spark, MIDDLE).toPandas()
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert area(held[held.quality == 1].score, held[held.quality == 0].score) > 0.9
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()


def test_quality_of_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 1), (7, 0), (9, None), (None, 1)], "doc_id long, quality int")
    got = quality.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0


def test_pooling_is_the_closest_rising_sequence():
    assert quality.pool_adjacent([3, 1, 2, 5, 4], [1, 1, 1, 1, 3]) == pytest.approx([2, 2, 2, 4.25, 4.25])


PAGES = [
    (1, "http://a.example.com/en/x"), (2, "https://WWW.example.com/en/?q=/fr/"), (3, "http://b.net/es/"), (4, "http://b.net"), (5, None), (6, ""),
    (7, "no scheme.com/"), (8, "x://com/"), (9, "http://notexample.com/en/"), (10, "http://example.com#/en/"), (11, "http://B.NET/fr/?a"),
    (None, "http://example.com/en/"), (1, "http://a.example.com/en/x"), (12, "a://b://c/d"), (13, "http://\u00c9.com/\u4e2d"),
]


def test_url_parts_and_rules(spark):
    df = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, host string, gram int")
    rows = urls.filter_urls(df).collect()
    assert len(rows) == len(PAGES)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert got[1] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[3] == ("b.net", "/es/", "net/es/", "block") and got[11] == ("b.net", "/fr/", "net/fr/", "block")
    assert got[4][:3] == ("b.net", "", None) and got[5][:3] == got[6][:3] == got[7][:3] == ("", "", None)
    assert got[5][3] == "allow"
    assert got[8] == ("com", "/", "com/", "allow") and got[9] == ("notexample.com", "/en/", "com/", "allow")
    assert got[10][:3] == ("example.com", "", None) and got[12][:2] == ("b:", "//c/d")
    assert got[13][:2] == ("\u00c9.com", "/\u4e2d")


def test_url_models_part_what_rules_part(spark):
    good = [(i, f"http://site{i}.com/news/{i}") for i in range(200)]
    bad = [(1000 + i, f"http://site{i}.net/es/pills-cheap-{i}") for i in range(200)]
    free = [(5000, "http://site5.org/news/5"), (5001, "http://site5.org/es/pills-cheap-5")]
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(spark.createDataFrame(good + bad + free, "page_id long, url string")).collect()}
    assert got[5000] == "allow" and got[5001] == "block"


def test_url_models_are_probabilities(spark):
    rows = [("http://aaa.com/", "allow"), ("http://bbb.com/", "block"), ("http://ab.com/", "block")]
    model = urls.fit(spark.createDataFrame(rows, "url string, verdict string"), urls.Models()).toPandas()
    assert len(model) == len(urls.SYMBOLS) ** 3 and np.isfinite(model.llr).all()


def test_urls_of_nothing(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
