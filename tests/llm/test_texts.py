import random
import re

from odd_documents import none, odd  # noqa: F401

from vitalgrid.llm import divergence, licenses
from vitalgrid.llm.licenses import TEMPLATES

GAP = re.compile(r"[\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = [w for w in GAP.split(text) if w]
    lines = [x for x in text.split("\n") if GAP.sub("", x)]
    starts, inside = {}, set()
    for i in range(len(words) - 7):
        starts.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in starts.values():
        if len(at) > 1:
            inside.update(p for i in at for p in range(i, i + 8))
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed
    )


def measures(df):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return {(r["doc_id"], r["text"]): tuple(r[n] for n in names) for r in df.collect()}


def test_base_rules_against_brute_force(spark, odd):
    got = divergence.judge(odd)
    assert got.count() == odd.count()
    assert measures(got) == {(r["doc_id"], r["text"]): base(r["text"]) for r in odd.collect()}
    assert not got.where("kept AND base_failed").count()


def test_repeats_against_brute_force(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["a ", "b ", "c\n", "d# ", "\t"]) for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "CAST(NULL AS string) AS lang")
    assert measures(divergence.judge(df)) == {(i, t): base(t) for i, t in enumerate(texts)}


def test_verdicts_follow_the_language(spark):
    rnd = random.Random(4)
    common, rare = divergence.FUNCTION_WORDS["en"], ["window", "river", "stone", "walker", "nine"]
    prose = lambda: " ".join(rnd.choice(common if rnd.random() < 0.4 else rare) for _ in range(200))
    rows = [(i, prose(), "en") for i in range(30)] + [(100, "### $$$ %%% &&& |||" * 40 + " ab" * 60, "en"), (101, " ".join(f"{w}{i}" for i in range(99) for w in rare), "en")]
    kept = {r["doc_id"]: r["kept"] for r in divergence.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(kept[i] for i in range(30)) and not kept[100] and not kept[101]


def test_quality_rules_on_nothing(spark, none):
    assert divergence.judge(none).count() == 0


def spelled(text):
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def test_license_places_against_brute_force(spark, odd):
    texts = [
        "MIT License mit-license; the Apache\nLicense", "general public license apache license", "mitlicense mit licenses", "É mit License Ü",
        "General  Public... LICENSE", "license mit license license",
    ]
    more = spark.createDataFrame([(50 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(more)
    got = {(r["doc_id"], r["n_words"]): r for r in licenses.scan_licenses(docs).collect()}
    for r in docs.collect():
        words, found, labels = spelled(r["text"]), [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            found += at
            labels |= {label} if at else set()
        row = got[r["doc_id"], len(words)]
        assert (row["n_base"], row["first_word"], row["last_word"]) == (len(found), min(found, default=None), max(found, default=None))
        assert row["base_labels"] == ",".join(sorted(labels)) and labels <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


def test_license_text_with_changed_words(spark):
    label, body = TEMPLATES[4]
    words = body.split()
    changed = " ".join(words[:20] + ["really", "truly"] + words[20:40] + words[41:])
    rows = [(1, "x y z " * 50 + changed + " end" * 50), (2, " ".join(words[:8])), (3, "plain words only here " * 30), (1, "x y z " * 50 + changed + " end" * 50)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 4 and by[1]["labels"] == label and by[1]["n_base"] == 0 and by[1]["score"] > 0.7
    assert by[1]["spans"][0]["first"] == 150
    assert by[2]["labels"] == "" and 0 < by[2]["score"] < 0.5 and by[3]["score"] == 0


def test_license_scan_on_nothing(spark, none):
    assert licenses.scan_licenses(none).count() == 0
