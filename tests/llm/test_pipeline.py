import random

import corpus_pipeline
import pytest
from compare import connect, difference
from odd_documents import SMALL, odd  # noqa: F401

from vitalgrid.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SMALL), SMALL, name, QUERIES, ORACLE) is None


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).toPandas()
    assert set(packed.doc_id) == {r["doc_id"] for r in docs.collect()}
    assert packed.groupby("doc_id").agg(n=("length", "sum"), d=("doc_tokens", "max")).eval("n == d").all()


def test_stages_on_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def first_of_each_group(rows, gram, percent):
    """The smallest id of each component, by comparing all pairs."""
    words = [t.lower().split() for _, t in rows]
    sets = [{tuple(w[i : i + gram]) for i in range(len(w) - gram + 1)} for w in words]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {rows[root(i)][0] for i in range(len(rows))}


def test_near_duplicates_by_five_words_and_four_fifths(spark):
    rnd, rows = random.Random(5), []
    for _ in range(12):
        text = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(60, 400))]
        for changed in (0, 0, 1, 3, 5, 8):
            other = list(text)
            for i in rnd.sample(range(len(text)), min(changed, len(text) // 20)):
                other[i] = f"x{rnd.randint(0, 99)}"
            rows.append((len(rows), " ".join(other)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()}
    assert kept == first_of_each_group(rows, 5, 80)
    assert kept != first_of_each_group(rows, 3, 90)


def test_short_word_lists_go_and_short_prose_stays(spark):
    from vitalgrid.llm.divergence import FUNCTION_WORDS

    rnd, rows = random.Random(2), []
    plain = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(3, 9))) for _ in range(300)]
    for n in [500] * 20 + [51, 60, 75, 99] * 5:
        words = [rnd.choice(FUNCTION_WORDS["en"]) if rnd.random() < 0.3 else rnd.choice(plain) for _ in range(n)]
        rows.append((len(rows), "en", " ".join(words)))
    lists = [(1000 + n, "en", " | ".join(rnd.sample(plain, n // 2))) for n in (104, 120, 150, 196)]
    lists += [(2000 + n, "en", " ".join(w + "|" for w in rnd.sample(plain, n))) for n in (60, 70, 99)]
    docs = spark.createDataFrame(rows + lists, "doc_id long, lang string, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, SMALL).collect()}
    assert kept & {i for i, _, _ in lists} == set()
    assert kept == {i for i, _, _ in rows}


def test_foreign_texts_and_random_letters_go_and_documents_stay(spark):
    rnd = random.Random(1)
    words = {
        "polish": "w roku który został miasto przez jest nie na się do ale tylko jego było przed wszystkie kiedy ludzie dom woda droga szkoła",
        "russian": "в году который город через есть не на но только его было перед все когда люди дом вода дорога школа работа день",
        "dutch": "in het jaar dat de stad door is niet op maar alleen zijn was voor alle wanneer mensen huis water weg school werk",
    }
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = [(-1 - i, " ".join(rnd.choice(w.split()) for _ in range(120)), None, name, 0) for i, (name, w) in enumerate(words.items())]
    odd.append((-9, " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(120)), None, "random", 0))
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, both, SMALL).collect()}
    assert not kept & {r[0] for r in odd}
    assert kept == {r["doc_id"] for r in docs.where(r"text RLIKE '\\p{L}'").collect()}


def test_stages_on_odd_documents(spark, odd):
    count = lambda df: sorted(str(r["doc_id"]) for r in df.collect())
    judged = corpus_pipeline.quality_rules(spark, odd, SMALL)
    assert judged.columns == odd.columns and not {"1", "2", "3"} & set(count(judged))
    known = corpus_pipeline.language_id(spark, odd, SMALL)
    assert known.columns == odd.columns and not {"1", "2", "3"} & set(count(known)) and "8" in count(known)
    left = corpus_pipeline.near_duplicates(spark, odd, SMALL)
    assert left.columns == odd.columns
    # copies of long and of repeated rows leave one; texts without words stay
    assert count(left) == sorted(str(i) for i in (1, 2, 3, 4, 5, 6, None, None, 8, 9, 10))
    packed = corpus_pipeline.pack(spark, odd, SMALL).toPandas()
    assert len(packed[packed.doc_id == 8].groupby("doc_id").size()) == 1 and packed.length.gt(0).all()
    assert int(packed[packed.doc_id == 2].doc_tokens.iloc[0]) == 1
