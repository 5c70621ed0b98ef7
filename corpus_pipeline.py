"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm import divergence, jaccard, languages, packing
from vitalgrid.llm.common import table, tokenizer_file
from vitalgrid.session import settle

#: A document stays if at least this share of its n-grams belongs to one language. Texts in languages
#: that were not learned and random letters stay below 0.4, documents of the learned ones above 0.6.
LEAST_LANGUAGE_SCORE = 0.5
#: Words are judged from 50 on, by a bound that depends on their number (``op10`` keeps the bounds of its
#: contract). Short texts are no junk in themselves, and a text may repeat itself up to three fifths.
PROSE = divergence.Rules(base_words=1, repeat_percent=60, least_words=50, most_word_distance=0.22, widened=True)
#: Near copies share four fifths of their five-word shingles (``op8`` keeps its own bounds).
NEAR_COPIES = jaccard.Join(gram=5, percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject.

    Null texts and texts without a word go; very long ones are judged whole; repeated rows get equal verdicts.
    Nulls in other columns reject nothing.
    """
    return divergence.judge(docs, PROSE).where("kept").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are in no known language.

    Null, empty and letterless texts go; repeated rows get equal verdicts; a null ``lang`` is not learned from.
    Without any labelled language no document stays.
    """
    known = languages.learn(docs)
    judged = languages.identify(docs, known, predicted="_language", score="_share")
    return judged.where((F.col("_language") != languages.UNKNOWN) & (F.col("_share") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    The smallest id stays, of rows with equal ids and texts one. Null and empty texts have no copies and stay;
    a null id stays only where no copy has an id.
    """
    return jaccard.deduplicate(docs, NEAR_COPIES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences; a null text is an empty document of one token."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near duplicates", near_duplicates),
    ("packing", pack),
]
#: SQL cannot express the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
