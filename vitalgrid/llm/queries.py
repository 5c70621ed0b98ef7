"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm import bpe, chat, codes, divergence, jaccard, languages, licenses, negatives, oracle, packing, quality, topk, urls, warc
from vitalgrid.llm.common import doc_crc, table, tokenizer_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted and read back."""
    odd = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    nodes = chat.number_turns(rows, "conv_id", "turn", "role", "text").withColumn("score", F.lit(0.0))
    made = chat.format_trees(nodes).withColumn("turns", chat.read_turns(F.col("formatted")))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # cut out of the formatted text by the mask alone
    cut = lambda s: F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))
    learned = F.array_join(F.transform("loss_spans", lambda s: chat.unescape(cut(s))), "")
    return made.select(
        F.col("tree").try_cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE["op1_chat_formatting"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace(replace(replace(role, '\', '\b'), '<|', '<\p'), chr(10), '\n'))
    + length(replace(replace(text, '\', '\b'), '<|', '<\p'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagonal voting over all documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query
def op4_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by fragments and decoded again."""
    made = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned from four of five folds of the labels."""
    made = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return made.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two of three folds."""
    fold = F.pmod(doc_crc(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = languages.learn(docs.where(fold != 1))
    made = languages.identify(docs.select("doc_id", (fold == 1).alias("held_out"), "text"), known)
    return made.select("doc_id", "held_out", "lang_pred", "score")


@query
def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other rows of every fiftieth embedding."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op7_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(list_zip(q.e, x.e), lambda p: p[1] * p[2])) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 5"""


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose three-word shingles agree to nine tenths."""
    return jaccard.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and the character model ratio over all pages."""
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution divergence over all documents."""
    return divergence.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding; every seventh stands under a neighbouring label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = oracle.negatives(negatives.Mining(), "(label + 1) % 10")


@query
def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files and read back."""
    made = warc.round_trip(table(spark, sf_dir, "pages"))
    return made.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op12_warc_archive"] = oracle.ARCHIVE


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings after six rounds."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


ORACLE["op13_vector_codes"] = oracle.codes(codes.Codes())
ORACLE["op10_quality_rules"] = oracle.quality_rules(divergence.Rules())
ORACLE["op8_ngram_jaccard_join"] = oracle.JACCARD
ORACLE["op3_license_scan"] = oracle.license_scan(licenses.Scan())
