"""The operators of this package applied to the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.llm import (
    decontaminate,
    exact_dedup,
    line_dedup,
    lm,
    negatives,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    toxicity,
    trie,
    url_filters,
)
from parcelgrid.llm.common import read, remainder_of_id

TOXIC = 0.7  # documents with this score or more are judged toxic
GOOD = 0.3  # documents with this score or more are judged good
TOKENIZER = "word_bpe_49k.json"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without passages of lines that stand elsewhere before."""
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies: fingerprints of 3-word shingles within 2 bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), 3, 2)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learnt from two thirds of the labels."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity.with_scores(docs, read(spark, sf_dir, "labels"), remainder_of_id(3) != 1)
    return scored.select(
        "doc_id",
        (remainder_of_id(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        "evidence",
    )


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url under the rules of the contract."""
    rules = spark.createDataFrame(url_filters.RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(read(spark, sf_dir, "pages", "page_id", "url"), rules)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in token sequences of fixed length."""
    path = public_tokenizers.path(TOKENIZER)
    return packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"), path)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; six of seven folds are learnt from."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held_out = remainder_of_id(7) == 2
    scored = lm.score_texts(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), *scored.columns[1:])


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in each document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.with_leaks(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("bigint").alias("n_items"),
        "leaks",
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data per document."""
    return pii.find_pii(read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets per document, told apart by who holds them; sources are the owners."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return secrets.scan_secrets(docs)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of texts that are equal but for white space."""
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    vectors = negatives.quantized(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return negatives.mine(vectors, F.col("id") % 100 == 0)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    turns, convs = trie.numbered(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return trie.prefix_trie(*trie.rebuilt(turns, convs))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from four fifths of the labels."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality.with_quality(docs, read(spark, sf_dir, "labels"), remainder_of_id(5) != 0)
    return scored.select(
        "doc_id",
        (remainder_of_id(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_simhash_near_dedup,
        op3_toxicity,
        op4_url_filters,
        op5_packing,
        op6_lm_scoring,
        op7_benchmark_decontamination,
        op8_pii,
        op9_secret_scans,
        op10_exact_dedup,
        op11_hard_negatives,
        op12_conversation_trie,
        op13_quality_classifier,
    )
}

ORACLES = {
    "op4_url_filters": url_filters.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
    "op12_conversation_trie": trie.ORACLE,
}
