"""The registered queries: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilekit.llm import (
    conversation_trie,
    decontamination,
    html_text,
    importance,
    language_id,
    licenses,
    lm_scoring,
    near_duplicates,
    sentencepieces,
    token_counts,
    token_files,
    toxicity,
    vector_duplicates,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a model learnt from six sevenths of them."""
    docs = _table(spark, sf_dir, "documents")
    return lm_scoring.score_texts(docs, lm_scoring.held_out())


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents (five-word shingles, 85 per cent)."""
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    docs, held_out = _table(spark, sf_dir, "documents"), language_id.held_out()
    found = language_id.predict(docs, language_id.learn(docs, ~held_out))
    return found.withColumn("held_out", held_out)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, over 1,024 tokens or not, from the prefix tables."""
    found = token_counts.prefix_tables(_table(spark, sf_dir, "documents"), tables=False)
    return found.withColumn("over_limit", F.col("n_tokens") > 1024)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as flat token-id files in ascending order, and read back."""
    return token_files.read_token_files(token_files.write_token_files(_table(spark, sf_dir, "documents")))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under the SentencePiece model, decoded again and held against the library."""
    return sentencepieces.encode_pieces(_table(spark, sf_dir, "documents"))


def op8_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label (cosine 0.98) among all embeddings."""
    return vector_duplicates.vector_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of two thirds of them."""
    docs, held_out = _table(spark, sf_dir, "documents"), toxicity.held_out()
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).withColumn("held_out", held_out)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers, names or units: one row per pair."""
    return decontamination.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and drawing rank of every document against the benchmark's texts."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document by ordered signature rules."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_lm_scoring, op2_html_text, op3_near_duplicates, op4_language_id, op5_token_counts, op6_token_files, op7_sentencepiece,
    op8_vector_duplicates, op9_toxicity, op10_decontamination, op11_importance_resampling, op12_license_scan,
    op13_conversation_trie)}

# DuckDB SQL where SQL can express an operator
SQL: dict[str, str] = {
    "op11_importance_resampling": importance.resample_sql(),
    "op12_license_scan": licenses.scan_sql(),
    "op13_conversation_trie": conversation_trie.prefix_trie_sql(),
}
