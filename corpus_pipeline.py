"""A training-data pipeline over ``documents``: five operators, each stage written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from profilekit.llm import stages
from profilekit.session import ensure_checkpoint_dir, scratch, shared_path

STAGES = [
    ("language_id", stages.known_language),
    ("toxicity", stages.not_toxic),
    ("near_duplicates", stages.one_of_each_group),
    ("decontamination", stages.free_of_benchmarks),
    ("sentencepiece", stages.encoded),
]

# Learnt models and tokenizers are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents that pass all stages."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        with scratch(spark):  # the stage's own intermediate tables go as soon as its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
