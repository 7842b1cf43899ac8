"""The operators as filters of a corpus: each takes (spark, docs, sf_dir) and returns the documents it keeps.

All but the last return the columns of ``docs`` as they are, whatever else they
are called. A rejected document goes as a whole; rows of null id are never
rejected by what is looked up by id. Decisions are made on ``docs`` alone: models
are learnt from the stage's own input (and the labels beside it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profilekit.llm import decontamination, language_id, near_duplicates, sentencepieces, toxicity
from profilekit.llm.components import written
from profilekit.llm.text import col, fresh
from profilekit.operators.joins import bounded_broadcast

SIMILAR = 80  # per cent of five-word shingles that near-duplicates of the corpus share


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose id is not among ``ids`` (column doc_id)."""
    name = fresh("id")
    rejected, _ = bounded_broadcast(ids.select(F.col("doc_id").alias(name)).distinct())
    return docs.join(rejected, col("doc_id") == F.col(name), "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language can be told; null, empty and letterless texts go."""
    field, mark = language_id.learn(docs), fresh("lid")
    if not field.languages:  # nothing to learn from: only letterless texts can be rejected
        return docs.filter(col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, field, keep=docs.columns, prefix=mark)
    return found.filter(F.col(mark + "lang_pred") != language_id.UNKNOWN).select(*[col(c) for c in docs.columns])


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents scored below the toxicity threshold."""
    mark = fresh("tox")
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = toxicity.score(docs, model, keep=docs.columns, prefix=mark)
    return found.filter(F.col(mark + "predicted") == 0).select(*[col(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of every near-duplicate group (similarity of 0.8 or more).

    Rows of one id and different texts are documents of their own: of those
    in one group the one with the smallest text hash stays. Rows of equal id and text
    are one document, of which one row stays.
    """
    found, _ = written(near_duplicates.grouped(docs, threshold=SIMILAR), "near-duplicates")
    keys = ["doc_id", "text_hash"]
    rows = found.filter("doc_id is not null").groupBy(*keys, "group", "component_id").agg(F.count(F.lit(1)).alias("n"))
    # texts of one id and group: the smallest hash stays
    other = F.row_number().over(Window.partitionBy("group", "doc_id").orderBy("text_hash")) > 1
    rows = rows.withColumn("other", other).withColumn(
        "gone", F.col("group").isNotNull() & ((F.col("doc_id") != F.col("component_id")) | F.col("other")))
    listed, seen = written(rows.filter("gone or n > 1"), "row-fates", F.count(F.when(~F.col("gone"), 1)).alias("repeated"))
    mark, h = fresh("id"), fresh("hash")
    hashed = docs.withColumn(h, F.xxhash64(col("text").cast("string")))

    def side(which):
        rows, _ = bounded_broadcast(listed.filter(which).select(F.col("doc_id").alias(mark), F.col("text_hash").alias(mark + "h")))
        return rows
    same = (col("doc_id") == F.col(mark)) & (F.col(h) == F.col(mark + "h"))
    kept = hashed.join(side(F.col("gone")), same, "left_anti")
    if not seen.get("repeated"):
        return kept.drop(h)
    again = side(~F.col("gone"))
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", h])
    return kept.join(again, same, "left_anti").unionByName(once).drop(h)


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item, also none with other numbers, names or units."""
    return _without(docs, decontamination.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with doc_id, lang and source."""
    return sentencepieces.encode_pieces(docs, keep=[c for c in ("doc_id", "lang", "source") if c in docs.columns])
