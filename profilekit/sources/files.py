"""Readers for the text inputs of the jobs: dictionaries and id lists.

All are ``spark.read`` with a declared schema (no inference pass), so they
scale to many files and split large ones.

- ``read_pair_dictionary``: two tab-separated fields per line; a repeated key
  keeps the value of its last line (file name, then position in the file).
- ``read_scored_dictionary``: comma lines ``key, score_1 .. score_13``; the
  scores are typed as double (a non-number gives NULL, which ``avg`` skips);
  the 8 interests without a score are added as 0; ``priority`` = line order.
- ``read_id_list``: one id per line, not deduplicated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilekit.functions.columns import list_item
from profilekit.operators.ranking import global_index
from profilekit.operators.tagging import last_value_per_key
from profilekit.vocab import SCORED_INTERESTS, ZERO_INTERESTS


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with a file-order key: (file name, start of the block read, increasing id within it).

    A block is read by one task from front to back, so the id orders its lines
    whatever order the blocks of a file are dealt out in.
    """
    df = spark.read.text(path if isinstance(path, str) else list(path))
    return df.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_pos"), "value")


def read_pair_dictionary(spark: SparkSession, path: str | Sequence[str],
                         key: str = "key", value: str = "tag") -> DataFrame:
    """``(key, value)``: field 0 -> field 1 of tab-separated lines; last line wins.

    A line without a tab has no value (NULL); the original job failed on it.
    """
    lines = _lines(spark, path)
    pairs = lines.select("_file", "_block", "_pos",
                         list_item("value", 0, "\t").alias(key), list_item("value", 1, "\t").alias(value))
    return last_value_per_key(pairs, key, value, ["_file", "_block", "_pos"])


def read_scored_dictionary(spark: SparkSession, path: str | Sequence[str],
                           key: str = "iqytag", scores: Sequence[str] = SCORED_INTERESTS,
                           zeros: Sequence[str] = ZERO_INTERESTS) -> DataFrame:
    """``(key, priority, scores..., zeros...)`` from comma lines; empty keys dropped."""
    lines = _lines(spark, path)
    cols = [list_item("value", 0).alias(key), F.col("_file"), F.col("_block"), F.col("_pos")]
    cols += [list_item("value", i + 1).try_cast("double").alias(name) for i, name in enumerate(scores)]
    cols += [F.lit(0.0).alias(name) for name in zeros]
    df = lines.select(*cols).filter(F.col(key).isNotNull() & (F.length(key) > 0))
    # priority = position of the line in file order (files by name, then lines).
    ordered = global_index(df, ["_file", "_block", "_pos"], "priority")
    return ordered.select(key, "priority", *scores, *zeros)


def read_id_list(spark: SparkSession, path: str | Sequence[str], name: str = "imei_match") -> DataFrame:
    """One id per line as ``name``; repeated ids are kept."""
    df = spark.read.text(path if isinstance(path, str) else list(path))
    return df.select(F.col("value").alias(name))
