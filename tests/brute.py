"""Brute-force forms used only to check the library on small fixtures."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilekit.operators.profile import SCORE_DIVISOR
from profilekit.operators.substring import clean_keys
from profilekit.vocab import INTERESTS


def contains_match(texts: DataFrame, text_col: str, dictionary: DataFrame, key_col: str,
                   priority_col: str) -> DataFrame:
    """Every (text, key) pair tested with ``contains`` (nested loop), best key per text."""
    t = texts.select(F.col(text_col).alias("text")).filter(F.col("text").isNotNull()).distinct()
    keys = F.broadcast(clean_keys(dictionary, key_col, priority_col))
    pairs = t.join(keys, F.col("text").contains(F.col("key")), "inner")
    return (pairs.groupBy("text").agg(F.min(F.struct("priority", "key")).alias("_b"))
            .select("text", "_b.key", "_b.priority"))


def score_profile_plain(pairs: DataFrame, scores: DataFrame, pair_key: str, score_key: str,
                        score_cols: Sequence[str] = INTERESTS, user_col: str = "userid",
                        by: Sequence[str] = (), divisor: float = SCORE_DIVISOR) -> DataFrame:
    """The direct form (join, then ``avg(x) / divisor``); used to test ``score_profile``."""
    joined = pairs.join(scores, pairs[pair_key] == scores[score_key], "inner")
    exprs = [(F.avg(F.col(c).cast("double")) / F.lit(float(divisor))).alias(c) for c in score_cols]
    return joined.groupBy(user_col, *by).agg(*exprs)
