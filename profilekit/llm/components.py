"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from profilekit.session import shared_path


def written(df: DataFrame, name: str, *measures, path: str | None = None) -> tuple[DataFrame, dict]:
    """``df`` written to the shared folder (to ``path`` if given) and reread (its lineage ends there), with measures observed on the way."""
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    got = {}
    if measures:
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        df.observe(seen, *measures).write.parquet(path)
        got = seen.get
    else:
        df.write.parquet(path)
    return spark.read.parquet(path), got


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component) of every id in ``edges`` (long columns a, b): component is the smallest id reachable.

    Each round hangs the larger neighbours of every id, then its smaller
    ones, on its smallest neighbour; the edges shrink to stars around the
    smallest ids in a number of rounds that grows with the logarithm of the
    longest path. Neighbour minima are pre-aggregated before the shuffle, and
    the edges meet them in joins, which adaptive execution splits for hot ids.
    """
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    print_of = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")]
    current, seen = written(edges.filter("a <> b").select(*pair).distinct(), "edges", *print_of)
    for _ in range(max_rounds):
        if not seen.get("n"):
            break
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours hang on the smallest of the neighbours and the id itself
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        # small star: an id and its smaller neighbours hang on the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        following, now = written(small.filter("a <> b").distinct(), "edges", *print_of)
        if now == seen:
            break
        current, seen = following, now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # at the end every id but the smallest of its component has one edge, to the smallest
    stars = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())
