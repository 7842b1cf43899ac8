"""Size-checked broadcast and hot-key salting give the same rows as a plain join."""

from pyspark.sql import functions as F

from profilekit.operators.joins import bounded_broadcast, checked_join, hot_keys, salted_join
from tests.conftest import plan_text, rows


def _skewed(spark):
    # key 0 holds a third of the rows
    big = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "zero"), (0, "nil"), (5, "five"), (200, "none")], "sk long, name string")
    return big, small


def test_hot_keys_finds_the_heavy_key(spark):
    big, _ = _skewed(spark)
    hot = hot_keys(big, "k", fraction=0.5)
    assert 0 in hot and 0.2 < hot[0] < 0.5


def test_salted_join_equals_plain_join(spark):
    big, small = _skewed(spark)
    for how in ("inner", "left"):
        plain = big.join(small, big["k"] == small["sk"], how)
        for hot in ([0], {0: 0.34, 5: 0.01}):
            salted = salted_join(big, small, "k", "sk", how, buckets=7, hot=hot)
            assert rows(salted.select("k", "v", "sk", "name")) == rows(plain.select("k", "v", "sk", "name"))


def test_checked_join_without_broadcast_is_exact(spark):
    big, small = _skewed(spark)
    plain = big.join(small, big["k"] == small["sk"], "left")
    got = checked_join(big, small, "k", "sk", "left", max_rows=0)
    assert rows(got.select("k", "v", "sk", "name")) == rows(plain.select("k", "v", "sk", "name"))


def test_bounded_broadcast_checks_rows_and_bytes(spark):
    small = spark.range(10)
    _, ok = bounded_broadcast(small, max_rows=10)
    assert ok
    _, ok = bounded_broadcast(small, max_rows=9)
    assert not ok
    _, ok = bounded_broadcast(small.select(F.col("id").cast("string").alias("s")), max_rows=100,
                              byte_measure=F.length("s"), max_bytes=5)
    assert not ok


def test_bounded_broadcast_of_an_empty_side(spark):
    empty = spark.createDataFrame([], "k long, name string")
    side, ok = bounded_broadcast(empty)
    assert ok and side.count() == 0
    big, _ = _skewed(spark)
    assert checked_join(big, empty, "k", "k", "inner").count() == 0


def test_wide_side_is_refused(spark):
    big, _ = _skewed(spark)
    wide = spark.range(0, 1000).select(F.col("id").alias("sk"), F.repeat(F.lit("x"), 5000).alias("text"))
    side, small = bounded_broadcast(wide, max_bytes=1_000_000)  # every column is measured
    assert not small and side.count() == 1000
    plan = plan_text(checked_join(big, wide, "k", "sk", max_bytes=1_000_000), "simple")
    assert "BroadcastHashJoin" not in plan.split("AdaptiveSparkPlan")[1]
    numbers = spark.range(0, 1000).select(*[F.col("id").alias(f"c{i}") for i in range(50)])
    assert not bounded_broadcast(numbers, max_bytes=100_000)[1] and bounded_broadcast(numbers, max_bytes=500_000)[1]


def test_null_keys_of_a_left_join_are_spread(spark):
    big = spark.range(0, 1000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (3, "b")], "sk long, name string")
    for hot in ({}, {0: 0.1}):
        got = salted_join(big, small, "k", "sk", "left", hot=hot)
        assert rows(got) == rows(big.join(small, big["k"] == small["sk"], "left"))
    kept = salted_join(big, small, "k", "sk", "left_semi", hot={0: 0.1})
    assert rows(kept) == rows(big.join(small, big["k"] == small["sk"], "left_semi"))
