"""Bit tables of long id lists, and hot keys observed while a side is written."""

from pyspark.sql import functions as F

from profilekit.operators import joins
from profilekit.operators.bittable import bit_table, few_unlisted, maybe_listed
from profilekit.operators.joins import checked_join, join_side, write_with_hot_keys
from profilekit.operators.matching import id_coverage, match_ids
from profilekit.session import shared_path
from tests.conftest import plan_text, rows


def test_no_listed_id_is_lost_and_few_others_stay(spark):
    # three million ids, far past the rows of a broadcast side
    ids = spark.range(0, 3_000_000).select(F.md5((F.col("id") * 2).cast("string")).alias("imei"))
    log = spark.range(0, 60_000).select(F.md5(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    kept = maybe_listed(log, "k", bit_table(ids, "imei"))
    assert kept.columns == ["k", "v"]
    got = kept.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("v") % 2 == 0).cast("int")).alias("listed")).first()
    assert got["listed"] == 30_000
    assert got["n"] < 30_000 * 1.02  # one unlisted row in fifty at most
    before = plan_text(kept, "simple").split("Initial Plan")[-1]
    assert "BroadcastHashJoin" in before and "hashpartitioning(k" not in before


def test_size_is_bounded_and_a_full_table_still_loses_nothing(spark):
    ids = spark.range(0, 100_000).select(F.col("id").cast("string").alias("i"))
    table = bit_table(ids, "i", max_bits=32_768)  # a third of a bit for each id
    assert table.blocks == table.places == 1 and table.rows.count() == 1
    assert table.rows.agg(F.max(F.octet_length("bits"))).first()[0] == 4096
    assert maybe_listed(ids, "i", table).count() == 100_000


def test_nulls_repeats_empty_lists_and_clashing_names(spark):
    ids = spark.createDataFrame([("a",)] * 500 + [(None,), ("",)], "i string")
    log = spark.createDataFrame([("a", 1, b"x"), ("a", 1, b"x"), (None, 2, b"x"), ("", 3, None), ("b", 4, b"x")],
                                "k string, block int, bits binary")
    got = maybe_listed(log, "k", bit_table(ids, "i"))
    assert [r[0] for r in rows(got)] == ["", "a", "a"] and got.columns == log.columns
    assert maybe_listed(log, "k", bit_table(ids.limit(0), "i")).count() == 0
    assert maybe_listed(log.limit(0), "k", bit_table(ids, "i")).count() == 0
    # a hash does not see that 1 = '1': unlike types are left to the join
    assert few_unlisted(log, "block", ids, "i") is log


def test_id_matching_past_the_bound_equals_the_broadcast_form(spark, monkeypatch):
    log = spark.range(0, 4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 700).cast("string")).alias("userid"),
        (F.col("id") % 11).cast("string").alias("mediadata"), F.lit("view").alias("channel"),
        F.lit("2024-01-30").alias("etl_dt"))
    ids = spark.createDataFrame([("hot",), ("7",), ("7",), ("9999",), (None,)], "imei_match string")
    mapping = spark.createDataFrame([("hot", "imei"), ("hot", "imei"), ("8", "imei"), ("7", "idfa"), (None, "imei")],
                                    "idfa_imei string, app_flag string")
    want, cover = rows(match_ids(ids, log, "2024-01-31", 1, 1, 3)), rows(id_coverage(ids, mapping))
    monkeypatch.setattr(joins, "DEFAULT_MAX_ROWS", 0)
    assert want and rows(match_ids(ids, log, "2024-01-31", 1, 1, 3)) == want
    assert rows(id_coverage(ids, mapping)) == cover


def test_rows_that_reach_the_shuffle_are_near_the_matches(spark, monkeypatch):
    written = []
    plain = joins.write_with_hot_keys

    def watched(df, path, key):
        hot = plain(df, path, key)
        written.append(spark.read.parquet(path).count())
        return hot

    monkeypatch.setattr(joins, "DEFAULT_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "write_with_hot_keys", watched)
    log = spark.range(0, 20_000).select(F.col("id").cast("string").alias("userid"), F.lit("m").alias("mediadata"),
                                        F.lit("view").alias("channel"), F.lit("2024-01-30").alias("etl_dt"))
    ids = spark.range(0, 40_000, 400).select(F.col("id").cast("string").alias("imei_match"))
    assert match_ids(ids, log, "2024-01-31", 1, 1, 1).count() == 50
    assert max(written) < 500


def test_hot_keys_are_observed_during_the_write(spark, monkeypatch):
    big = spark.range(0, 30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, None)
        .otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3), (None, 4)], "sk string, w int")
    hot = write_with_hot_keys(big, shared_path(spark, "hot-test"), "k")
    assert list(hot) == [spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]]
    assert abs(hot.popitem()[1] - 0.5) < 0.01  # of the rows that have a key

    def sampled(*_, **__):
        raise AssertionError("no sampling job")

    monkeypatch.setattr(joins, "hot_keys", sampled)
    for how in ("inner", "left", "left_semi"):
        got = checked_join(big, small, "k", "sk", how, max_rows=0)
        assert rows(got) == rows(big.join(small, big["k"] == small["sk"], how))
    plan = plan_text(checked_join(big, small, "k", "sk", max_rows=0), "extended")
    assert "Sample" not in plan and "_salt" in plan


def test_keys_of_unlike_types_are_sampled(spark):
    big = spark.range(0, 3000).select((F.col("id") % 3).cast("int").alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (2, "b")], "sk long, name string")
    assert rows(join_side(big, small, False, "k", "sk")) == rows(big.join(small, big["k"] == small["sk"]))


def test_an_empty_side_has_no_hot_keys(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert write_with_hot_keys(empty, shared_path(spark, "hot-empty"), "k") == {}
