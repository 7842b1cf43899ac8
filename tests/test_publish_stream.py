"""Sinks (re-run safety, append, create) and the streaming day-profile refresh."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from profilekit.operators.profile import flag_profile
from profilekit.operators.tagging import code_tags
from profilekit.sources.publish import publish, read_published, with_partition_schema
from profilekit.streaming.daily import closed_day_profiles, refresh_day_profiles
from profilekit.vocab import social_code_map
from tests.conftest import plan_text, rows


def _profile(spark):
    df = spark.createDataFrame([("u1", '{"usertag":"10001"}', "2024-01-01"),
                                ("u2", '{"usertag":"10002"}', "2024-01-02")],
                               "userid string, mediadata string, etl_dt string")
    tagged = code_tags(df, "mediadata", "usertag", social_code_map(), 5, keep=["userid", "etl_dt"])
    return flag_profile(tagged, "userid", by=["etl_dt"], source="social", update_dt="2024-01-31")


def test_overwrite_is_rerun_safe_and_touches_only_its_days(spark, tmp_path):
    prof = _profile(spark)
    path = str(tmp_path / "day")
    schema = with_partition_schema(prof, "etl_dt")
    publish(prof, path, partition_col="etl_dt")
    publish(prof, path, partition_col="etl_dt")
    assert read_published(spark, path, schema).count() == 2
    # re-publishing one day replaces only that day
    publish(prof.filter(F.col("etl_dt") == "2024-01-02").withColumn("source", F.lit("v2")), path,
            partition_col="etl_dt")
    got = rows(read_published(spark, path, schema).select("etl_dt", "source"))
    assert got == [("2024-01-01", "social"), ("2024-01-02", "v2")]


def test_static_month_partition_append_and_create(spark, tmp_path):
    prof = _profile(spark).drop("etl_dt")
    path = str(tmp_path / "month")
    publish(prof, path, "append", partition_col="etl_month", partition_value="2024-01")
    publish(prof, path, "append", partition_col="etl_month", partition_value="2024-01")
    schema = with_partition_schema(prof, "etl_month")
    assert read_published(spark, path, schema, "etl_month", ["2024-01"]).count() == 4
    create = str(tmp_path / "created")
    publish(prof, create, "create")
    with pytest.raises(Exception):
        publish(prof, create, "create")


def test_streaming_refresh_picks_up_late_files(spark, tmp_path):
    log_dir = tmp_path / "log"
    schema = "userid string, mediadata string, ts timestamp_ntz"

    def write(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(log_dir))

    def build(log):
        dated = log.withColumn("etl_dt", F.date_format(F.to_date("ts"), "yyyy-MM-dd"))
        tagged = code_tags(dated, "mediadata", "usertag", social_code_map(), 5, keep=["userid", "etl_dt"])
        return flag_profile(tagged, "userid", by=["etl_dt"])

    d1, d2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 10)
    write("f1", [("u1", '{"usertag":"10001"}', d1), ("u2", '{"usertag":"10002"}', d2)])
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    st = spark.createDataFrame([], schema).schema
    refresh_day_profiles(spark, str(log_dir), st, build, sink, ckpt, glob="*.parquet")
    # a late file for day 1 only changes day 1
    write("f2", [("u1", '{"usertag":"10003"}', d1)])
    refresh_day_profiles(spark, str(log_dir), st, build, sink, ckpt, glob="*.parquet")
    full = build(spark.read.schema(st).parquet(str(log_dir)))
    got = (read_published(spark, sink, with_partition_schema(full, "etl_dt"))
           .select("userid", "etl_dt", "game", "car", "tourism"))
    expect = full.select("userid", "etl_dt", "game", "car", "tourism")
    assert rows(got) == rows(expect)
    assert ("u1", "2024-01-01", 1, 0, 1) in rows(got)


def test_closed_day_profiles_emit_finished_days(spark, tmp_path):
    log_dir = tmp_path / "log"
    schema = "userid string, tag string, ts timestamp_ntz"
    data = [("u1", "game", dt.datetime(2024, 1, 1, 10)), ("u1", "car", dt.datetime(2024, 1, 1, 11)),
            ("u2", "car", dt.datetime(2024, 1, 2, 9)), ("u3", "game", dt.datetime(2024, 1, 5, 9))]
    spark.createDataFrame(data, schema).write.parquet(str(log_dir))
    st = spark.createDataFrame([], schema).schema
    stream = spark.readStream.schema(st).parquet(str(log_dir))
    q = (closed_day_profiles(stream).writeStream.format("memory").queryName("closed_days")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = rows(spark.sql("SELECT userid, etl_dt, game, car FROM closed_days"))
    # days 1 and 2 are closed by the watermark (max ts minus one day); day 5 is still open
    assert got == [("u1", "2024-01-01", 1, 1), ("u2", "2024-01-02", 0, 1)]


def test_read_log_prunes_day_partitions(spark, tmp_path):
    from profilekit.sources.tables import read_log
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("u1", "m", "2024-01-01"), ("u2", "m", "2024-01-02")],
                               "userid string, mediadata string, etl_dt string")
    df.write.partitionBy("etl_dt").parquet(path)
    log = read_log(spark, path).filter(F.col("etl_dt") == "2024-01-02")
    plan = plan_text(log, "simple")
    assert "PartitionFilters: [isnotnull(etl_dt" in plan
    assert [r["userid"] for r in log.collect()] == ["u2"]


def test_closed_days_do_not_depend_on_session_time_zone(spark, tmp_path):
    log_dir = tmp_path / "log"
    schema = "userid string, tag string, ts timestamp_ntz"
    data = [("u1", "game", dt.datetime(2024, 1, 1, 23, 30)), ("u2", "car", dt.datetime(2024, 1, 2, 0, 30)),
            ("u3", "game", dt.datetime(2024, 1, 5, 9))]
    spark.createDataFrame(data, schema).write.parquet(str(log_dir))
    st = spark.createDataFrame([], schema).schema
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        stream = spark.readStream.schema(st).parquet(str(log_dir))
        q = (closed_day_profiles(stream).writeStream.format("memory").queryName("closed_tz")
             .outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start())
        q.processAllAvailable()
        q.stop()
        got = rows(spark.sql("SELECT userid, etl_dt FROM closed_tz"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [("u1", "2024-01-01"), ("u2", "2024-01-02")]


def test_streaming_id_match_dedups_across_micro_batches(spark, tmp_path):
    from profilekit.streaming.matching import stream_matched_ids

    log_dir = tmp_path / "log"
    schema = "userid string, mediadata string, channel string, ts timestamp_ntz, etl_dt string"
    st = spark.createDataFrame([], schema).schema
    ids = spark.createDataFrame([("123456789012345",)], "imei_match string")
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ck")

    def run():
        stream = spark.readStream.schema(st).parquet(str(log_dir))
        m = stream_matched_ids(stream, ids, "2024-01-31", 1, 1, 3, channel="view")
        q = (m.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start(sink))
        q.awaitTermination()

    def write(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(log_dir))

    uid = "123456789012345"
    write([(uid, "m1", "view", dt.datetime(2024, 1, 30, 8), "2024-01-30"),
           (uid, "m1", "click", dt.datetime(2024, 1, 30, 9), "2024-01-30")])
    run()
    # the same payload again on the same day, plus a new one: only the new one is added
    write([(uid, "m1", "view", dt.datetime(2024, 1, 30, 20), "2024-01-30"),
           (uid, "m2", "view", dt.datetime(2024, 1, 30, 21), "2024-01-30"),
           ("999999999999999", "m3", "view", dt.datetime(2024, 1, 30, 22), "2024-01-30")])
    run()
    got = rows(spark.read.parquet(sink).select("imei_match", "mediadata", "window_start"))
    assert got == [(uid, "m1", "2024-01-30"), (uid, "m2", "2024-01-30")]


def test_streaming_refresh_on_a_day_partitioned_log(spark, tmp_path):
    log_dir = tmp_path / "log"
    schema = "userid string, mediadata string, ts timestamp_ntz, etl_dt string"

    def write(data):
        spark.createDataFrame(data, schema).write.mode("append").partitionBy("etl_dt").parquet(str(log_dir))

    def build(log):
        tagged = code_tags(log, "mediadata", "usertag", social_code_map(), 5, keep=["userid", "etl_dt"])
        return flag_profile(tagged, "userid", by=["etl_dt"])

    write([("u1", '{"usertag":"10001"}', dt.datetime(2024, 1, 1, 1), "2024-01-01"),
           ("u2", '{"usertag":"10002"}', dt.datetime(2024, 1, 2, 1), "2024-01-02")])
    st = spark.createDataFrame([], schema).schema  # the day partition stays text
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    refresh_day_profiles(spark, str(log_dir), st, build, sink, ckpt, partition_col="etl_dt")
    write([("u1", '{"usertag":"10003"}', dt.datetime(2024, 1, 1, 5), "2024-01-01")])
    refresh_day_profiles(spark, str(log_dir), st, build, sink, ckpt, partition_col="etl_dt")
    full = build(spark.read.schema(st).parquet(str(log_dir)))
    got = read_published(spark, sink, with_partition_schema(full, "etl_dt")).select("userid", "etl_dt", "game",
                                                                                    "car", "tourism")
    assert rows(got) == rows(full.select("userid", "etl_dt", "game", "car", "tourism"))
    assert ("u1", "2024-01-01", 1, 0, 1) in rows(got)


def test_read_log_keeps_a_text_day_with_a_schema_and_files_are_bounded(spark, tmp_path):
    import glob

    from profilekit.sources.tables import read_log

    path = str(tmp_path / "log")
    df = spark.createDataFrame([(f"u{i}", "m", "2024-01-01") for i in range(10)],
                               "userid string, mediadata string, etl_dt string")
    publish(df, path, partition_col="etl_dt", max_records_per_file=3)
    assert len(glob.glob(path + "/etl_dt=2024-01-01/*.parquet")) >= 4
    typed = read_log(spark, path, schema=df.schema)
    assert dict(typed.dtypes)["etl_dt"] == "string"
    assert typed.filter(F.col("etl_dt") == "2024-01-01").count() == 10


def test_streaming_id_match_takes_files_out_of_day_order(spark, tmp_path):
    from profilekit.operators.matching import match_ids
    from profilekit.streaming.matching import stream_matched_ids

    log_dir, sink, ckpt = tmp_path / "log", str(tmp_path / "sink"), str(tmp_path / "ck")
    schema = "userid string, mediadata string, channel string, ts timestamp_ntz, etl_dt string"
    st = spark.createDataFrame([], schema).schema
    ids = spark.createDataFrame([("u",)], "imei_match string")
    for day in (30, 23, 27):
        data = [("u", f"m{day}", "view", dt.datetime(2024, 1, day, 8), f"2024-01-{day}")]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(log_dir))
        stream = stream_matched_ids(spark.readStream.schema(st).parquet(str(log_dir)), ids, "2024-01-31", 1, 1, 10)
        (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(sink).awaitTermination())
    batch = match_ids(ids, spark.read.schema(st).parquet(str(log_dir)), "2024-01-31", 1, 1, 10)
    assert rows(spark.read.parquet(sink).select(batch.columns)) == rows(batch) and batch.count() == 3
