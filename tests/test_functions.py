"""Column functions on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from profilekit.functions import (
    code_list,
    day_string,
    days_ago,
    has_text,
    id_length,
    json_field,
    list_item,
    md5_id,
    valid_tag,
)
from profilekit.operators.profile import flag_profile
from profilekit.operators.tagging import dict_tags
from tests.conftest import rows


def test_json_field_never_fails(spark):
    df = spark.createDataFrame([('{"a":"x","n":7,"z":null}',), ("{bad",), (None,), ('{"a":["p","q"]}',)], "j string")
    got = [tuple(r) for r in df.select(json_field("j", "a"), json_field("j", "n"), json_field("j", "z")).collect()]
    assert got == [("x", "7", None), (None, None, None), (None, None, None), ('["p","q"]', None, None)]


def test_list_item_out_of_range_is_null(spark):
    df = spark.createDataFrame([("k,1,2",), ("k",), ("a,,b,",)], "s string")
    got = [tuple(r) for r in df.select(list_item("s", 0), list_item("s", 2), F.size(code_list("s"))).collect()]
    assert got == [("k", "2", 3), ("k", None, 1), ("a", "b", 4)]  # inner and trailing empty items kept


def test_text_and_tag_predicates(spark):
    df = spark.createDataFrame([("x",), ("",), (None,), ("null",)], "t string")
    assert [r[0] for r in df.filter(has_text("t")).collect()] == ["x", "null"]
    assert [r[0] for r in df.filter(valid_tag("t")).collect()] == ["x"]


def test_id_rules_and_md5(spark):
    df = spark.createDataFrame([("123456789012345",), ("12345",), ("a" * 32,)], "id string")
    assert df.filter(id_length("id", "=", 15)).count() == 1
    assert df.filter(id_length("id", ">", 5)).count() == 2
    assert df.filter(id_length("id", "=", 32)).count() == 1
    assert df.select(md5_id(F.lit("abc"))).first()[0] == "900150983cd24fb0d6963f7d28e17f72"
    assert df.select(md5_id(F.lit(123))).first()[0] == "202cb962ac59075b964b07152d234b70"  # md5("123")


def test_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59),)], "ts timestamp_ntz")
    got = df.select(day_string("ts"), days_ago("2024-01-31", 30).cast("string"), days_ago("2024-03-01", 1)
                    .cast("string")).first()
    assert tuple(got) == ("2024-01-31", "2024-01-01", "2024-02-29")


def test_distinct_before_dictionary_profile_changes_nothing(spark):
    log = spark.createDataFrame([("u", "a"), ("u", "a"), ("u", "b"), ("v", "b")], "userid string, appname string")
    d = spark.createDataFrame([("a", "game"), ("b", "car")], "key string, tag string")
    plain = flag_profile(dict_tags(log, "appname", d, keep=["userid"]), "userid")
    dedup = flag_profile(dict_tags(log.distinct(), "appname", d, keep=["userid"]).distinct(), "userid")
    assert rows(plain) == rows(dedup)


def test_separators_and_json_keys_are_literal(spark):
    df = spark.createDataFrame([("a.b|c", '{"a.b":"x","a":{"b":"y"}}')], "t string, j string")
    got = df.select(code_list("t", "."), code_list("t", "|"), json_field("j", "a.b"), json_field("j", "a")).first()
    assert list(got) == [["a", "b|c"], ["a.b", "c"], "x", '{"b":"y"}']
