"""Substring dictionary match (all three forms vs brute force), id matching, id coverage."""

import random

import pytest

from profilekit.functions.columns import id_length
from profilekit.operators import substring
from profilekit.operators.matching import id_coverage, mapped_users, match_ids, match_titles
from profilekit.operators.substring import first_key_match
from tests.brute import contains_match
from tests.conftest import plan_text, rows

KEYS = [("star wars", 1), ("wars", 2), ("star", 3), ("", 0), ("trek", 4), ("wars", 5)]
TEXTS = ["watch star wars now", "star trek", "nothing here", "trek wars", '{"title":"Star"}', "ababab", None]


def brute(texts, keys):
    clean = {}
    for k, p in keys:
        if k:
            clean[k] = min(p, clean.get(k, p))
    out = {}
    for t in set(x for x in texts if x is not None):
        hits = [(p, k) for k, p in clean.items() if k in t]
        if hits:
            p, k = min(hits)
            out[t] = (k, p)
    return out


def _as_dict(df):
    return {r["text"]: (r["key"], r["priority"]) for r in df.collect()}


@pytest.mark.parametrize("method", ["automaton", "ngram", "contains"])
def test_first_key_match_semantics(spark, method):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "mediadata string")
    keys = spark.createDataFrame(KEYS, "iqytag string, priority long")
    if method == "contains":
        got = _as_dict(contains_match(texts, "mediadata", keys, "iqytag", "priority"))
    else:
        got = _as_dict(first_key_match(texts, "mediadata", keys, "iqytag", "priority", method))
    assert got == brute(TEXTS, KEYS)
    # first in file order wins, even over a longer key that also occurs
    assert got["watch star wars now"] == ("star wars", 1)
    assert got["trek wars"] == ("wars", 2)
    assert "nothing here" not in got
    assert '{"title":"Star"}' not in got  # case-sensitive


@pytest.mark.parametrize("method", ["automaton", "ngram"])
def test_first_key_match_random_vs_brute(spark, method):
    rnd = random.Random(7)
    alphabet = "abcé😀 "
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    keys = list({("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 4))), i) for i in range(60)})
    tdf = spark.createDataFrame([(t,) for t in texts], "t string")
    kdf = spark.createDataFrame(keys, "k string, p long")
    assert _as_dict(first_key_match(tdf, "t", kdf, "k", "p", method)) == brute(texts, keys)


def test_larger_key_list_equals_single(spark, monkeypatch):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("xyz") for _ in range(40)) for _ in range(100)]
    keys = [("".join(rnd.choice("xyz") for _ in range(5)), i) for i in range(200)]
    tdf = spark.createDataFrame([(t,) for t in texts], "t string")
    kdf = spark.createDataFrame(keys, "k string, p long")
    single = _as_dict(first_key_match(tdf, "t", kdf, "k", "p"))
    monkeypatch.setattr(substring, "MAX_KEYS", 17)
    larger = _as_dict(first_key_match(tdf, "t", kdf, "k", "p"))
    assert single == larger == brute(texts, keys)


def test_match_titles_fans_out_repeated_key(spark):
    texts = spark.createDataFrame([("see alpha",), ("see beta",)], "mediadata string")
    d = spark.createDataFrame([("alpha", 1, 10.0), ("beta", 2, 20.0), ("alpha", 3, 30.0)],
                              "iqytag string, priority long, entertainment double")
    out = match_titles(texts, d, score_cols=["entertainment"])
    assert rows(out) == [("see alpha", "alpha", 10.0), ("see alpha", "alpha", 30.0),
                         ("see beta", "beta", 20.0)]


def _log(spark, data):
    return spark.createDataFrame(data, "userid string, mediadata string, channel string, etl_dt string")


def test_match_ids_windows(spark):
    # as_of 2024-01-31: 2024-01-29 and -30 are 2 and 1 days back
    log = _log(spark, [
        ("123456789012345", "m1", "view", "2024-01-30"),
        ("123456789012345", "m1", "view", "2024-01-29"),   # same payload next day
        ("123456789012345", "m2", "view", "2024-01-29"),
        ("123456789012345", "m3", "click", "2024-01-30"),  # other channel
        ("1234", "m1", "view", "2024-01-30"),              # wrong id length
        ("999999999999999", "m1", "view", "2024-01-30"),   # not listed
    ])
    ids = spark.createDataFrame([("123456789012345",), ("123456789012345",), ("1234",)], "imei_match string")
    rule = id_length("userid", "=", 15)
    one = match_ids(ids, log, "2024-01-31", 1, 1, 2, channel="view", id_rule=rule)
    # two one-day windows x (m1 on both days, m2 on one) x id listed twice
    assert one.count() == 2 * 3
    two = match_ids(ids, log, "2024-01-31", 1, 2, 1, channel="view", id_rule=rule)
    # one two-day window: m1 counted once across both days, m2 once; id listed twice
    got = rows(two.select("mediadata", "window_start", "window_end"))
    assert got == [("m1", "2024-01-29", "2024-01-30")] * 2 + [("m2", "2024-01-29", "2024-01-30")] * 2


def test_id_coverage_and_md5(spark):
    ids = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "imei_match string")
    mapping = spark.createDataFrame([("a", "imei"), ("a", "imei"), ("b", "idfa"), ("c", "imei")],
                                    "idfa_imei string, app_flag string")
    cov = rows(id_coverage(ids, mapping))
    assert cov == [("a", "a"), ("a", "a"), ("b", None), ("c", "c")]
    users = spark.createDataFrame([("0cc175b9c0f1b6a831c399e269772661",), ("zzz",)], "userid string")  # md5('a')
    got = mapped_users(users, mapping, hashed=True)
    assert rows(got) == [("0cc175b9c0f1b6a831c399e269772661", "a", "0cc175b9c0f1b6a831c399e269772661")] * 2
    long_id = "f" * 32
    mapping2 = mapping.unionByName(spark.createDataFrame([(long_id, "imei")], "idfa_imei string, app_flag string"))
    plain = mapped_users(spark.createDataFrame([("c",), (long_id,)], "userid string"), mapping2, hashed=False)
    # plain join, then the original rule: the mapping id must have 32 characters
    assert [r[0] for r in rows(plain)] == [long_id]
    optimized = plan_text(got, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "LeftOuter" not in optimized  # the length rule on the right side makes it an inner join


def test_read_id_list_keeps_repeats(spark, tmp_path):
    from profilekit.sources.files import read_id_list
    f = tmp_path / "ids.txt"
    f.write_text("111\n222\n111\n")
    assert rows(read_id_list(spark, str(f))) == [("111",), ("111",), ("222",)]


def test_match_titles_require_field_filters_on_parsed_title(spark):
    texts = spark.createDataFrame([('{"title":"alpha one"}',), ('{"title":"","x":"alpha"}',), ("alpha",)],
                                  "mediadata string")
    d = spark.createDataFrame([("alpha", 1, 1.0)], "iqytag string, priority long, entertainment double")
    out = match_titles(texts, d, score_cols=["entertainment"], require_field="title")
    # the key is searched in the whole payload, but only payloads with a title take part
    assert rows(out) == [('{"title":"alpha one"}', "alpha", 1.0)]


def test_equal_priorities_take_the_smallest_key_in_every_form(spark, monkeypatch):
    tdf = spark.createDataFrame([("bb aa cc",), ("cc bb",)], "t string")
    kdf = spark.createDataFrame([("bb", 1), ("aa", 1), ("cc", 1)], "k string, p long")
    want = {"bb aa cc": "aa", "cc bb": "bb"}
    found = [_as_dict(first_key_match(tdf, "t", kdf, "k", "p", m)) for m in ("automaton", "ngram")]
    monkeypatch.setattr(substring, "MAX_KEYS", 1)
    found.append(_as_dict(first_key_match(tdf, "t", kdf, "k", "p")))
    for got in found:
        assert {t: (k[0] if isinstance(k, tuple) else k) for t, k in got.items()} == want


def test_no_keys_match_nothing(spark):
    tdf = spark.createDataFrame([("a",)], "t string")
    for method in ("automaton", "ngram"):
        assert first_key_match(tdf, "t", spark.createDataFrame([], "k string, p long"), "k", "p", method).count() == 0


def test_listed_ids_are_kept_before_the_shuffle(spark):
    log = spark.createDataFrame([("1", "x", "view", "2024-01-30"), ("2", "x", "view", "2024-01-30")],
                                "userid string, mediadata string, channel string, etl_dt string")
    ids = spark.createDataFrame([("1",), ("1",)], "imei_match string")
    out = match_ids(ids, log, "2024-01-31", 1, 1, 3)
    assert [r["imei"] for r in out.collect()] == ["1", "1"]
    plan = plan_text(out, "simple")
    assert plan.index("HashAggregate") < plan.index("LeftSemi")  # printed from the top: the semi join is below
