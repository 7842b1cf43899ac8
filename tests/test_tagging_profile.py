"""Coded-tag and dictionary-tag profiles on hand-made frames (synthetic ids)."""

import pytest

from pyspark.sql import functions as F

from profilekit.operators.profile import (
    flag_pivot,
    flag_profile,
    flag_profile_columns,
    score_profile,
)
from profilekit.operators.tagging import code_tags, dict_tags, last_value_per_key
from profilekit.sources.files import read_pair_dictionary, read_scored_dictionary
from profilekit.vocab import INTERESTS, social_code_map
from tests.conftest import rows
from tests.brute import score_profile_plain

PAYLOADS = [
    ("u1", '{"usertag":"10001,10002"}'),      # two mapped codes
    ("u2", '{"usertag":"99999"}'),            # unmapped 5-character code: kept, all zero
    ("u3", '{"usertag":"1234"}'),             # 4-character code: removed
    ("u4", '{"usertag":""}'),                 # empty list: removed
    ("u5", '{"other":"10001"}'),              # missing key: removed
    ("u6", "not json"),                       # malformed: removed, no failure
    ("u7", None),                             # NULL payload: removed
    ("u8", '{"usertag":"10003,"}'),           # trailing comma: empty item removed
    ("u9", '{"usertag":"10004, 10005"}'),     # leading blank makes 6 characters: removed
    ("u10", '{"usertag":[10001,10002]}'),     # a JSON list is not a comma string
    ("u11", '{"usertag":"10010,10011"}'),     # many-to-one codes
]


def _flags(row):
    return {t: row[t] for t in INTERESTS if row[t]}


def test_code_profile_semantics(spark):
    df = spark.createDataFrame(PAYLOADS, "userid string, mediadata string")
    tagged = code_tags(df, "mediadata", "usertag", social_code_map(), 5, keep=["userid"])
    prof = {r["userid"]: r for r in flag_profile(tagged, "userid", source="social", update_dt="2024-01-31").collect()}
    assert set(prof) == {"u1", "u2", "u8", "u9", "u11"}
    assert _flags(prof["u1"]) == {"game": 1, "car": 1}
    assert _flags(prof["u2"]) == {}
    assert _flags(prof["u8"]) == {"tourism": 1}
    assert _flags(prof["u9"]) == {"lifestyle": 1}
    assert _flags(prof["u11"]) == {"education": 1}
    assert prof["u1"]["source"] == "social" and prof["u1"]["update_dt"] == "2024-01-31"
    # column order: user, 21 interests, source, update date
    assert flag_profile(tagged, "userid", source="s", update_dt="d").columns == \
        ["userid", *INTERESTS, "source", "update_dt"]


def test_code_map_as_dataframe_equals_literal(spark):
    df = spark.createDataFrame(PAYLOADS, "userid string, mediadata string")
    lit_tags = code_tags(df, "mediadata", "usertag", social_code_map(), 5, keep=["userid"])
    cmap = spark.createDataFrame(social_code_map(), "code string, tag string")
    df_tags = code_tags(df, "mediadata", "usertag", cmap, 5, keep=["userid"])
    assert rows(lit_tags) == rows(df_tags)


def test_flag_profile_equals_pivot(spark):
    df = spark.createDataFrame(PAYLOADS, "userid string, mediadata string")
    tagged = code_tags(df, "mediadata", "usertag", social_code_map(), 5, keep=["userid"])
    a = flag_profile(tagged, "userid")
    b = flag_pivot(tagged, "userid").select(*a.columns)
    c = flag_profile_columns(tagged, "userid").select(*a.columns)
    assert rows(a) == rows(b) == rows(c)


def test_per_day_single_pass_equals_day_by_day(spark):
    data = [("u1", '{"usertag":"10001"}', "2024-01-01"), ("u1", '{"usertag":"10002"}', "2024-01-02"),
            ("u2", '{"usertag":"10003"}', "2024-01-01"), ("u2", '{"usertag":"99999"}', "2024-01-02")]
    df = spark.createDataFrame(data, "userid string, mediadata string, etl_dt string")
    tagged = code_tags(df, "mediadata", "usertag", social_code_map(), 5, keep=["userid", "etl_dt"])
    one_pass = flag_profile(tagged, "userid", by=["etl_dt"])
    per_day = None
    for d in ("2024-01-01", "2024-01-02"):
        t = code_tags(df.filter(F.col("etl_dt") == d), "mediadata", "usertag", social_code_map(), 5,
                      keep=["userid", "etl_dt"])
        p = flag_profile(t, "userid", by=["etl_dt"])
        per_day = p if per_day is None else per_day.unionByName(p)
    assert rows(one_pass) == rows(per_day)


def test_dictionary_profile(spark, tmp_path):
    dict_file = tmp_path / "apps.tsv"
    dict_file.write_text("\n".join([
        "maps\ttourism",
        "chat\tlifestyle",
        "blank\t",
        "nulltag\tnull",
        "other\tgardening",      # outside the 21 interests
        "maps\tcar",             # repeated key: the last line wins
    ]) + "\n")
    d = read_pair_dictionary(spark, str(dict_file), key="appname", value="tag")
    assert dict(rows(d)) == {"maps": "car", "chat": "lifestyle", "blank": "", "nulltag": "null",
                             "other": "gardening"}
    log = spark.createDataFrame([("a", "maps"), ("a", "chat"), ("b", "unknown"), ("c", "blank"),
                                 ("d", "nulltag"), ("e", "other")], "userid string, appname string")
    tagged = dict_tags(log, "appname", d, keep=["userid"], dict_key="appname")
    prof = {r["userid"]: r for r in flag_profile(tagged, "userid").collect()}
    # not in the dictionary, '' and 'null' tags: no row; tag outside the domain: all-zero row
    assert set(prof) == {"a", "e"}
    assert _flags(prof["a"]) == {"car": 1, "lifestyle": 1}
    assert _flags(prof["e"]) == {}


def test_last_value_per_key(spark):
    df = spark.createDataFrame([("k", "x", 1), ("k", "y", 3), ("k", "z", 2), ("j", "w", 5)],
                               "key string, tag string, line int")
    assert rows(last_value_per_key(df, "key", "tag", ["line"])) == [("j", "w"), ("k", "y")]


def test_score_profile_semantics(spark, tmp_path):
    f = tmp_path / "scores.txt"
    f.write_text("\n".join([
        "alpha," + ",".join(str(i) for i in range(13)),
        "beta," + ",".join(["abc"] + [str(2 * i) for i in range(1, 13)]),   # non-number -> NULL
        "alpha," + ",".join(str(100) for _ in range(13)),                   # key listed twice: fans out
        "," + ",".join("1" for _ in range(13)),                              # empty key: dropped
    ]) + "\n")
    scores = read_scored_dictionary(spark, str(f))
    assert scores.count() == 3
    assert [r["priority"] for r in scores.orderBy("priority").collect()] == [1, 2, 3]
    yk = scores.select(F.col("iqytag").alias("yktag"), *INTERESTS)
    pairs = spark.createDataFrame([("u1", "alpha"), ("u1", "alpha"), ("u2", "alpha"), ("u2", "beta"),
                                   ("u3", "beta")], "userid string, mediadata string").distinct()
    fast = score_profile(pairs, yk, "mediadata", "yktag")
    plain = score_profile_plain(pairs, yk, "mediadata", "yktag")
    got = {r["userid"]: r for r in fast.collect()}
    ref = {r["userid"]: r for r in plain.collect()}
    assert set(got) == set(ref) == {"u1", "u2", "u3"}
    for u in got:
        for c in INTERESTS:
            a, b = got[u][c], ref[u][c]
            assert (a is None and b is None) or abs(a - b) < 1e-12, (u, c, a, b)
    # u1: distinct pairs -> alpha once, fanned out over its two dictionary rows
    assert abs(got["u1"]["entertainment"] - (0 + 100) / 2 / 120) < 1e-12
    # u3 has only beta, whose first score is NULL: avg of nothing is NULL
    assert got["u3"]["entertainment"] is None
    assert got["u3"]["beauty"] == 0.0


def test_dictionary_order_across_files(spark, tmp_path):
    d = tmp_path / "dict"
    d.mkdir()
    (d / "part-a.tsv").write_text("k\tfirst\nj\tonly\n")
    (d / "part-b.tsv").write_text("k\tsecond\n")
    got = dict(rows(read_pair_dictionary(spark, str(d), key="appname", value="tag")))
    assert got == {"k": "second", "j": "only"}  # file order by name, then line order
    s = tmp_path / "scores"
    s.mkdir()
    (s / "a.txt").write_text("x," + ",".join(["1"] * 13) + "\ny," + ",".join(["2"] * 13) + "\n")
    (s / "b.txt").write_text("z," + ",".join(["3"] * 13) + "\n")
    pri = {r["iqytag"]: r["priority"] for r in read_scored_dictionary(spark, str(s)).collect()}
    assert pri == {"x": 1, "y": 2, "z": 3}


def test_code_flag_profile_equals_exploded_form(spark):
    from profilekit.operators.profile import code_flag_profile

    df = spark.createDataFrame(PAYLOADS + [("u12", '{"usertag":"10001,99999,1234"}')], "userid string, mediadata string")
    exploded = flag_profile(code_tags(df, "mediadata", "usertag", social_code_map(), 5, keep=["userid"]), "userid")
    fused = code_flag_profile(df, "mediadata", "usertag", social_code_map(), 5, "userid")
    assert rows(fused) == rows(exploded.select(*fused.columns))
    empty_map = code_flag_profile(df, "mediadata", "usertag", [], 5, "userid")
    assert {r["userid"] for r in empty_map.collect()} == {r["userid"] for r in exploded.collect()}


def test_averages_are_the_same_bits_in_any_order(spark):
    """Fractional scores, shuffled rows, other partition counts: equal doubles, not only close ones."""
    import random

    from profilekit.operators.profile import score_profile

    rng = random.Random(4)
    scores = [(f"p{k % 40}", rng.uniform(-1, 1) * 10 ** rng.randrange(-6, 6), rng.random() / 3) for k in range(90)] + [("p3", None, 1.0)]
    pairs = [(f"u{rng.choice((0, 0, 0, 1, 2))}", f"p{rng.randrange(45)}") for _ in range(3000)]
    found = []
    for parts, keys in ((1, 1), (7, 3), (13, 8)):
        rng.shuffle(scores)
        rng.shuffle(pairs)
        spark.conf.set("spark.sql.shuffle.partitions", str(keys))
        try:
            df = score_profile(spark.createDataFrame(pairs, "userid string, k string").repartition(parts),
                               spark.createDataFrame(scores, "k string, a double, b double").repartition(parts), "k", "k", ["a", "b"])
            found.append(sorted((r.userid, r.a.hex(), r.b.hex()) for r in df.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1] == found[2] and len(found[0]) == 3
    with pytest.raises(Exception, match="out of range"):
        score_profile(spark.createDataFrame(pairs, "userid string, k string"),
                      spark.createDataFrame([("p1", float("nan"))], "k string, a double"), "k", "k", ["a"]).collect()
