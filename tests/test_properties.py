"""Property tests: random small inputs against brute force."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from profilekit.operators import evaluate as E
from profilekit.operators.profile import score_profile
from tests.brute import score_profile_plain

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

examples = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1), st.integers(0, 6)), min_size=1, max_size=60)


@SETTINGS
@given(examples)
def test_auc_equals_pair_count(spark, data):
    df = spark.createDataFrame([(r, y, s / 6.0) for r, y, s in data], "run int, y int, p double")
    got = {r["run"]: r["auc"] for r in E.auc(df, "run", "y", "p").collect()}
    for run in {r for r, _, _ in data}:
        pos = [s for r, y, s in data if r == run and y == 1]
        neg = [s for r, y, s in data if r == run and y == 0]
        if not pos or not neg:
            assert got[run] is None
            continue
        pairs = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
        assert math.isclose(got[run], pairs / (len(pos) * len(neg)), rel_tol=0, abs_tol=1e-12)


pairs_st = st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("wxyz")), min_size=1, max_size=20)
dict_st = st.lists(st.tuples(st.sampled_from("wxyz"), st.one_of(st.none(), st.integers(0, 120))),
                   min_size=1, max_size=10)


@SETTINGS
@given(pairs_st, dict_st)
def test_score_profile_equals_join_then_avg(spark, pairs, scores):
    p = spark.createDataFrame(pairs, "userid string, mediadata string")
    s = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in scores],
                              "yktag string, entertainment double")
    fast = {r["userid"]: r["entertainment"]
            for r in score_profile(p, s, "mediadata", "yktag", score_cols=["entertainment"]).collect()}
    plain = {r["userid"]: r["entertainment"]
             for r in score_profile_plain(p, s, "mediadata", "yktag", score_cols=["entertainment"]).collect()}
    assert fast.keys() == plain.keys()
    for u in fast:
        a, b = fast[u], plain[u]
        assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-12)


days_st = st.lists(st.integers(0, 40), min_size=1, max_size=30)


@SETTINGS
@given(days_st, st.integers(0, 3), st.integers(1, 3), st.integers(1, 6))
def test_day_windows_match_brute_force(spark, back, nearest, width, count):
    import datetime as dt

    from profilekit.operators.extract import day_windows

    as_of = dt.date(2024, 2, 10)
    days = [(as_of - dt.timedelta(days=b)).isoformat() for b in back]
    df = spark.createDataFrame([(d,) for d in days], "etl_dt string")
    got = sorted((r["etl_dt"], r["window_start"], r["window_end"])
                 for r in day_windows(df, as_of, nearest, width, count).collect())
    want = []
    for d, b in zip(days, back):
        for w in range(count):
            lo, hi = nearest + w * width, nearest + w * width + width - 1  # days back, both ends included
            if lo <= b <= hi:
                want.append((d, (as_of - dt.timedelta(days=hi)).isoformat(), (as_of - dt.timedelta(days=lo)).isoformat()))
    assert got == sorted(want)


big_st = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=40)
small_st = st.lists(st.tuples(st.integers(0, 7), st.sampled_from("abc")), min_size=0, max_size=10)
hot_st = st.dictionaries(st.integers(0, 7), st.floats(0.01, 1.0), max_size=4)


@SETTINGS
@given(big_st, small_st, hot_st, st.sampled_from(["inner", "left"]))
def test_salted_join_equals_plain_join(spark, big, small, hot, how):
    from profilekit.operators.joins import salted_join

    b = spark.createDataFrame(big, "k int, v int")
    s = spark.createDataFrame(small, "sk int, name string")
    cols = ["k", "v", "sk", "name"]
    plain = sorted(map(tuple, b.join(s, b["k"] == s["sk"], how).select(*cols).collect()), key=str)
    salted = sorted(map(tuple, salted_join(b, s, "k", "sk", how, hot=hot).select(*cols).collect()), key=str)
    assert salted == plain
