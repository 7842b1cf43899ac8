"""Every registered query against its DuckDB SQL on the driver's tables (sf0.01).

Rows are compared as multisets of values after sorting columns by name, the
way the driver compares them.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from profilekit.plans.catalog import QUERIES
from profilekit.sources.tables import TABLES

SF_DIR = os.environ.get("PROFILEKIT_ORACLE_DIR", "/root/testdata/sf0.01")
NAMES = sorted(QUERIES)


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return str(v)


def _canon(pdf):
    cols = sorted(pdf.columns)
    data = sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                  key=lambda t: tuple("" if x is None else x for x in t))
    return cols, data


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = _canon(entry.queries()[name](spark, SF_DIR).toPandas())
    want = _canon(duck.execute(entry.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "userid" and df.columns[-2:] == ["source", "update_dt"]


@pytest.mark.parametrize("name", ["extract_payloads", "trailing_days", "code_profile_day", "match_ids_2d",
                                  "score_profile_day"])
def test_day_logic_independent_of_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = _canon(entry.queries()[name](spark, SF_DIR).toPandas())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = _canon(duck.execute(entry.oracle_sql()[name]).df())
    assert got == want


FORCED = ["dict_profile", "dict_profile_day", "score_profile", "matched_score_profile", "match_ids_1d",
          "id_coverage", "id_coverage_md5", "match_titles", "matched_payloads", "auc_logloss",
          "match_titles_short"]


@pytest.mark.parametrize("name", FORCED)
def test_query_matches_oracle_without_broadcasts(spark, duck, name, monkeypatch):
    """Every checked join takes the shuffle path, salting the three heaviest keys; automata are sharded."""
    from profilekit.operators import joins, substring
    from pyspark.sql import functions as F

    def top_keys(df, key, **_):
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(3)
        return {r[key]: 0.3 for r in counts.collect() if r[key] is not None}

    monkeypatch.setattr(joins, "DEFAULT_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "hot_keys", top_keys)
    monkeypatch.setattr(joins, "hot_share", lambda spark: 0.01)
    monkeypatch.setattr(substring, "MAX_KEYS", 7)
    got = _canon(entry.queries()[name](spark, SF_DIR).toPandas())
    want = _canon(duck.execute(entry.oracle_sql()[name]).df())
    assert got == want
