"""Importance resampling against its SQL and a plain version."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np

from profilekit.llm import importance, queries

SF = "/root/testdata/sf0.01"


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [zlib.crc32(" ".join(words[i:i + n]).encode()) % importance.BUCKETS
                   for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=importance.PERCENT, least=importance.LEAST_WORDS):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows, in order."""
    s, t = [0] * importance.BUCKETS, [0] * importance.BUCKETS
    for table, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for b in features(x)[1]:
                table[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + len(s)) / ((x + 1) * (sum(t) + len(t))))) for x, y in zip(s, t)]
    rows = []
    for i, x in docs:
        words, found = features(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words) >= least])
    pool = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(pool[:percent * len(pool) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in rows]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_hashed_runs_equal_the_library():
    rng = np.random.default_rng(3)
    texts = ["", "a", "x" * 47 + " y", "x" * 48 + " b c", "x" * 49 + " y z", "é中文 Straße " + "q" * 300 + " ab1", "!!", "a-b_c D9 \x00 e"]
    texts += [" ".join("".join(rng.choice(list("abcXYZ019é"), rng.integers(1, 60))) for _ in range(40)) for _ in range(30)]
    for x in texts:
        n, got = importance.buckets_of(x.encode())
        words, want = features(x)
        assert (n, got.tolist()) == (len(words), want)
    assert importance.buckets_of(None)[0] == 0


def test_ties_repeats_nulls_and_extra_columns(spark, nasty, no_docs):
    target = spark.createDataFrame([("one two three",), (None,)], "text string")
    got = importance.resample(nasty, target, percent=50, least_words=4)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = [(r.doc_id, r.text) for r in nasty.select("doc_id", "text").collect()]
    assert ordered(got.collect()) == ordered(brute(rows, ["one two three", None], 50, 4))
    assert importance.resample(no_docs, target).collect() == []
    assert all(r["rank"] is None for r in importance.resample(nasty, target, least_words=10**6).collect())
    assert importance.resample(nasty, target.limit(0)).count() == nasty.count()


def test_many_rows_of_one_score_are_cut_by_id(spark):
    """A third of the rows share id and text, others tie on the score: the draw is exact and every rank is given once."""
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(7, text)] * 300 + [(i, text + f" u{i % 5}") for i in range(100, 700)]
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
                              spark.createDataFrame([("w1 w2 u3",)], "text string"), percent=30).collect()
    assert ordered(got) == ordered(brute(docs, ["w1 w2 u3"], 30))
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 271))


def test_cutoff_by_counts_equals_a_sort(spark):
    rng = np.random.default_rng(4)
    values = [int(x) for x in rng.integers(-10**12, 10**12, 500)] + [5] * 100 + [-(1 << 63), (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    down = sorted(values, reverse=True)
    for wanted in (1, 2, 77, 300, len(values)):
        cut, above = importance._cutoff(df, "v", min(values), max(values), wanted)
        assert cut == down[wanted - 1] and above == sum(v > cut for v in values)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for n in ("documents", "benchmark"):
        con.execute(f"create view {n} as select * from '{SF}/{n}.parquet'")
    got = ordered(queries.QUERIES["op11_importance_resampling"](spark, SF).collect())
    assert got == ordered(con.execute(queries.SQL["op11_importance_resampling"]).fetchall())
    assert sum(r[4] is not None for r in got) > 10
