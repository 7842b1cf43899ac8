"""The conversation trie against its SQL and a plain trie."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from profilekit.llm import conversation_trie as trie
from profilekit.llm import queries

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Nodes of (conv_id, turn, role, text) rows, by a dictionary of whole prefixes."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % trie.OPENING
        base = c - int(np.fmod(c, trie.FAMILY))
        path = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    below = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        below[p] = (sum(below[k][0] for k in kids[p]) or 1, own + sum(below[k][1] for k in kids[p]))
    return ordered((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), *below[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def soup(seed, n, deep):
    """Conversations over a small alphabet of turns: many common openings, copies and prefixes of one another."""
    rng, rows = random.Random(seed), []
    for _ in range(n):
        c = rng.randrange(-150, 400)
        size = rng.choice((1, 2, 3, 5, 8, deep))
        rows += [(c, t, rng.choice(("u", "a", None)) if rng.random() < 0.1 else "u", "x" * rng.choice((0, 1, 1, 1, 1, 2))) for t in range(size)]
    return rows


@pytest.mark.parametrize("levels,run_rows", [(16, 20_000), (2, 20_000), (3, 60), (2, 0)])
def test_equals_a_plain_trie(spark, levels, run_rows):
    rows = soup(levels, 80, 30)
    rows += [(c, t, "u", f"same {t}") for c in (700, 701, 702, 750) for t in range(24)]
    got = trie.prefix_trie(frame(spark, rows).repartition(5), levels=levels, run_rows=run_rows)
    assert got.columns == COLUMNS
    assert ordered(got.collect()) == brute(rows)


def test_conversation_over_many_partitions(spark):
    """One conversation with most of the rows lies in several range partitions; its sums are carried on."""
    rows = [(200, t, "u", f"t{t}") for t in range(3000)] + [(c, t, "u", f"t{t}") for c in range(201, 230) for t in range(6)]
    turns = trie.numbered_turns(frame(spark, rows)).toPandas()
    whole = {}
    for (c, t), part in turns.groupby(["conv_id", "place"]):
        whole.setdefault(t, set()).add((part.a.iloc[0], part.b.iloc[0]))
        assert len(part) == 1
    assert all(len(whole[t]) == 1 for t in range(6))  # equal beginnings have equal sums
    assert len({x for s in whole.values() for x in s}) == 3000
    assert ordered(trie.prefix_trie(frame(spark, rows)).collect()) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, 0, "u", "lost"), (5, None, None, None), (5, 0, "u", "a"), (5, 0, "u", "a"), (5, 0, "u", "b"), (5, 1, None, ""),
            (100, 0, "u", "b" * 100_000), (101, 0, "u", "z"), (102, 0, "u", "q"), (199, 3, "ab", "c"), (198, 3, "a", "bc"),
            (-7, 1, "u", "neg"), (9_007_199_254_740_993, 0, "u", "far"), (9_007_199_254_740_992, 0, "u", "far")]
    df = frame(spark, rows).selectExpr("*", "1 as depth", "2 as rep", "'x' as `a.b`", "3 as a", "4 as path")
    assert ordered(trie.prefix_trie(df).collect()) == brute(rows)
    assert trie.prefix_trie(frame(spark, [])).collect() == []
    assert trie.prefix_trie(frame(spark, [(None, 1, "u", "x")])).collect() == []
    short = [(c, 0, "u", "x") for c in range(1, 40)]  # without a base, those that lose their only turn end at the root
    got = ordered(trie.prefix_trie(frame(spark, short)).collect())
    assert got == brute(short) and any(r[1] == 0 and r[7] != trie._EMPTY for r in got)


def test_runs_cover_every_level_once():
    rng = random.Random(1)
    for _ in range(300):
        deepest, levels, most = rng.randrange(0, 400), rng.choice((1, 3, 16)), rng.choice((0, 5, 50, 10**6))
        width = rng.choice((1, 2, 7))
        counts = {k: rng.choice((0, 1, 4, 30, 100)) for k in range(400)}
        runs = trie.runs_of(counts, width, deepest, levels, most)
        assert [x for low, high, _ in runs for x in range(high, low, -1)] == list(range(deepest, 0, -1))
        assert all(few or high - low <= levels for low, high, few in runs)


def test_powers_wrap():
    n = np.array([-5, 0, 1, 7, 1000])
    base = trie._BASES[0]
    assert trie._powers(base, n).tolist() == [pow(base, int(k), 1 << 64) for k in n]


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    got = ordered(queries.QUERIES["op13_conversation_trie"](spark, SF).collect())
    assert got == ordered(con.execute(queries.SQL["op13_conversation_trie"]).fetchall())
    assert got == brute(spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect())
