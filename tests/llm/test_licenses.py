"""The license scan against its SQL, and against rules tried at every place of small texts."""

import random
import re

import duckdb
import pytest

from profilekit.llm import licenses, queries

SF = "/root/testdata/sf0.01"


def brute(text):
    """The scan of one text, rule by rule over the whole token line."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    line = "".join(f" {i}~{w};" for i, w in enumerate(words))
    hits, there = set(), set(words)
    for r in (r for r in licenses.rules() if r["keyword"] in there):
        for m in re.finditer(r["regex"], line):
            start = int(re.match(r" (\d+)~", m[0])[1])
            hits.add((r["order"], r["label"], r["confidence"], r["base"], start, start + m[0].count(";")))
    kept = [h for h in hits if h[3] or not any(
        not o[3] and o[0] < h[0] and o[4] <= h[4] and o[5] >= h[5] for o in hits)]
    base = [h for h in kept if h[3]]
    return (len(words), len(base), min((h[4] for h in base), default=None), max((h[4] for h in base), default=None),
            ",".join(sorted({h[1] for h in base})), ",".join(sorted({h[1] for h in kept})),
            max((h[2] for h in kept), default=0.0))


def scanned(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [tuple(r)[1:] for r in sorted(licenses.scan(df, **how).collect())]


def test_labels_of_plain_cases(spark):
    cases = {
        "Licensed under the Apache License, Version 2.0": ("", "apache-2.0", 1.0),
        "Licensed under CC BY-NC 4.0 here": ("cc-by", "cc-by,cc-by-nc-4.0", 1.0),
        "the GNU Lesser General Public License v2.1 or later": ("gpl", "gpl,lgpl-2.1-or-later", 0.9),
        "GNU Lesser General Public Licence": ("", "lgpl", 0.6),
        "Released under the MIT License. All rights reserved.": ("reserved", "mit,reserved", 0.8),
        "SPDX-License-Identifier: GPL-2.0": ("", "gpl-2.0", 1.0),
        "wir gehen mit dem Hund": ("", "", 0.0),
        "All rights are reserved": ("", "", 0.0),
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3": ("gpl", "gpl,gpl-or-later", 1.0),
    }
    got = scanned(spark, list(cases))
    assert [(g[4], g[5], g[6]) for g in got] == list(cases.values())
    assert got == [brute(t) for t in cases]


def test_hundreds_of_bounded_rules_hold_their_keyword():
    rules = licenses.rules()
    assert len({r["order"] for r in rules}) > 300
    by_order = {}
    for r in rules:
        assert r["regex"].startswith((" ", "(?:"))
        by_order.setdefault(r["order"], []).append(r)
    rng = random.Random(5)
    for same in by_order.values():  # whatever a rule matches holds one of its keywords
        for _ in range(30):
            words = sample(same[0]["regex"], rng)
            line = "".join(f" {i}~{w};" for i, w in enumerate(words))
            assert re.fullmatch(same[0]["regex"], line), line
            assert {r["keyword"] for r in same} & set(words), (same[0]["regex"], words)
            assert len(words) <= licenses.WIDEST


def sample(regex, rng):
    """Words of a random match of a token expression."""
    parts = re.findall(r"\(\?:|\)\??|\||[^()|]+", regex)

    def run(i):
        options, out = [], []
        while i < len(parts) and not parts[i].startswith(")"):
            if parts[i] == "(?:":
                inner, i = run(i + 1)
                if not (parts[i] == ")?" and rng.random() < 0.5):
                    out = out + inner
                i += 1
            elif parts[i] == "|":
                options.append(out)
                out, i = [], i + 1
            else:
                out = out + [w.replace("[cs]", rng.choice("cs")) for w in re.findall(r"~([^;]+);", parts[i])]
                i += 1
        return rng.choice(options + [out]), i

    return run(0)[0]


@pytest.mark.parametrize("block", [3, 40, licenses.BLOCK])
def test_soup_of_rule_words_equals_brute_force(spark, block):
    rng = random.Random(block)
    rules = licenses.rules()
    texts = []
    for _ in range(60):
        words = []
        while len(words) < rng.choice((5, 60, 400)):
            words += sample(rng.choice(rules)["regex"], rng) if rng.random() < 0.7 else ["licensed", "under", "the"]
            if rng.random() < 0.3 and words:
                words.pop()
        texts.append(" ".join(rng.choice((w, w.upper())) for w in words))
    assert scanned(spark, texts, block=block) == [brute(t) for t in texts]


def test_awkward_rows(spark, nasty, no_docs):
    got = licenses.scan(nasty).collect()
    assert len(got) == nasty.count()
    want = sorted(((i, *brute(t)) for i, t in nasty.select("doc_id", "text").collect()), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert licenses.scan(no_docs).collect() == []
    one = "x " * 30_000 + "cc by " + "y " * 30_000 + "cc by"
    assert scanned(spark, [one, None, "cc", "by cc by cc by"]) == [brute(t) for t in (one, None, "cc", "by cc by cc by")]


def test_plan_is_native_and_without_shuffle(spark):
    from tests.conftest import plan_text
    plan = plan_text(queries.QUERIES["op12_license_scan"](spark, SF))
    assert not re.search("Python|Arrow|Pandas|Exchange|Join", plan)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = queries.QUERIES["op12_license_scan"](spark, SF)
    names = [c for c in con.execute(queries.SQL["op12_license_scan"]).df().columns]
    assert df.columns == names
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(queries.SQL["op12_license_scan"]).fetchall())
