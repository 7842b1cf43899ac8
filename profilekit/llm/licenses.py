"""License scan by ordered signature rules, in DataFrame functions only.

A text becomes words; a word becomes a token `` 17~gnu;`` that carries its
place, so that a regular expression over tokens gives the places of what it
finds. A rule is an expression of at most ``WIDEST`` words, a keyword that any
text it matches contains, a label and a confidence. Texts without a keyword are
done at once; of the others only blocks of ``BLOCK`` words (with ``WIDEST``
words around them) that hold a keyword are looked at, and only by the rules
of the keywords they hold. A detection belongs to the block it starts in.
Rules are ordered, by tier and then as listed: a detection that lies within
the interval of an earlier rule's detection is suppressed. The base phrases are
counted at every place and are never suppressed.

Everything is one projection: no shuffle, no join, no Python in tasks, so a
repeated id or text costs no more than any other row.

Defined results: a null text has no words; without detections the labels are
empty, the places null and the score 0. The score is the highest confidence among
what is found. Rows pass through one by one: null or repeated ids stay as they
are, an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import json
import re
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilekit.llm.text import col

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what parts words, once A-Z are lower-cased
BLOCK = 128
WIDEST = 32

# The base phrases and their labels.
BASE = [("cc by", "cc-by", "cc"), ("general public license", "gpl", "general"), ("all rights reserved", "reserved", "reserved")]

# A pattern is words; [a b] may be absent, {a|b c} is one of several, "license" is also "licence".
# License families as (label, pattern of the name, keyword, versions).
FAMILIES = [
    ("agpl", "{[gnu] affero general public license|[gnu] agpl}", ("affero", "agpl"), ("3.0", "1.0")),
    ("lgpl", "{[gnu] {lesser|library} general public license|[gnu] lgpl}", ("lesser", "library", "lgpl"), ("3.0", "2.1", "2.0")),
    ("gfdl", "{[gnu] free documentation license|gfdl}", ("documentation", "gfdl"), ("1.3", "1.2", "1.1")),
    ("gpl", "{[gnu] general public license|[gnu] gpl}", ("general", "gpl"), ("3.0", "2.0", "1.0")),
    ("apache", "apache [software] license", ("apache",), ("2.0", "1.1", "1.0")),
    ("mpl", "{mozilla public license|mpl}", ("mozilla", "mpl"), ("2.0", "1.1", "1.0")),
    ("epl", "{eclipse public license|epl}", ("eclipse", "epl"), ("2.0", "1.0")),
    ("eupl", "{european union public license|eupl}", ("european", "eupl"), ("1.2", "1.1", "1.0")),
    ("cddl", "{common development and distribution license|cddl}", ("development", "cddl"), ("1.1", "1.0")),
    ("cpl", "common public license", ("common",), ("1.0",)),
    ("osl", "{open software license|osl}", ("open", "osl"), ("3.0", "2.1", "2.0", "1.1", "1.0")),
    ("afl", "{academic free license|afl}", ("academic", "afl"), ("3.0", "2.1", "2.0", "1.2", "1.1")),
    ("artistic", "artistic license", ("artistic",), ("2.0", "1.0")),
    ("boost", "{boost software license|bsl}", ("boost", "bsl"), ("1.0",)),
    ("ofl", "{[sil] open font license|ofl}", ("font", "ofl"), ("1.1", "1.0")),
    ("zpl", "{zope public license|zpl}", ("zope", "zpl"), ("2.1", "2.0", "1.1")),
    ("psf", "{python software foundation license|psf license}", ("python", "psf"), ("2.0",)),
    ("php", "php license", ("php",), ("3.0", "3.01")),
    ("upl", "universal permissive license", ("permissive",), ("1.0",)),
    ("ncsa", "{university of illinois [ncsa] open source license|ncsa [open source] license}", ("illinois", "ncsa"), ()),
    ("ms-pl", "{microsoft public license|ms pl}", ("microsoft", "ms"), ()),
    ("ms-rl", "{microsoft reciprocal license|ms rl}", ("microsoft", "ms"), ()),
    ("odbl", "{open [data commons] [open] database license|odbl}", ("database", "odbl"), ("1.0",)),
    ("odc-by", "{open data commons attribution license|odc by}", ("attribution", "odc"), ("1.0",)),
    ("pddl", "{public domain dedication and license|pddl}", ("dedication", "pddl"), ("1.0",)),
    ("cc-by-nc-nd", "{cc by nc nd|creative commons attribution {noncommercial|non commercial} {noderivs|noderivatives|no derivatives}}", ("cc", "commons"), ("4.0", "3.0", "2.5", "2.0")),
    ("cc-by-nc-sa", "{cc by nc sa|creative commons attribution {noncommercial|non commercial} {sharealike|share alike}}", ("cc", "commons"), ("4.0", "3.0", "2.5", "2.0")),
    ("cc-by-nc", "{cc by nc|creative commons attribution {noncommercial|non commercial}}", ("cc", "commons"), ("4.0", "3.0", "2.5", "2.0")),
    ("cc-by-nd", "{cc by nd|creative commons attribution {noderivs|noderivatives|no derivatives}}", ("cc", "commons"), ("4.0", "3.0", "2.5", "2.0")),
    ("cc-by-sa", "{cc by sa|creative commons attribution {sharealike|share alike}}", ("cc", "commons"), ("4.0", "3.0", "2.5", "2.0")),
    ("cc-by", "{cc by|creative commons attribution}", ("cc", "commons"), ("4.0", "3.0", "2.5", "2.0")),
    ("cc0", "{cc0|creative commons zero|cc zero}", ("cc0", "commons", "cc"), ("1.0",)),
    ("bsd-0-clause", "{bsd 0 clause|zero clause bsd|0bsd}", ("bsd", "0bsd"), ()),
    ("bsd-2-clause", "{bsd {2|two} clause|{2|two} clause bsd|simplified bsd|freebsd license}", ("bsd", "freebsd"), ()),
    ("bsd-3-clause", "{bsd {3|three} clause|{3|three} clause bsd|new bsd|modified bsd|revised bsd}", ("bsd",), ()),
    ("bsd-4-clause", "{bsd {4|four} clause|{4|four} clause bsd|original bsd}", ("bsd",), ()),
    ("bsd", "bsd [style] license", ("bsd",), ()),
    ("mit", "{mit [style] license|mit x11 license|expat license}", ("license", "licence"), ()),
    ("x11", "x11 license", ("x11",), ()),
    ("isc", "isc license", ("isc",), ()),
    ("zlib", "{zlib [libpng] license|zlib libpng}", ("zlib",), ()),
    ("unlicense", "{the unlicense|unlicense org}", ("unlicense",), ()),
    ("wtfpl", "{wtfpl|do what the fuck you want to public license}", ("wtfpl", "fuck"), ()),
    ("postgresql", "postgresql license", ("postgresql",), ()),
    ("openssl", "openssl license", ("openssl",), ()),
    ("beerware", "{beerware|beer ware license}", ("beerware", "ware"), ()),
    ("ruby", "ruby license", ("ruby",), ()),
    ("vim", "vim license", ("vim",), ()),
    ("w3c", "w3c [software] license", ("w3c",), ()),
    ("ijg", "independent jpeg group license", ("jpeg",), ()),
    ("elastic", "elastic license", ("elastic",), ("2.0",)),
    ("sspl", "{server side public license|sspl}", ("server", "sspl"), ("1.0",)),
    ("busl", "{business source license|busl}", ("business", "busl"), ("1.1",)),
]

# Phrases of license texts and notices as (label, pattern, keyword, confidence).
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby", 1.0),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby", 1.0),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 1.0),
    ("bsd-3-clause", "neither the name of {the copyright holder|the author|the organization} nor the names of {its|other} contributors", "neither", 0.9),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising", 0.9),
    ("apache-2.0", "you may not use this file except in compliance with the license", "compliance", 1.0),
    ("apache-2.0", "apache org licenses license 2 0", "apache", 1.0),
    ("gpl-or-later", "it under the terms of the gnu general public license as published by the free software foundation either version", "foundation", 1.0),
    ("gpl", "this program is free software you can redistribute it and or modify", "redistribute", 0.9),
    ("lgpl", "this library is free software you can redistribute it and or modify", "redistribute", 0.9),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "mozilla", 1.0),
    ("apache-2.0", "apache {2 0|v2 0|v2}", "apache", 0.9),
    ("boost-1.0", "boost org license 1 0", "boost", 1.0),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 1.0),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors", "provided", 0.9),
    ("cc", "creativecommons org licenses", "creativecommons", 0.8),
    ("public-domain", "{released into|placed in|dedicated to|in} the public domain", "domain", 0.8),
    ("no-warranty", "without any warranty without even the implied warranty of", "warranty", 0.5),
    ("no-warranty", "without {warranties|warranty} {or conditions of any kind|of any kind}", ("warranties", "warranty"), 0.5),
    ("as-is", "{is|are} provided [on an] as is", "provided", 0.4),
    ("proprietary", "{proprietary and confidential|confidential and proprietary}", "proprietary", 0.8),
    ("proprietary", "{unauthorized|unauthorised} {copying|use|reproduction|distribution}", ("unauthorized", "unauthorised"), 0.7),
    ("proprietary", "may not be {copied|reproduced|redistributed} [or distributed] without [the] [prior] [express] [written] permission", "permission", 0.7),
    ("non-commercial", "for {non commercial|noncommercial} {use|purposes} only", ("commercial", "noncommercial"), 0.6),
    ("permission-required", "used {with|by} permission", "permission", 0.4),
]

_GRANT = ("{licensed|released|distributed|available|published|provided|redistributed} {under|through|with} "
          "[the] [terms {of|and conditions of} the]")
_LATER = "{or [at your option] any later version|or later|and later}"


def _pattern(text: str, spellings: bool = True) -> tuple[str, int]:
    """(regular expression over tokens, words of its longest match) of a pattern."""
    parts = re.findall(r"[\[\]{}|]|[^\s\[\]{}|]+", text)

    def sequence(i: int) -> tuple[str, int, int]:
        out, width = "", 0
        while i < len(parts) and parts[i] not in "]}|":
            if parts[i] in "[{":
                shut, options = {"[": "]", "{": "}"}[parts[i]], []
                opened = parts[i]
                while True:
                    inner, w, i = sequence(i + 1)
                    options.append((inner, w))
                    if parts[i] == shut:
                        break
                out += "(?:" + "|".join(o for o, _ in options) + ")" + ("?" if opened == "[" else "")
                width += max(w for _, w in options)
            else:
                out += r" \d+~" + (re.sub("^license", "licen[cs]e", parts[i]) if spellings else parts[i]) + ";"
                width += 1
            i += 1
        return out, width, i

    regex, width, _ = sequence(0)
    return regex, width


def _version(version: str) -> str:
    """Pattern of a version: 2.0 is 2, 2 0 or v2, with or without the word version."""
    major, minor = version.split(".")
    rest = "[0]" if minor == "0" else minor
    return f"{{[{{version|ver|v}}] {major} {rest}|v{major} {rest}}}"


@cache
def rules() -> list[dict]:
    """The ordered rules: order, label, confidence, keyword, regex, base (0 or 1).

    Tiers, first to last: notices of license texts, SPDX lines, granted names with a
    version, names with a version, granted names, bare names; the base phrases stand apart.
    """
    tiers: list[list[tuple]] = [[] for _ in range(6)]
    for label, pattern, keys, confidence in NOTICES:
        tiers[0].append((label, pattern, (keys,) if isinstance(keys, str) else keys, confidence))
    for label, name, keys, versions in FAMILIES:
        for v in versions:
            full, short = f"{label}-{v}", " ".join(label.split("-"))
            suffixes = [("-or-later", _LATER), ("", "")] if label in ("agpl", "lgpl", "gpl", "gfdl") else [("", "")]
            for suffix, later in suffixes:
                tiers[1].append((full + suffix, f"spdx license identifier {short} {_version(v)} {later}", ("spdx",), 1.0))
                tiers[2].append((full + suffix, f"{_GRANT} {name} [license] {_version(v)} {later}", keys, 1.0))
                tiers[3].append((full + suffix, f"{name} [license] {_version(v)} {later}", keys, 0.9))
        if not versions:
            tiers[1].append((label, f"spdx license identifier {' '.join(label.split('-'))}", ("spdx",), 1.0))
        tiers[4].append((label, f"{_GRANT} {name} [license]", keys, 0.8))
        tiers[5].append((label, name, keys, 0.6))
    out = [dict(order=i, label=label, confidence=0.5, keyword=key, regex=_pattern(phrase, spellings=False)[0], base=1)
           for i, (phrase, label, key) in enumerate(BASE)]
    order = len(out)
    for label, pattern, keys, confidence in (r for tier in tiers for r in tier):
        regex, width = _pattern(pattern)
        if width > WIDEST:
            raise ValueError(f"a rule of {width} words: {pattern}")
        out += [dict(order=order, label=label, confidence=confidence, keyword=k, regex=regex, base=0) for k in keys]
        order += 1
    return out


_RULE = "order int, label string, confidence double, keyword string, regex string, base int"


def _literal(value: object, schema: str) -> Column:
    """A constant of nested type (folded by the optimizer)."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _numbered(b: Column, keywords: Column) -> Column:
    """A block's tokens with their places, and the keywords it holds."""
    tokens = F.transform(b["words"], lambda w, i: F.concat(
        F.lit(" "), (i + b["base"]).cast("string"), F.lit("~"), w, F.lit(";")))
    return F.struct(b["first"].alias("first"), F.array_join(tokens, "").alias("text"),
                    F.array_intersect(b["words"], keywords).alias("found"))


def _detections(b: Column, groups: Column) -> Column:
    """Every match of the rules of a block's keywords, with its first and last word."""
    def matches(r: Column) -> Column:
        return F.transform(F.regexp_extract_all(b["text"], r["regex"], F.lit(0)), lambda m: F.struct(
            r["order"].alias("order"), r["label"].alias("label"), r["confidence"].alias("confidence"), r["base"].alias("base"),
            F.regexp_extract(m, r"^ (\d+)~", 1).cast("int").alias("start"),
            (F.length(m) - F.length(F.replace(m, F.lit(";"), F.lit("")))).cast("int").alias("words")))
    rules_here = F.flatten(F.transform(F.filter(groups, lambda g: F.array_contains(b["found"], g["keyword"])), lambda g: g["rules"]))
    return F.struct(b["first"].alias("first"), F.flatten(F.transform(rules_here, matches)).alias("hits"))


def _surviving(b: Column, block: int) -> Column:
    """The detections that start in the block and lie in no earlier rule's interval (base phrases always stay)."""
    def inside(a: Column, other: Column) -> Column:
        return ((other["base"] == 0) & (other["order"] < a["order"]) & (other["start"] <= a["start"])
                & (other["start"] + other["words"] >= a["start"] + a["words"]))
    return F.filter(b["hits"], lambda a: (a["start"] >= b["first"]) & (a["start"] < b["first"] + block)
                    & ((a["base"] == 1) | ~F.exists(b["hits"], lambda other: inside(a, other))))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    listed = rules()
    keywords = sorted({r["keyword"] for r in listed})
    known = _literal(keywords, "array<string>")
    groups = _literal([{"keyword": k, "rules": [r for r in listed if r["keyword"] == k]} for k in keywords],
                      f"array<struct<keyword:string,rules:array<struct<{_RULE.replace(' ', ':').replace(',:', ',')}>>>>")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lowered = F.translate(F.coalesce(col(text).cast("string"), F.lit("")), upper, lower)
    words = F.array_remove(F.split(lowered, BETWEEN), "")
    parts = docs.select(col(id_col).alias("doc_id"), words.alias("words"))
    n = F.size("words")
    firsts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda k: k * block)
    blocks = F.transform(firsts, lambda first: F.struct(
        first.alias("first"), F.greatest(first - WIDEST, F.lit(0)).alias("base"),
        F.slice("words", F.greatest(first - WIDEST, F.lit(0)) + 1, F.least(first, F.lit(WIDEST)) + block + WIDEST).alias("words")))
    held = F.when(F.arrays_overlap("words", known), F.filter(blocks, lambda b: F.arrays_overlap(b["words"], known)))
    found = parts.select("doc_id", n.cast("long").alias("n_words"), F.coalesce(F.flatten(F.transform(F.transform(F.transform(
        held, lambda b: _numbered(b, known)), lambda b: _detections(b, groups)), lambda b: _surviving(b, block))),
        F.array().cast(f"array<struct<{_HIT}>>")).alias("hits"))
    starts = F.transform(F.filter("hits", lambda h: h["base"] == 1), lambda h: h["start"].cast("long"))
    label = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), label(F.filter("hits", lambda h: h["base"] == 1)).alias("base_labels"),
        label(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["confidence"])), F.lit(0.0)).alias("score"))


_HIT = "order:int,label:string,confidence:double,base:int,start:int,words:int"


def scan_sql() -> str:
    """DuckDB SQL of the scan: every rule over whole texts, suppression by an anti join."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n".join(f"({r['order']}, {quote(r['label'])}, {r['confidence']}::DOUBLE, {quote(r['keyword'])}, {quote(r['regex'])}, {r['base']})"
                        for r in rules())
    return f"""
WITH rules(ord, label, confidence, keyword, regex, base) AS (VALUES
{values}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0) AS words FROM documents),
tokens AS (SELECT r, words, coalesce((SELECT string_agg(' ' || (i - 1) || '~' || words[i] || ';', '' ORDER BY i)
    FROM range(1, len(words) + 1) AS t(i)), '') AS line FROM docs),
hits AS (SELECT DISTINCT r, ord, label, confidence, base, regexp_extract(m, '^ (\\d+)~', 1)::BIGINT AS start,
    length(m) - length(replace(m, ';', '')) AS width
    FROM (SELECT r, ord, label, confidence, base, unnest(regexp_extract_all(line, regex, 0)) AS m
          FROM tokens JOIN rules ON list_contains(words, keyword))),
kept AS (SELECT * FROM hits a WHERE base = 1 OR NOT EXISTS (SELECT 1 FROM hits b WHERE b.r = a.r AND b.base = 0
    AND b.ord < a.ord AND b.start <= a.start AND b.start + b.width >= a.start + a.width)),
summed AS (SELECT r, count(*) FILTER (base = 1) AS n_base, min(start) FILTER (base = 1) AS first_word,
    max(start) FILTER (base = 1) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base = 1) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(confidence) AS score FROM kept GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN summed USING (r)"""
