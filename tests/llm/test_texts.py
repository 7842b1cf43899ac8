"""Operators 1, 2, 4, 9 and 10: brute force, held-out accuracy and awkward inputs."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from profilekit.llm import decontamination, html_text, language_id, lm_scoring, queries, toxicity
from tests.llm.conftest import NASTY

SF = "/root/testdata/sf0.01"


def left(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# operator 1

def tokens(text):
    return (text or "").encode().lower().split() + [None]


def brute_scores(rows, held, weights=None):
    """Counts, base scores and (given the learnt weights) model scores, token by token."""
    word, pair, docs = Counter(), Counter(), 0
    for i, t in rows:
        if not held(i):
            ws = tokens(t)
            word.update(ws)
            pair.update(zip([0, *ws], ws, strict=False))
            docs += 1
    n, v = sum(word.values()), len(word)
    out = {}
    for i, t in rows:
        ws = tokens(t)
        base = sum(math.log10((word[w] + 1) / (n + v + 1)) for w in ws)
        score = 0.0
        if weights is not None:
            for before, w in zip([0, *ws], ws, strict=False):
                context = docs if before == 0 else word[before]
                p1 = word[w] / max(n, 1)
                p2 = pair[before, w] / context if context else p1
                a, b, c = weights[context.bit_length()]
                score += math.log10(a * p2 + b * p1 + c / (v + 1))
        out[i] = (held(i), len(ws), sum(word[w] > 0 for w in ws), n, base, score)
    return out


def check_scores(got, want):
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9) and r.score == pytest.approx(w[5], rel=1e-9)


def test_lm_query_against_brute_force(spark, monkeypatch):
    learnt = {}
    learn = lm_scoring.learn_weights
    monkeypatch.setattr(lm_scoring, "learn_weights", lambda *a: learnt.setdefault("w", learn(*a)))
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 60_000)  # many chunks
    got = queries.op1_lm_scoring(spark, SF).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_scores(got, brute_scores(rows, lambda i: left(i, 7) == 2, learnt["w"]))
    assert (learnt["w"].sum(axis=1) == pytest.approx(1)) and (learnt["w"] > 0).all()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_awkward(spark, nasty, no_docs):
    got = lm_scoring.score_texts(nasty).collect()
    rows = [(i, t) for i, t in NASTY]
    want = brute_scores(rows, lambda i: False)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) for r in got) == sorted(
        (str(i), *want[i][1:4]) for i, _ in rows)
    assert all(r.base_score == pytest.approx(want[r.doc_id][4]) and r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_scoring.score_texts(no_docs).count() == 0
    untrained = lm_scoring.score_texts(nasty, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0.0 for r in untrained)


# operator 2

def test_pages_query_gives_the_article(spark):
    import html
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op2_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>|<[^>]*$", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


PAGE = """<!doctype html><html><head><title>no</title></head><body class="has-sidebar"><header>Site</header>
<div id="menu"><a href="/">home</a></div><div class="page sidebar-left"><ul><li><a>a</a><li><a>b</a><li><a>c</a></ul>
<div id="cookie-notice">We use cookies</div><div class="content"><h2>Title &amp; {i}</h2><p>First{i}<br>line&nbsp;<b>bold</b>
<a href=x>link</a><p>Second &eacute; &#x4e2d; {i}<p>Read more on our site<script>if (a < b) document.write("<p>x</p>")</script>
<table><tr><td>one<td>two {i}</table></div><section class="comments"><p>nice!</section></div>
<form><label>mail</label></form><p style="display: none">hidden</p><footer>&copy; all</footer></body></html>"""


def test_wrapper_of_a_host_without_article_elements(spark):
    body = " ".join(f"w{k}" for k in range(40))
    pages = [(i, f"https://U@Host.example:80/p{i}", PAGE.replace("{i}", f"{i} {body.replace('w', f'{i}x')}"))
             for i in range(8)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for r in html_text.main_text(df).collect():
        blocks = r.text.split("\n")
        tag = f"{r.page_id} {body.replace('w', f'{r.page_id}x')}"
        assert blocks == [f"Title & {tag}", f"First{tag} line bold link", f"Second é 中 {tag}", "one", f"two {tag}"] or \
            blocks == [f"Title & {tag}", f"First{tag} line bold link", f"Second é 中 {tag}", f"two {tag}"]


def test_awkward_pages(spark):
    cut = "<html><body><nav><ul><li>m<article class='post ad'><h1>T</h1><p>text <b>more<br>and & so &lt; on"
    rows = [(1, None, None), (2, "x", ""), (3, None, "plain text"), (4, "http://h/", cut), (5, "http://h/", "<<<>>><p"),
            (6, "http://h/", "<p>a<div>b</p>c</div>"), (None, "http://h/", "<main>x</main>"), (6, "http://h/", "<p>a<div>b</p>c</div>"),
            (7, "http://h/", "<p>" + "word " * 100_000), (8, "http://h/", "<div>" * 300 + "deep" + "</div>" * 300)]
    df = spark.createDataFrame([(*r, 1, "c", "h") for r in rows],
                               "page_id long, url string, html string, n_chars int, codes string, host string")
    got = html_text.main_text(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert text[1] == text[2] == "" and text[3] == "plain text" and text[4] == "T\ntext more and & so < on"
    assert text[6] == "a\nb\nc" and text[None] == "x" and len(text[7]) == 499_999 and text[8] == "deep"
    assert html_text.main_text(df.limit(0)).count() == 0


def test_tree_matching_keeps_order():
    a, b = html_text.parse("<p>x<p>y<div>z</div>"), html_text.parse("<p>x<div>z</div><p>w")
    pairs = []
    assert html_text.match(a, b, pairs) == html_text.match(a, b)
    assert [(p.text, q.text) for p, q in pairs] in ([("z", "z"), ("x", "x")], [("x", "x"), ("z", "z")])


# operator 4

def test_language_query_held_out(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op4_language_id(spark, SF).collect()
    assert {r.doc_id for r in got} == set(langs) and all(r.held_out == (left(r.doc_id, 4) == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_switched_and_awkward_text(spark, nasty, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = language_id.learn(docs)
    text = {r.lang: r.text for r in docs.filter("n_chars > 1500").dropDuplicates(["lang"]).collect()}
    en, fr = text["en"].split()[:120], text["fr"].split()[:40]
    names, scores = field.predict([" ".join(en + fr).encode(), " ".join(en).encode(), b"123 !!", b"", None])
    assert names == ["en", "en", "und", "und", "und"] and scores[2:] == [0.0] * 3
    assert 0.5 < scores[0] < 0.9 < scores[1]  # bars and other marks are no words
    got = language_id.predict(nasty, field).collect()
    assert len(got) == len(NASTY)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (1, 2, 3, 8)} == dict.fromkeys((1, 2, 3, 8), "und")
    assert language_id.predict(no_docs, field).count() == 0
    nothing = language_id.learn(no_docs)
    assert {r.lang_pred for r in language_id.predict(nasty, nothing).collect()} == {"und"}


def test_forward_backward_is_the_sum_over_paths():
    import itertools

    import numpy as np
    field = language_id.fit([("a", ["xa", "ya"] * 20), ("b", ["xb", "zb"] * 20)])
    words = ["xa", "zb", "ya", "q"]
    field._emissions([words])
    x = field._scores[[field._rows[w] for w in words]].astype(float)
    total, sums = 0.0, np.zeros(2)
    for path in itertools.product(range(2), repeat=len(words)):
        p = math.exp(field.start[path[0]] + sum(field.transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
        p *= math.prod(x[i, y] for i, y in enumerate(path))
        total += p
        sums += [p * path.count(y) for y in range(2)]
    rows = np.asarray([field._rows[w] for w in words])
    got, n = field.posterior_sums(rows, np.asarray([len(words)]))
    assert n[0] == 4 and got[0] == pytest.approx(sums / total, rel=1e-4)


# operator 9

def test_toxicity_query_held_out(spark):
    sf = "/root/testdata/sf0.1"
    marked = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op9_toxicity(spark, sf).collect()
    held = [(r.predicted, marked[r.doc_id]) for r in got if r.held_out and r.doc_id in marked]
    hit, toxic, flagged = sum(p * t for p, t in held), sum(t for _, t in held), sum(p for p, _ in held)
    assert hit >= 0.9 * toxic and hit >= 0.95 * flagged
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (left(r.doc_id, 3) == 1) for r in got)


def test_folding_and_exceptions():
    assert toxicity.fold("You ІDІ0T!! m0r​on, $cum\n") == " you idiot moron scum "
    lexicon = toxicity.Lexicon({" idio": 5.0, " trash ": 3.0, " idiots ": 6.0}, ["trash can"])
    assert toxicity.measure(lexicon, "1d1ots and TRASH in the trash can")[:2] == (9.0, 2)
    assert toxicity.measure(lexicon, "video audio")[1] == 0


def test_toxicity_awkward(spark, nasty, no_docs):
    bad = "some words around a grumblefish here and there"
    docs = spark.createDataFrame([(100 + i, (bad if i % 2 else "some words around a thing here and there") + f" {i} {i * i} x{i}")
                                  for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(100 + i, 1, i % 2) for i in range(60)] + [(101, 1, None), (None, 1, 1), (9999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    assert " grumblef" in model["weights"] or any(t.startswith(" grum") for t in model["weights"])
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[100 + i].predicted == i % 2 for i in range(60))
    rows = toxicity.score(nasty, model).collect()
    assert len(rows) == len(NASTY) and len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score(no_docs, model).count() == 0
    for l in (labels.limit(0), labels.filter("toxic = 1")):
        share = toxicity.learn(docs, l)
        scores = {r.score for r in toxicity.score(docs, share).collect()}
        assert len(scores) == 1 and not share["weights"]


# operator 10

def test_decontamination_query_finds_every_held_item(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in queries.op10_decontamination(spark, SF).collect()}
    assert got == {(d.doc_id, b.item_id) for d in docs for b in items if b.text in d.text}


ITEM = "Tom has 5 apples and Mary has 7 apples in 3 days. How many apples does Tom have after giving 5 away?"
OTHER = "Well. Bob has 15 apples and Sue has 17 apples in 13 weeks. How many apples does Bob have after giving 15 away? End."
MIXED = "Well. Bob has 15 apples and Sue has 17 apples in 13 weeks. How many apples does Jim have after giving 99 away? End."


def test_reparameterised_copies_need_consistent_slots(spark):
    docs = spark.createDataFrame([(1, ITEM), (2, OTHER), (3, MIXED), (4, "Bob has 15 apples. " * 50), (5, None), (None, ITEM),
                                  (6, "x " * 30_000 + ITEM), (2, OTHER)], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "ok"), (None, "Bob has 15 apples and so on here")],
                                  "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.exact, r.consistency == 1.0) for r in decontamination.find(docs, items).collect())
    assert [g for g in got if g[0] != 2] == [(1, 1, True, True), (6, 1, True, True)]
    assert set(g for g in got if g[0] == 2) == {(2, 1, False, True)}


def test_decontamination_awkward(spark, nasty, no_docs):
    items = spark.createDataFrame([(1, "two three four five six seven eight"), (2, "a")], "item_id long, text string")
    clash = nasty.withColumn("item_id", F.lit(5)).withColumn("window", F.lit(1)).withColumn("overlap", F.lit(0))
    assert {(r.doc_id, r.item_id) for r in decontamination.find(clash, items).collect()} == {(4, 2)}
    assert decontamination.find(no_docs, items).count() == 0
    assert decontamination.find(nasty, items.limit(0)).count() == 0
