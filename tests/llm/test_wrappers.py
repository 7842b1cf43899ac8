"""Wrapper induction on awkward trees and hosts; alignment against its definition."""

import random
import time

from profilekit.llm import html_text
from profilekit.llm.html_text import Node, extract, induce, match, parse


def plain_match(a, b):
    """Simple tree matching as defined: recursion, all child pairs."""
    if a.tag != b.tag:
        return 0.0
    if a.tag == "#text":
        return 2.0 if a.text == b.text else 1.0
    best = [[0.0] * (len(b.items) + 1) for _ in range(len(a.items) + 1)]
    for i, x in enumerate(a.items):
        for j, y in enumerate(b.items):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain_match(x, y))
    return 1.0 + best[-1][-1]


def random_tree(rng, depth=4):
    n = Node(rng.choice(("div", "p")), "/x")
    for _ in range(rng.randrange(4)):
        if depth and rng.random() < 0.6:
            n.items.append(random_tree(rng, depth - 1))
        else:
            n.items.append(Node("#text", "/x/#", text=rng.choice("abc")))
    return n


def test_match_equals_its_definition():
    rng = random.Random(3)
    for _ in range(200):
        a, b = random_tree(rng), random_tree(rng)
        a.tag = b.tag
        pairs = []
        assert match(a, b, pairs) == match(a, b) == plain_match(a, b)
        assert len({id(p) for p, _ in pairs}) == len(pairs) == len({id(q) for _, q in pairs})


def test_deep_and_wide_pages():
    deep = "<div>" * 5000 + "<p>down here</p>" + "</div>" * 5000
    assert extract(f"<body><article>{deep}</article></body>") == "down here"
    pages = [f"<body>{'<div>' * 5000}<p>text number {i} of this page</p><b>same</b>" for i in range(4)]
    codes, region = induce(pages)
    assert extract(pages[0], frozenset(codes), region).startswith("text number 0")
    rng = random.Random(1)
    wide = [parse("<body>" + "".join(f"<p>{rng.randrange(10**6)} line {k if k % 9 else 0}</p>" for k in range(5000))) for _ in range(2)]
    start = time.process_time()
    pairs = []
    assert match(*wide, pairs) >= 5001 and len(pairs) == 5000
    assert time.process_time() - start < 20


def page(k, body, menu="<div><p>Welcome to our site and shop</p></div>"):
    return f"<html><body>{menu}<div id=content>{body}</div><div><p>All prices include tax and delivery</p></div></body></html>"


def story(k):
    return "".join(f"<p>Story {k} has a paragraph {j} of its own words {k * 7 + j}.</p>" for j in range(4))


def texts(k):
    return "\n".join(f"Story {k} has a paragraph {j} of its own words {k * 7 + j}." for j in range(4))


def test_hosts_of_three_pages_and_with_an_odd_page():
    for n, odd in ((3, []), (7, ["<html><body><h1>404</h1><p>nothing is here</p></body></html>"])):
        pages = [page(k, story(k)) for k in range(n)]
        codes, region = induce(pages + odd)
        assert [extract(p, frozenset(codes), region) for p in pages] == [texts(k) for k in range(n)]


def test_alignment_decides_where_there_are_articles():
    """Teasers in article elements are the same on every page; the varying part is a plain div."""
    teasers = "<div class=grid>" + "".join(f"<article><p>Read our guide number {j} today</p></article>" for j in range(3)) + "</div>"
    pages = [page(k, story(k), teasers) for k in range(5)]
    codes, region = induce(pages)
    assert [extract(p, frozenset(codes), region) for p in pages] == [texts(k) for k in range(5)]


def test_reader_comments_go_and_link_lists_of_an_article_stay():
    comment = "<article class='comment'><p>reader says hi</p></article>"
    links = "<ul>" + "".join(f"<li><a href=/{j}>source {j}</a></li>" for j in range(4)) + "</ul>"
    for body in (f"<article><p>main story text</p>{comment}</article>", f"<article><p>main story text</p></article>{comment}",
                 f"<article><p>main story text</p></article><div class=comments>{comment * 5}</div>"):
        assert extract(f"<body>{body}</body>") == "main story text"
    got = extract(f"<body>{links}<article><p>main story text</p>{links}</article></body>")
    assert got == "main story text\n" + "\n".join(f"source {j}" for j in range(4))


def test_one_deep_page_does_not_end_the_query(spark):
    rows = [(1, "http://a.example/1", "<div>" * 3000 + "deep"), (2, "http://a.example/2", "<article>x</article>"), (3, None, None)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "deep", 2: "x", 3: ""}


def test_all_pages_of_a_host_vote(spark):
    """The eight pages of smallest hash share a passage and lack a menu that nearly all of the host's pages have."""
    ids = spark.range(48).selectExpr("id", "xxhash64(id) as h").orderBy("h").collect()
    first = [r.id for r in ids[:8]]
    shared, menu = "<p>This passage is part of eight stories</p>", "<div><p>Find all of our offers here</p></div>"

    def html(k):
        return page(k, (shared if k in first else "") + story(k), "" if k in first[:3] else menu)
    rows = [(k, f"http://a.example/{k}", html(k)) for k in range(48)] + [(100 + j, "http://a.example/0", html(0)) for j in range(300)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {k: ("This passage is part of eight stories\n" if k in first else "") + texts(k) for k in range(48)}
    assert got == want | {100 + j: want[0] for j in range(300)}
