"""Operator 2: main text of web pages by wrapper induction.

Every page of a host is parsed into a tree of block elements, and the trees are
aligned by simple tree matching: the host's distinct pages are dealt by hash
into groups of about ``GROUP``, all pages of a group are aligned with each other, and what they
prove is added up over the host, so the work grows with the pages, not with their square. Text at one
place that stays the same on nearly all (``SHARE``) of the host's pages, otherwise different, is
template; the varying slots are content, and the deepest element path that holds nearly all
of their text on all pages is the host's content region. The wrapper (template texts by path, content path) is
then applied to every page of the host: the region decides what is content, its
article elements only narrow it or round it off; of that everything stays but template texts and
what elements, roles and class words mark as menu, header, footer, sidebar,
notice, advert, form, reader comments or code, and, outside an article, lists
that are links only. Pages without the region (hosts with one page, other
layouts) give their article, else their main element, else the body.

Tree code keeps its own stacks, so pages may nest to any depth; equal subtrees
are matched whole and very long child lists cut at equal children, so matching
stays far below the square of a page's elements.

Blocks are joined in page order by one line feed; white space inside a block
is one space; character references are decoded. Cases: null and empty html
give the empty text, and so do pages without content. Truncated and badly
nested pages are read as far as they go. A null or odd url has no host: such
pages are read without a wrapper (template texts need ``LEAST_PAGES`` pages
of a host). A page counts once in its host's wrapper, however often it occurs; a null
page_id makes no difference.
Repeated rows give repeated results; an empty table gives no rows; only
page_id, url and html are read.
"""

from __future__ import annotations

import html as html_module
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.components import written
from profilekit.llm.text import batches_of, claim, col, slices, trimmed
from profilekit.operators.joins import bounded_broadcast

GROUP = 6            # pages of a host, about, that are aligned with each other; fewer than twice as many are one group
LEAST_PAGES = 3      # pages of a host that must share a text for it to be template
SHARE = 0.8          # ... and the share of them: an odd page does not switch the wrapper off
MOST_CELLS = 10_000  # child pairs of two nodes that are aligned by dynamic programming
LONG_PATH = 4_000    # characters of a path kept as they are; longer ones become a digest
REGION = 0.9         # share of a host's varying text that its content region holds
ALIKE = 0.5          # pages with this share of equal text are copies and prove no template

# Element names and class words (fixed values).
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes".split())
DROPPED = frozenset("head nav footer aside form button select datalist dialog menu svg math object canvas audio video "
                    "map applet fieldset".split()) | RAW
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd td th tr table tbody thead tfoot caption blockquote pre "
                   "figure figcaption address details summary".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output "
                   "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br input".split())
KEPT = frozenset("html body main article".split())
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar side rail header masthead topbar footer "
    "cookie cookies consent gdpr notice notices alert disclaimer popup modal overlay newsletter subscribe subscription "
    "signup login search share sharing social related recommended recommendations comment comments disqus respond reply "
    "replies discussion feedback widget toolbar skip legal copyright".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                  "toolbar".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
SCOPES = frozenset("ul ol dl table article main body html section div blockquote".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|([^<]+|<)", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|style|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


class Node:
    """A block element, or (tag ``#text``) a run of text in one."""

    __slots__ = ("tag", "path", "soft", "items", "text", "linked", "code", "full", "plain")

    def __init__(self, tag: str, path: str, soft: bool = False, text: str = "", linked: int = 0):
        self.tag, self.soft, self.text, self.linked = tag, soft, text, linked
        self.path = path if len(path) <= LONG_PATH else f"/{xxhash.xxh64_hexdigest(path.encode())}"
        self.items: list[Node] = []
        self.code: int | None = None

    def walk(self, enter=None) -> list[Node]:
        """All nodes below, in page order; nodes that ``enter`` rejects are listed but not entered."""
        out, stack = [], self.items[::-1]
        while stack:
            n = stack.pop()
            out.append(n)
            if n.items and (enter is None or enter(n)):
                stack += n.items[::-1]
        return out

    def runs(self) -> list[Node]:
        return [n for n in self.walk() if n.tag == "#text"]

    def size(self) -> int:
        return sum(len(n.text) for n in self.walk()) + len(self.text)


def _marks(attributes: str) -> tuple[str, bool, bool, bool]:
    """(identity for paths, boilerplate by class or role, hidden, reader comments by class) of an element."""
    own, soft, hidden, comment = "", False, False, False
    for name, a, b, c in _ATTR.findall(attributes):
        value, name = a or b or c, name.lower()
        if name in ("class", "id"):
            own += ("." if name == "class" else "#") + " ".join(value.lower().split())
            words = {w.lower() for w in _WORD.split(value)}
            soft, comment = soft or not words.isdisjoint(BOILERPLATE), comment or not words.isdisjoint(COMMENTS)
        elif name == "role":
            soft = soft or value.lower() in ROLES
            own += "[main]" if value.lower() == "main" else ""
        elif name == "hidden":
            hidden = True
        elif name == "style":
            hidden = hidden or "display:none" in value.lower().replace(" ", "")
    return own, soft, hidden, comment


def parse(page: str) -> Node:
    """Tree of block elements; dropped elements and their text are left out."""
    root = Node("#root", "")
    stack: list[tuple[str, Node]] = [("#root", root)]  # open elements and the block each writes to
    parts: list[str] = []
    state = {"linked": 0}
    links = 0
    in_article = 0

    def flush():
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                block = stack[-1][1]
                block.items.append(Node("#text", block.path + "/#", text=text, linked=min(state["linked"], len(text))))
            parts.clear()
        state["linked"] = 0

    def close(at: int):
        nonlocal links, in_article
        while len(stack) > at:
            tag, block = stack[-1]
            if tag not in INLINE or block is not stack[-2][1]:
                flush()
            stack.pop()
            links -= tag == "a"
            in_article -= tag in ("article", "main")

    pos, n = 0, len(page)
    skip: list[str] = []
    while pos < n:
        m = _TOKEN.match(page, pos)
        if m is None:
            pos += 1
            continue
        pos = m.end()
        closing, tag, attributes, text = m.groups()
        if text is not None:
            if not skip:
                text = html_module.unescape(text) if "&" in text else text
                parts.append(text)
                if links:
                    state["linked"] += len(text.strip())
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if skip:
            if closing:
                if tag in skip:
                    del skip[len(skip) - 1 - skip[::-1].index(tag):]
                continue
            if tag in ("article", "main", "body") and skip[0] not in ("form",):
                skip = []  # an unclosed menu or header does not swallow the article
            elif tag in RAW:
                pos = _after_raw(page, pos, tag)
                continue
            else:
                if tag not in VOID and not attributes.endswith("/") and tag == skip[0]:
                    skip.append(tag)
                continue
        if closing:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] == tag:
                    close(at)
                    break
                if stack[at][0] in KEPT and tag not in KEPT:
                    at = 1
                    break
            else:
                at = 1
            if at == 1 and tag not in INLINE:
                flush()  # an end tag without its start still ends a block
            continue
        if tag in RAW:
            pos = _after_raw(page, pos, tag)
            parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                parts.append(" " if tag == "br" else "")
            continue
        own, soft, hidden, comment = _marks(attributes) if attributes else ("", False, False, False)
        if tag in DROPPED or hidden or (tag == "header" and not in_article):
            flush()
            skip = [tag]
            continue
        # class words do not make the page or its article boilerplate, unless they say that it is a reader's
        soft = soft and (tag not in KEPT or tag == "article" and comment)
        if tag not in INLINE:
            # a block ends an open paragraph; list items and cells end their like
            ends = CLOSES.get(tag, set()) | {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in ends:
                    close(at)
                    break
                if stack[at][0] in SCOPES:
                    break
        block = stack[-1][1]
        if tag not in INLINE or soft:
            flush()
            block = Node(tag, f"{block.path}/{tag}{own}", soft)
            stack[-1][1].items.append(block)
        stack.append((tag, block))
        links += tag == "a"
        in_article += tag in ("article", "main")
    close(1)
    flush()
    return root


def _after_raw(page: str, pos: int, tag: str) -> int:
    """Position behind the end tag of a raw-text element (the end of the page if there is none)."""
    m = re.compile(f"</{tag}[^>]*(?:>|\\Z)", re.I).search(page, pos)
    return m.end() if m else len(page)


def _prepare(tree: Node) -> None:
    """Digest of every subtree (equal for equal ones), its weight in a match with itself, whether it is one run of text; once."""
    if tree.code is not None:
        return
    for n in reversed([tree, *tree.walk()]):
        n.plain = len(n.items) == 1 and n.items[0].tag == "#text"
        if n.tag == "#text":
            n.code, n.full = xxhash.xxh3_64_intdigest("#" + n.text), 2.0
        else:
            below = b"".join(x.code.to_bytes(8, "little") for x in n.items)
            n.code = xxhash.xxh3_64_intdigest(f"<{n.tag}>".encode() + below)
            n.full = 1.0 + sum(x.full for x in n.items)


def _children(p: Node, q: Node) -> tuple[list[tuple[Node, Node]], list[Node], list[Node]]:
    """Equal children at both ends, matched (no better match can have them), and those left between."""
    x, y = p.items, q.items
    least = min(len(x), len(y))
    front = next((i for i in range(least) if x[i].code != y[i].code), least)
    back = next((i for i in range(least - front) if x[-1 - i].code != y[-1 - i].code), least - front)
    same = [*zip(x[:front], y[:front], strict=True), *zip(x[len(x) - back:], y[len(y) - back:], strict=True)]
    return same, x[front:len(x) - back], y[front:len(y) - back]


def _gaps(x: list[Node], y: list[Node]) -> list[tuple[list[Node], list[Node]]]:
    """Stretches of two child lists to be aligned: cut, where they are long, at children that are equal and
    occur once on either side, and, where a stretch is still long, into pieces of equal place."""
    if len(x) * len(y) <= MOST_CELLS:
        return [(x, y)]
    at = {c: i for i, c in enumerate(n.code for n in y)}
    once = {c for c, n in Counter(n.code for n in x).items() if n == 1} & {c for c, n in Counter(n.code for n in y).items() if n == 1}
    anchors = [(i, at[n.code]) for i, n in enumerate(x) if n.code in once]
    tails: list[int] = []  # longest run of anchors that rise on both sides
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(anchors):
        place = bisect_left(tails, j)
        before.append(ends[place - 1] if place else -1)
        tails[place:place + 1], ends[place:place + 1] = [j], [k]
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(anchors[k])
        k = before[k]
    out, i0, j0 = [], 0, 0
    for i, j in [*chain[::-1], (len(x), len(y))]:
        a, b = x[i0:i], y[j0:j]
        step = math.isqrt(MOST_CELLS)
        if len(a) * len(b) <= MOST_CELLS:
            out.append((a, b))
        else:
            out += [(a[k:k + step], b[k:k + step]) for k in range(0, max(len(a), len(b)), step)]
        if i < len(x) or j < len(y):
            out.append((x[i:i + 1], y[j:j + 1]))
        i0, j0 = i + 1, j + 1
    return [(a, b) for a, b in out if a and b]


def match(a: Node, b: Node, pairs: list[tuple[Node, Node]] | None = None) -> float:
    """Simple tree matching: weight of the best order-preserving matching; ``pairs`` gets its text runs.

    Trees of any depth (explicit stacks); equal subtrees are matched whole, and
    child lists of more than ``MOST_CELLS`` pairs are cut at equal children first.
    """
    _prepare(a)
    _prepare(b)
    weight: dict[tuple[int, int], float] = {}
    tables: dict[tuple[int, int], list] = {}

    def known(p: Node, q: Node) -> float | None:
        if p.tag != q.tag:
            return 0.0
        if p.code == q.code:
            return p.full
        if p.plain and q.plain:
            return 2.0
        return 1.0 if p.tag == "#text" else weight.get((id(p), id(q)))

    stack = [(a, b)]
    while stack:
        p, q = stack[-1]
        if known(p, q) is not None:
            stack.pop()
            continue
        same, x, y = _children(p, q)
        gaps = _gaps(x, y)
        weights = [[[known(c, d) for d in v] for c in u] for u, v in gaps]
        need = [(c, d) for (u, v), rows in zip(gaps, weights, strict=True) for c, row in zip(u, rows, strict=True)
                for d, w in zip(v, row, strict=True) if w is None]
        if need:
            stack += need
            continue
        total, kept = 1.0 + sum(c.full for c, _ in same), []
        for (u, v), rows in zip(gaps, weights, strict=True):
            best = [[0.0] * (len(v) + 1)]
            for own in rows:
                above, row, left = best[-1], [0.0], 0.0
                for j, w in enumerate(own):
                    left = max(above[j + 1], left, above[j] + w)
                    row.append(left)
                best.append(row)
            kept.append((u, v, best))
            total += best[-1][-1]
        weight[id(p), id(q)], tables[id(p), id(q)] = total, [same, kept]
        stack.pop()
    result = known(a, b)
    if pairs is None:
        return result
    stack = [(a, b)]
    while stack:
        p, q = stack.pop()
        if p.tag != q.tag:
            continue
        if p.tag == "#text":
            pairs.append((p, q))
        elif p.code == q.code:
            pairs += zip(p.runs(), q.runs(), strict=True)
        elif p.plain and q.plain:
            pairs.append((p.items[0], q.items[0]))
        else:
            same, kept = tables[id(p), id(q)]
            stack += same
            for u, v, best in kept:
                i, j = len(u), len(v)
                while i and j:
                    if best[i][j] == best[i - 1][j]:
                        i -= 1
                    elif best[i][j] == best[i][j - 1]:
                        j -= 1
                    else:
                        i, j = i - 1, j - 1
                        stack.append((u[i], v[j]))
    return result


def template_code(run: Node) -> int:
    """Identity of a template text: its path and its words."""
    return xxhash.xxh64_intdigest(f"{run.path}\n{run.text}".encode()) - (1 << 63)


def proven(trees: list[Node]) -> Counter:
    """How many of the pages prove each template text by their alignment with another one of them."""
    proof: dict[int, set[int]] = {}
    sizes = [t.size() for t in trees]
    for i, a in enumerate(trees):
        for j in range(i + 1, len(trees)):
            pairs: list[tuple[Node, Node]] = []
            match(a, trees[j], pairs)
            same = [(p, q) for p, q in pairs if p.text == q.text and p.path == q.path]
            if sum(len(p.text) for p, _ in same) <= ALIKE * min(sizes[i], sizes[j]):
                for p, _ in same:
                    proof.setdefault(template_code(p), set()).update((i, j))
    return Counter({c: len(seen) for c, seen in proof.items()})


def induce(pages: list[str]) -> tuple[list[int], str]:
    """(template codes, path of the content region) of one host's pages, aligned as one group."""
    trees = [parse(p) for p in dict.fromkeys(pages)]
    # a passage that some articles share is content; template is what nearly all pages have
    least = max(LEAST_PAGES, math.ceil(SHARE * len(trees)))
    codes = sorted(c for c, seen in proven(trees).items() if seen >= least)
    fixed, held = set(codes), Counter()
    for tree in trees:
        _varying(tree, fixed, held)
    total = held[""]
    # the deepest element path that holds nearly all of the varying text
    full = [p for p, n in held.items() if n >= REGION * total]
    return codes, max(full, key=lambda p: (p.count("/"), p)) if total else ""


def _varying(root: Node, fixed: set[int], held: Counter) -> None:
    """Adds each container path's varying unlinked text, all levels counted; boilerplate left out."""
    above = {id(root): -1}
    nodes, container, n = [root], [""], [0]
    for k, x in enumerate([root, *root.walk(lambda n: not n.soft)]):
        if k:
            nodes.append(x)
            up = above[id(x)]
            container.append(container[up] if x.tag in LEAVES else x.path)
            n.append(0 if x.tag != "#text" or template_code(x) in fixed else max(0, len(x.text) - x.linked))
        above.update((id(y), k) for y in x.items)
    for k in range(len(nodes) - 1, 0, -1):
        x = nodes[k]
        if x.soft:
            continue
        if x.tag not in LEAVES and x.tag != "#text":
            held[container[k]] += n[k]
        n[above[id(x)]] += n[k]
    held[""] += n[0]


def _find(node: Node, wanted) -> list[Node]:
    """Outermost elements that ``wanted`` holds for, boilerplate left out."""
    taken = lambda n: n.tag != "#text" and not n.soft and wanted(n)
    return [n for n in node.walk(lambda n: not n.soft and not wanted(n)) if taken(n)]


def extract(page: str | None, codes: frozenset = frozenset(), region: str = "") -> str:
    """Main text of a page under its host's wrapper.

    Where the aligned pages have a content region, it decides: the articles
    inside it if they hold most of its text (or the article it lies in), else the
    region itself. Only pages without one fall back on article and main elements.
    """
    if not page:
        return ""
    root = parse(page)
    _harden(root)
    is_article, is_main = (lambda n: n.tag == "article"), (lambda n: n.tag == "main" or n.path.endswith("[main]"))
    found: list[Node] = []
    if region:
        found = [n for part in _find(root, lambda n: n.path == region)
                 for n in ([part] if is_article(part) else _articles(part, is_article) or [part])]
        around = [n for n in _find(root, is_article) if region.startswith(n.path + "/")]
        found = around or found
    for wanted in (None, is_article, is_main):
        blocks: list[str] = []
        for n in found if wanted is None else _find(root, wanted):
            _collect(n, codes, blocks)
        if blocks:
            return "\n".join(blocks)
    blocks = []
    _collect(root, codes, blocks)
    return "\n".join(blocks)


def _articles(part: Node, wanted) -> list[Node]:
    """The articles of a region, if they hold most of its text."""
    inside = _find(part, wanted)
    return inside if 2 * sum(n.size() for n in inside) >= part.size() else []


def _harden(root: Node) -> None:
    """A class word is no proof against an element that holds the article or most of the page's text."""
    nodes = [root, *root.walk()]
    size, article = {}, {}
    for n in reversed(nodes):
        size[id(n)] = len(n.text) + sum(size[id(x)] for x in n.items)
        article[id(n)] = any(article[id(x)] or x.tag in ("article", "main") and not x.soft for x in n.items)
    for n in nodes:
        if n.soft and (article[id(n)] or size[id(n)] > 0.6 * size[id(root)]):
            n.soft = False


def _collect(node: Node, codes: frozenset, out: list[str]) -> None:
    """The element's text, boilerplate and template left out; outside an article a list of links only is a menu."""
    inside = node.tag in ("article", "main")

    def entered(n: Node) -> bool:
        if n.soft:
            return False
        if not inside and n.tag in ("ul", "ol"):
            runs = n.runs()
            return len(runs) < 3 or any(r.linked < len(r.text) for r in runs)
        return True
    if inside or entered(node):
        out += [n.text for n in node.walk(entered) if n.tag == "#text" and not (codes and template_code(n) in codes)]


def template_texts(whole: DataFrame, sizes: DataFrame) -> DataFrame:
    """(host, codes) of the hosts with template texts; ``whole``: host, d, html of all pages, ``sizes``: host, n distinct pages.

    Each distinct page is aligned with the others of its group; proofs are added up over the host.
    """
    n_groups = F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") / GROUP))
    # a page's copies meet in one group, and the set of its texts holds it once
    groups = (whole.join(sizes, "host").groupBy("host", F.pmod("d", n_groups).alias("g"))
              .agg(F.collect_set("html").alias("pages")).select("host", "pages"))

    @trimmed
    def align(batches):
        claim(__name__)
        for b in batches:
            for k in range(b.num_rows):
                found = proven([parse(p) for p in sorted(b.column(1)[k].as_py())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column(0)[k].as_py()] * len(found), pa.string()), pa.array(found.keys(), pa.int64()),
                     pa.array(found.values(), pa.int64())], names=["host", "code", "seen"])

    seen = (groups.mapInArrow(align, "host string, code long, seen long").groupBy("host", "code")
            .agg(F.sum("seen").alias("seen")))
    # a passage that some articles share is content; template is what nearly all pages have
    least = F.greatest(F.lit(LEAST_PAGES).cast("long"), F.ceil(F.lit(SHARE) * F.col("n")))
    return (seen.join(sizes, "host").filter(F.col("seen") >= least).groupBy("host")
            .agg(F.sort_array(F.collect_list("code")).alias("codes")))


def content_regions(whole: DataFrame, codes: DataFrame, repeated: DataFrame) -> DataFrame:
    """(host, region) of every host; ``repeated``: host, d, k of pages that occur k times, which count once."""
    src = (whole.join(codes, "host", "left").join(repeated, ["host", "d"], "left")
           .select("host", F.col("html").cast("binary").alias("html"), "codes", F.coalesce("k", F.lit(1).cast("long")).alias("k")))

    @trimmed
    def vary(batches):
        claim(__name__)
        for b in slices(batches, 1):
            held: dict[tuple[str, int], Counter] = {}
            fixed: dict[str, frozenset] = {}
            for host, page, known, k in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if host not in fixed:
                    fixed[host] = frozenset(known or ())
                _varying(parse(page.decode()), fixed[host], held.setdefault((host, k), Counter()))
            rows = [(host, path, k, n) for (host, k), paths in held.items() for path, n in paths.items()]
            arrays = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64()),
                                                     strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["host", "path", "k", "n"])

    held = (src.mapInArrow(vary, "host string, path string, k long, n long").groupBy("host", "path", "k")
            .agg(F.sum("n").alias("n")).select("host", "path", F.expr("n div k").alias("n"))
            .groupBy("host", "path").agg(F.sum("n").alias("n")))
    held, _ = written(held, "varying-text")
    total = held.filter("path = ''").select("host", F.col("n").alias("total"))
    # the deepest element path that holds nearly all of the varying text
    deep = F.struct(F.length(F.regexp_replace("path", "[^/]", "")), "path")
    full = (held.join(total, "host").filter((F.col("total") > 0) & (F.col("n") >= F.lit(REGION) * F.col("total")))
            .groupBy("host").agg(F.max_by("path", deep).alias("region")))
    return total.join(full, "host", "left").select("host", F.coalesce("region", F.lit("")).alias("region"))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, codes, region) of every host, from all of its pages; ``pages``: host, html."""
    whole = pages.filter("host is not null and html is not null").select("host", F.xxhash64("html").alias("d"), "html")
    copies, _ = written(whole.groupBy("host", "d").agg(F.count(F.lit(1)).alias("k")), "page-copies")
    sizes, _ = bounded_broadcast(copies.groupBy("host").agg(F.count(F.lit(1)).alias("n")))
    codes, _ = bounded_broadcast(template_texts(whole, sizes), byte_measure=F.lit(40) + F.lit(8) * F.size("codes"))
    repeated, _ = bounded_broadcast(copies.filter("k > 1"))
    regions = content_regions(whole, codes, repeated)
    return regions.join(codes, "host", "left").select("host", F.coalesce("codes", F.array().cast("array<long>")).alias("codes"), "region")


def main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    batches_of(pages)
    src = pages.select(col(page_id).alias("page_id"), col(url).cast("string").alias("url"),
                       col(html).cast("string").alias("html"))
    host = F.lower(F.regexp_extract("url", _HOST, 1))
    src = src.withColumn("host", F.when(host != "", host))
    found, _ = written(wrappers(src), "wrappers")
    size = F.lit(40) + F.octet_length("region") + F.lit(8) * F.size("codes")
    small, _ = bounded_broadcast(found.withColumnRenamed("host", "h"), byte_measure=size)
    joined = src.join(small, src["host"] == small["h"], "left").select(
        "page_id", "url", F.col("html").cast("binary").alias("html"), "codes", "region")
    schema = T.StructType([joined.schema["page_id"], joined.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches):
        known: dict[tuple, frozenset] = {}
        for b in slices(batches, 2):
            texts = []
            for page, codes, region in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                key = tuple(codes or ())
                if key not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[key] = frozenset(key)
                texts.append(extract(page.decode() if page else None, known[key], region or ""))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return joined.mapInArrow(run, schema)
