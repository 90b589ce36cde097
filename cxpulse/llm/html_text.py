"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements whose leaves are text blocks. Every node
is content or not. The model has potentials for a child given its parent
(per tag), for the words of class, id and role attributes, and for a text
block's length, share of link text and closing punctuation. Sum-product messages
go up from the leaves and down from the root; a text block whose marginal
for content is at least one half belongs to the main text.

The potentials are smoothed counts over labelled pages: pages with a landmark
(``article``, ``main`` or role ``main``), whose blocks are content inside the
landmark, unless an element there names itself something else (``ASIDE_TAGS``,
``ASIDE_WORDS``). ``SAMPLE`` pages (those with the smallest hash of their id)
are counted. The lists also serve as prior counts, so that a kind of
element that no labelled page has is judged by its name.

Comments, scripts, styles and other elements whose content is no markup
(``RAW``) never become nodes; all else is judged. A ``RAW`` tag without an end tag
is skipped alone (of a script or style also the code up to the next tag). White
space is ASCII's (``[\\x20\\x09-\\x0D]``).
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cxpulse.llm.common import materialise, table

SAMPLE = 4000
SMOOTH = 0.5
PRIOR = 50.0
MAX_WORDS = 2000  # attribute words, and tags, with counts of their own

RAW = {"script", "style", "template", "noscript", "iframe", "head", "textarea"}
CODE = {"script", "style"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
#: block tags that a following tag of the set closes
CLOSED_BY = {
    "p": {"p", "div", "ul", "ol", "li", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "nav", "header", "footer", "aside", "form", "blockquote", "pre", "main", "figure", "hr", "dl", "address", "fieldset", "details"},
    "li": {"li"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
}
#: form lists hold no blocks of text: without their end tags such a block closes them
CLOSED_BY |= {tag: CLOSED_BY["p"] | CLOSED_BY.get(tag, set()) for tag in ("select", "datalist", "optgroup", "option")}
#: tag -> the open tags that it closes
_CLOSES = {tag: tuple(other for other, by in CLOSED_BY.items() if tag in by) for tag in set().union(*CLOSED_BY.values())}
SCOPES = {"table", "ul", "ol", "dl", "div", "article", "section", "td", "blockquote", "object", "svg", "math"}
LANDMARKS = {"article", "main"}
ASIDE_TAGS = {"nav", "aside", "footer", "header", "form", "button", "menu", "dialog", "address", "fieldset", "select", "datalist", "optgroup", "option"}
ASIDE_WORDS = {
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "byline", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "form", "header", "login",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "related", "reply", "replies", "respond", "search", "share",
    "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "complementary", "contentinfo", "alert", "discussion",
}
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|<[!?/a-zA-Z][^>]*+>""", re.S)
_COMMENT = re.compile(r"<!--.*\Z()()()", re.S)  # all that can still match after the last ">"
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


class Node:
    """A block element (``text`` None) or a text block below ``parent``."""

    __slots__ = ("tag", "parent", "names", "text", "linked")

    def __init__(self, tag: str, parent: int, names: tuple[str, ...] = (), text: str | None = None, linked: int = 0):
        self.tag, self.parent, self.names, self.text, self.linked = tag, parent, names, text, linked


class _Open:
    """The open elements of a page, innermost last, as (tag, block node that holds
    it). Besides the stack it keeps the places of each open tag, of blocks and of
    scopes, and the number of open links, so that no question walks the stack.
    The place of an inline element that was closed out of turn stays, without tag."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]
        self.scopes: list[int] = [0]
        self.links = 0

    def push(self, tag: str, node: int) -> None:
        place = len(self.stack)
        self.places.setdefault(tag, []).append(place)
        if tag == "a":
            self.links += 1
        if tag not in INLINE:
            self.blocks.append(place)
            if tag in SCOPES:
                self.scopes.append(place)
        self.stack.append((tag, node))

    def close(self, place: int) -> None:
        """Close the element at ``place`` and all inside it."""
        while len(self.stack) > place:
            tag, _ = self.stack.pop()
            if not tag:
                continue
            self.places[tag].pop()
            if tag == "a":
                self.links -= 1
            if tag not in INLINE:
                self.blocks.pop()
                if tag in SCOPES:
                    self.scopes.pop()

    def close_inline(self, place: int) -> None:
        """Close the innermost element of its tag at ``place`` alone."""
        tag, node = self.stack[place]
        self.places[tag].pop()
        if tag == "a":
            self.links -= 1
        self.stack[place] = ("", node)
        while not self.stack[-1][0]:
            self.stack.pop()

    def closed_by(self, tag: str) -> int | None:
        """The outermost element within the last scope that ``tag`` closes."""
        found = None
        for other in _CLOSES.get(tag, ()):
            places = self.places.get(other)
            if places and places[-1] > self.scopes[-1]:
                place = places[bisect_right(places, self.scopes[-1])]
                found = place if found is None else min(found, place)
        return found


def parse(page: str) -> list[Node]:
    """Nodes in page order, parents first; node 0 is the root. Tags may be
    missing, crossed or unclosed: an end tag closes up to its element if that is
    open, else it is ignored. Takes time in proportion to the page, however deep
    its elements are nested."""
    nodes = [Node("#root", -1)]
    opened = _Open()
    stack = opened.stack
    buffer: list[str] = []
    linked = 0
    unclosed: set[str] = set()  # raw tags that have no end tag any more
    last = page.rfind(">")

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = _SPACE.sub(" ", "".join(buffer)).strip(" ")
            if text:
                nodes.append(Node("#text", stack[-1][1], (), text, linked))
            buffer.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        buffer.append(text)
        if opened.links:
            linked += len(text)

    at = 0
    while True:
        m = (_TAG if at <= last else _COMMENT).search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if at > last and not m[0].endswith(">"):
            continue
        tag = m[2].lower() if m[2] else None
        if tag is None:
            continue
        if not m[1]:
            if tag in RAW:
                end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>|<body[\s>]" if tag == "head" else rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if end is None:
                    unclosed.add(tag)
                    if tag in CODE:
                        code = _TAG.search(page, at)
                        at = code.start() if code else len(page)
                else:
                    at = end.start() if end[0][:2] != "</" else end.end()
                continue
            if tag == "br":
                buffer.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in INLINE:
                if not m[3].endswith("/"):
                    opened.push(tag, stack[-1][1])
                continue
            flush()
            place = opened.closed_by(tag)
            if place is not None:
                opened.close(place)
            names = tuple(w for g in _NAMES.findall(m[3]) for w in _WORDS.findall((g[0] or g[1] or g[2]).lower())) if m[3] else ()
            nodes.append(Node(tag, stack[-1][1], names))
            if not m[3].endswith("/"):
                opened.push(tag, len(nodes) - 1)
            continue
        places = opened.places.get(tag)
        if not places:
            continue
        if tag not in INLINE:
            flush()
            opened.close(places[-1])
        elif opened.blocks[-1] < places[-1]:  # a crossed inline end tag leaves the blocks open
            opened.close_inline(places[-1])
    flush()
    return nodes


def features(node: Node) -> tuple[str, ...]:
    """Keys of the node potentials."""
    if node.text is None:
        return tuple(f"word:{w}" for w in node.names)
    n = len(node.text)
    return (f"length:{min(9, int(math.log2(n + 1)))}", f"links:{min(4, 4 * node.linked // max(1, n))}", f"ends:{node.text[-1] in '.!?'}")


def landmark_labels(nodes: list[Node]) -> list[int] | None:
    """1 (content) or 0 by the page's landmarks; None if it has none."""
    if not any(n.tag in LANDMARKS or "main" in n.names for n in nodes):
        return None
    labels = [0] * len(nodes)
    for k, n in enumerate(nodes):
        if not k:
            continue
        if n.tag in LANDMARKS or "main" in n.names:
            labels[k] = 1
        elif n.tag in ASIDE_TAGS or any(w in ASIDE_WORDS for w in n.names):
            labels[k] = 0
        else:
            labels[k] = labels[n.parent]
    # below an aside inside a landmark nothing is content
    aside = [False] * len(nodes)
    for k, n in enumerate(nodes[1:], 1):
        aside[k] = aside[n.parent] or n.tag in ASIDE_TAGS or any(w in ASIDE_WORDS for w in n.names)
        if aside[k]:
            labels[k] = 0
    return labels


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for page in batch.column("html").to_pylist():
            nodes = parse(page or "")
            labels = landmark_labels(nodes)
            if labels is None:
                continue
            for k, n in enumerate(nodes[1:], 1):
                counts[f"tag:{n.tag}", labels[n.parent], labels[k]] += 1
                for f in features(n):
                    counts[f, 0, labels[k]] += 1
    keys, a, b = zip(*counts) if counts else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts.values(), pa.int64())], names=["key", "parent", "label", "n"])


class TreeModel:
    """Potentials and sum-product over a page's tree."""

    def __init__(self, counts: dict[tuple[str, int, int], int]):
        self.counts = {k: float(v) for k, v in counts.items()}
        self.edges: dict[str, tuple] = {}
        self.words: dict[str, tuple[float, float]] = {}

    def edge(self, tag: str) -> tuple[tuple[float, float], tuple[float, float]]:
        """P(child's label | parent's label) for a child with this tag."""
        if tag not in self.edges:
            rows = []
            for parent in (0, 1):
                n = [self.counts.get((f"tag:{tag}", parent, y), 0.0) + SMOOTH for y in (0, 1)]
                if tag in LANDMARKS:
                    n[1] += PRIOR
                elif tag in ASIDE_TAGS:
                    n[0] += PRIOR
                else:
                    n[parent] += PRIOR
                rows.append((n[0] / sum(n), n[1] / sum(n)))
            self.edges[tag] = tuple(rows)
        return self.edges[tag]

    def node(self, key: str) -> tuple[float, float]:
        """P(key | label) up to a factor."""
        if key not in self.words:
            n = [self.counts.get((key, 0, y), 0.0) + SMOOTH for y in (0, 1)]
            if key.startswith("word:"):
                n[0] += PRIOR * (key[5:] in ASIDE_WORDS)
                self.words[key] = (n[0] / sum(n), n[1] / sum(n))
            else:
                total = [sum(v for (k, _, y), v in self.counts.items() if y == z and k.split(":")[0] == key.split(":")[0]) + 1 for z in (0, 1)]
                p = [n[y] / total[y] for y in (0, 1)]
                self.words[key] = (p[0] / sum(p), p[1] / sum(p))
        return self.words[key]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of every node."""
        count = len(nodes)
        up = [(0.5, 0.5)] * count  # message of a node to its parent
        own = [[1.0, 1.0] for _ in nodes]  # potential times messages of the children
        own[0] = [0.99, 0.01]
        # a page's blocks resemble each other, so together they weigh as one: else the
        # short blocks of a long article would outvote its tag
        weight = 1 / max(1, sum(n.text is not None for n in nodes))
        for k in range(count - 1, -1, -1):
            a, b = own[k]
            for f in features(nodes[k]):
                p, q = self.node(f)
                if nodes[k].text is not None:
                    p, q = p ** weight, q ** weight
                a, b = a * p, b * q
                s = a + b
                a, b = a / s, b / s
            own[k] = [a, b]
            if k:
                (e00, e01), (e10, e11) = self.edge(nodes[k].tag)
                m0, m1 = e00 * a + e01 * b, e10 * a + e11 * b
                s = m0 + m1
                up[k] = (m0 / s, m1 / s)
                parent = own[nodes[k].parent]
                parent[0] *= up[k][0]
                parent[1] *= up[k][1]
                s = parent[0] + parent[1]
                parent[0] /= s
                parent[1] /= s
        belief = [0.0] * count
        down: list[tuple[float, float]] = [(own[0][0], own[0][1])] * count
        for k, n in enumerate(nodes):
            if k:
                b0, b1 = down[n.parent]
                o0, o1 = b0 / max(up[k][0], 1e-300), b1 / max(up[k][1], 1e-300)  # the parent's belief without this child
                (e00, e01), (e10, e11) = self.edge(n.tag)
                a, b = own[k][0] * (o0 * e00 + o1 * e10), own[k][1] * (o0 * e01 + o1 * e11)
                s = a + b
                down[k] = (a / s, b / s)
            belief[k] = down[k][1] / (down[k][0] + down[k][1])
        return belief

    def text(self, page: str) -> str:
        nodes = parse(page)
        return " ".join(n.text for n, p in zip(nodes, self.marginals(nodes)) if n.text is not None and p >= 0.5)


def train(pages: DataFrame, sample: int = SAMPLE) -> TreeModel:
    """Counts over the landmark pages among ``sample`` pages; without any the
    priors decide. Of attribute words the ``MAX_WORDS`` most frequent are kept, and
    of tag names as many."""
    ids = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    rows = pages.select("page_id", "html").join(F.broadcast(ids), "page_id").select("html")  # at most ``sample`` ids
    counts = rows.mapInArrow(_count, "key string, parent int, label int, n long").groupBy("key", "parent", "label").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "html-counts")
    kind = F.substring_index("key", ":", 1)
    ranked = counts.groupBy("key").agg(F.sum("n").alias("n")).withColumn("kind", kind)
    most = lambda k: ranked.filter(F.col("kind") == k).orderBy(F.desc("n"), "key").limit(MAX_WORDS).select("key")
    picked = most("tag").union(most("word")).union(ranked.filter(~F.col("kind").isin("tag", "word")).select("key"))
    counts = counts.join(F.broadcast(picked), "key").collect()  # 2 * MAX_WORDS names and some 20 text features, at most 4 rows each
    return TreeModel({(r["key"], r["parent"], r["label"]): r["n"] for r in counts})


def _extract(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.slice(lo, 500)
                texts = [machine.text(p) if p else "" for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Null or empty html, and pages without content, have an empty text; html
    without any markup is judged as one block outside a landmark. Repeated rows
    give repeated results, an empty table an empty one; further columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    model = pages.sparkSession.sparkContext.broadcast(train(rows))
    return rows.mapInArrow(_extract(model), "page_id long, url string, text string, n_chars long")


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
