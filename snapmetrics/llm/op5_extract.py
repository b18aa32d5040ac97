"""Main text of web pages by minimum-cut labelling.

A page becomes blocks of text (runs between block-level tags, character references decoded, white space collapsed) with the
path of elements around them. A classifier turns each block's features into costs of calling it content or
boilerplate: the capacities to the two terminals. Smoothness edges join neighbours in page order and blocks with the
same parent element, the stronger the more of their path they share. The minimum cut (max-flow by shortest augmenting
paths) is the cheapest labelling; the source's side is the text.

The classifier is trained here, by logistic regression on a bounded sample of at most about ``SAMPLE`` pages. Its labels
are distant: pages that mark their parts with the elements of ``CONTENT`` and ``ASIDE`` say which blocks are which. The two
features that name these elements are blanked in half of the sampled pages, so that text shape, links, place and the words
of class and id carry weight of their own and pages without such elements are judged by them. Elements that can't hold text of the article
(navigation, footers, asides, forms, hidden ones) have an infinite capacity to the boilerplate terminal. Words of class, id and
role (comments, adverts, notices, sidebars) are a finite cost; what an element around most of the page's text says of
itself (``page-with-sidebar``, a page-wide form) is no word about the article and is left out.

Defined results: a null or empty html, or one without content, has the empty text; unclosed and truncated markup is read as
browsers do, roughly; elements nested deeper than ``DEEPEST`` count as part of that one; a very long page takes time in proportion to
its text and tags, times its depth; a tie of the two labellings is boilerplate; a null id stays null; repeated rows repeat their result; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter, deque
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmetrics.llm.common import map_rows, table

SAMPLE = 2_000
NEVER = 1 << 30
SCALE = 100
ADJACENT, SIBLING = 40, 60
#: Elements open at a time; deeper ones count as part of the deepest (browsers keep such a limit, too).
DEEPEST = 512

#: Elements whose text is no text, void elements, inline elements, elements that close an open paragraph.
RAW = set("script style template svg iframe textarea select title".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr img rp rt object math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder mtable mtr mtd semantics annotation".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CONTENT, ASIDE = {"article", "main"}, {"nav", "footer", "aside", "menu", "form", "dialog"}
BARRED = {"nav", "form", "button", "footer", "aside", "menu", "dialog"}
#: Words of class and id attributes.
ASIDE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies discussion disqus footer menu nav navbar navigation newsletter notice pagination popup promo promoted recommendations recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe teaser teasers toolbar trending widget".split())
CONTENT_WORDS = set("article body content entry main post story text".split())
#: Words of an element around an article with its headline, and of one around a whole page.
BODY_WORDS, PAGE_WORDS = set("article content entry post story".split()), set("container layout page root site wrap wrapper".split())
#: What a word of ASIDE_WORDS costs a block, in units of the classifier's score.
ASIDE_COST = 6.0
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/=]+|[^\s>/=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?)*+)>?", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")


_END = {name: re.compile(rf"</{name}\s*>?", re.I) for name in RAW}
#: A class that says what a page has (has-sidebar, no-ads) isn't the name of a part.
_HAS = re.compile(r"^(?:has|no|with|without|is)[-_]")


class Box(NamedTuple):
    """An open block element: its name, number and the words of its class, id and role."""

    name: str
    number: int
    words: frozenset


class Block:
    __slots__ = ("text", "boxes", "path", "elements", "words", "headed", "link_chars", "order")

    def __init__(self, text: str, boxes: tuple[Box, ...], link_chars: int, order: int) -> None:
        self.text, self.boxes, self.link_chars, self.order = text, boxes, link_chars, order
        self.path = tuple(x.number for x in boxes)

    def settle(self, wrappers: set[int]) -> None:
        """Names and words, without what the elements around most of the page say about themselves."""
        self.elements = tuple("div" if x.name == "form" and x.number in wrappers else x.name for x in self.boxes)
        self.words = frozenset().union(*(x.words - ASIDE_WORDS if x.number in wrappers else x.words for x in self.boxes))
        # a header of the article: inside an element of CONTENT or one named like it
        own = [i for i, x in enumerate(self.boxes) if x.name in CONTENT or (x.words & BODY_WORDS and not x.words & PAGE_WORDS)]
        self.headed = "header" in self.elements and (not own or own[0] > self.elements.index("header"))


def wrappers_of(found: list[Block]) -> set[int]:
    """Numbers of the elements around most of a page: more than half of its text and an article, main or h1 element (or being
    one), or four fifths of its text."""
    size: Counter = Counter()
    holds: set[int] = set()
    for b in found:
        for x in b.boxes:
            size[x.number] += len(b.text)
        last = max((i for i, x in enumerate(b.boxes) if x.name in CONTENT or x.name == "h1"), default=-1)
        holds.update(b.path[: last + 1])
    total = sum(len(b.text) for b in found)
    return {k for k, n in size.items() if 5 * n > 4 * total or (2 * n > total and k in holds)}


def blocks(html: str | None) -> list[Block]:
    """Text blocks in page order. ``path`` holds numbers of the open block elements, ``elements`` their names."""
    found: list[Block] = []
    stack: list[Box] = []
    deeper: list[str] = []  # elements open beyond DEEPEST
    beyond: Counter = Counter()
    parts: list[str] = []
    links = number = link_chars = 0
    page = html or ""

    def flush() -> None:
        nonlocal link_chars
        text = " ".join("".join(parts).split()) if parts else ""
        if text:
            boxes = tuple(s for s in stack if s.name not in INLINE and s.name not in ("html", "body"))
            found.append(Block(text, boxes, min(link_chars, len(text)), len(found)))
        parts.clear()
        link_chars = 0

    def say(raw: str) -> None:
        nonlocal link_chars
        if raw:
            text = references.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                link_chars += len(text.strip())

    at = 0
    while True:
        start = page.find("<", at)
        if start < 0:
            say(page[at:])
            break
        m = _MARK.match(page, start)
        if m is None:  # a lone "<" is text
            say(page[at : start + 1])
            at = start + 1
            continue
        say(page[at:start])
        at = m.end()
        if m.group(2) is None:
            continue
        name, closing = m.group(2).lower(), bool(m.group(1))
        if name in RAW and not closing:
            if not m.group(3).rstrip().endswith("/") or name not in ("svg", "math"):
                end = _END[name].search(page, at)
                at = end.end() if end else len(page)
            if name not in INLINE:
                flush()
            continue
        if name in INLINE:
            if name == "a":
                links = max(0, links - 1) if closing else 1
            if name in VOID:
                continue
        else:
            flush()
            links = 0
        if name in VOID or name in ("br", "hr"):
            continue
        if closing and deeper and beyond[name]:
            while (gone := deeper.pop()) != name:
                beyond[gone] -= 1
            beyond[name] -= 1
            continue
        if closing:
            # an end tag of an element that is not among the deeper ones ends those inside it, too
            if deeper and any(x.name == name for x in stack):
                deeper.clear()
                beyond.clear()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if name in INLINE and stack[i].name not in INLINE:
                    break  # an inline end tag doesn't close blocks
            continue
        if name in CLOSES_P or name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}.get(name, {"p"})
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in same:
                    del stack[i:]
                    break
                if stack[i].name not in INLINE and stack[i].name != "p":
                    break
        words = []
        if m.group(3):
            for key, value in _ATTRIBUTE.findall(m.group(3)):
                key = key.lower()
                if key in ("class", "id", "role"):
                    words += [w.lower() for token in value.strip("\"'").split() if not _HAS.match(token) for w in _PARTS.findall(token)]
                elif key == "hidden" or (key == "aria-hidden" and "true" in value) or (key == "style" and "none" in value and "display" in value):
                    words.append("hidden")
        number += 1
        if len(stack) < DEEPEST:
            stack.append(Box(name, number, frozenset(words)))
        else:
            deeper.append(name)
            beyond[name] += 1
    flush()
    wrappers = wrappers_of(found)
    for b in found:
        b.settle(wrappers)
    return found


# ----------------------------------------------------------------------------------------------------- classifier
FEATURES = ("bias", "log length", "words a 100", "link share", "end of sentence", "inner sentences", "heading", "list", "table",
            "aside words", "content words", "few letters", "depth", "first tenth", "last tenth", "copyright", "content element", "aside element")


def describe(b: Block, n: int) -> list[float]:
    t = b.text
    size = len(t)
    letters = sum(map(str.isalpha, t))
    place = b.order / max(1, n - 1)
    return [
        1.0, min(np.log1p(size) / 6, 1.5), min(t.count(" ") / 100, 1.5), b.link_chars / size, float(t[-1] in ".!?…\"'»)"), min((t.count(". ") + t.count("! ") + t.count("? ")) / 5, 1.0),
        float(bool(b.elements) and b.elements[-1] in ("h1", "h2", "h3", "h4", "h5", "h6")), float("li" in b.elements), float("table" in b.elements),
        float(bool(b.words & ASIDE_WORDS)), float(bool(b.words & CONTENT_WORDS)), float(letters < 0.5 * size), min(len(b.path) / 10, 1.5),
        float(place < 0.1), float(place > 0.9), float(t[0] == "©" or t.lower().startswith(("copyright", "(c)"))),
        float(not CONTENT.isdisjoint(b.elements)), float(not ASIDE.isdisjoint(b.elements)),
    ]


def barred(b: Block) -> bool:
    """No text of the article, whatever it looks like: by its elements (a header only outside the article), or hidden."""
    return b.headed or "hidden" in b.words or not BARRED.isdisjoint(b.elements)


def named_aside(b: Block) -> bool:
    """The names of an element around the block say that it is something else."""
    return not b.words.isdisjoint(ASIDE_WORDS)


def distant_labels(page: str | None) -> tuple:
    """Features and labels of the blocks of a page that marks both its content and its asides; else nothing."""
    found = blocks(page)
    rows, labels = [], []
    for b in found:
        inside, aside = not CONTENT.isdisjoint(b.elements), barred(b) or named_aside(b)
        rows.append(describe(b, len(found)))
        labels.append(int(inside and not aside))
    if 0 < sum(labels) < len(labels):
        return [x for r in rows for x in r], labels
    return [], []


#: Costs where no page of the table marks its parts: plain judgement of the same features.
DEFAULT = np.array([-1.5, 2.0, 2.0, -4.0, 1.5, 1.0, 0.5, -1.0, -0.5, -5.0, 1.5, -1.0, 0.0, 0.0, -0.5, -3.0, 3.0, -5.0])


def learn(pages: DataFrame, total: int) -> np.ndarray:
    """Weights from the distantly labelled blocks of a hash-drawn sample of pages. The two element features are dropped at
    random from half of the pages, so that the other features carry weight of their own."""
    draw = F.pmod(F.xxhash64(F.lit("page"), "html"), F.lit(1 << 40)) / float(1 << 40)
    sample = pages.filter(draw < SAMPLE / max(total, 1)).select("html").distinct()
    out = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("y", T.ArrayType(T.IntegerType()))])
    got = map_rows(sample, distant_labels, ["html"], out).filter(F.size("y") > 0).orderBy(F.xxhash64("x"), "x").collect()
    if not got:
        return DEFAULT
    k = len(FEATURES)
    x = np.concatenate([np.array(r["x"]).reshape(-1, k) for r in got])
    y = np.concatenate([np.array(r["y"], float) for r in got])
    share = np.concatenate([np.full(len(r["y"]), 1 / len(r["y"])) for r in got])  # every page counts the same
    half = np.concatenate([np.full(len(r["y"]), i % 2) for i, r in enumerate(got)]) == 1
    x[half, -2:] = 0
    w = np.zeros(k)
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.5 * np.eye(k)
        w = w - np.linalg.solve(h, x.T @ (share * (p - y)) + 0.5 * w)
    return w


# ---------------------------------------------------------------------------------------------------- minimum cut
class Network:
    """Max-flow by shortest augmenting paths with level graphs; arcs in flat lists."""

    def __init__(self, n: int) -> None:
        self.to: list[int] = []
        self.room: list[int] = []
        self.arcs: list[list[int]] = [[] for _ in range(n)]

    def join(self, a: int, b: int, there: int, back: int = 0) -> None:
        self.arcs[a].append(len(self.to))
        self.to.append(b)
        self.room.append(there)
        self.arcs[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def levels(self, s: int) -> list[int]:
        level = [-1] * len(self.arcs)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in self.arcs[u]:
                v = self.to[e]
                if self.room[e] and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        return level

    def source_side(self, s: int, t: int) -> list[bool]:
        """Saturate, then the nodes that the source still reaches."""
        while (level := self.levels(s))[t] >= 0:
            tried = [0] * len(self.arcs)
            path: list[int] = []
            u = s
            while True:
                if u == t:
                    push = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= push
                        self.room[e ^ 1] += push
                    cut = next(i for i, e in enumerate(path) if not self.room[e])
                    u = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                arcs = self.arcs[u]
                while tried[u] < len(arcs):
                    e = arcs[tried[u]]
                    if self.room[e] and level[self.to[e]] == level[u] + 1:
                        break
                    tried[u] += 1
                if tried[u] < len(arcs):
                    path.append(arcs[tried[u]])
                    u = self.to[path[-1]]
                elif path:
                    u = self.to[path.pop() ^ 1]
                    tried[u] += 1
                else:
                    break
        return [x >= 0 for x in level]


def label(found: list[Block], weights: np.ndarray) -> list[bool]:
    """True for the blocks on the content side of the minimum cut."""
    n = len(found)
    if not n:
        return []
    z = np.clip(np.array([describe(b, n) for b in found]) @ weights, -8, 8)
    net, s, t = Network(n + 2), n, n + 1
    last: dict[tuple[int, bool], int] = {}
    for i, b in enumerate(found):
        out, aside = barred(b), named_aside(b)
        cost = round(SCALE * (float(z[i]) - ASIDE_COST * aside))
        if out:
            net.join(i, t, NEVER)
        elif cost > 0:
            net.join(s, i, cost)
        elif cost < 0:
            net.join(i, t, -cost)
        if i and not out and not barred(found[i - 1]) and aside == named_aside(found[i - 1]):
            a, c = found[i - 1].path, b.path
            shared = sum(1 for x, y in zip(a, c) if x == y)  # noqa: B905
            net.join(i - 1, i, *(2 * [round(ADJACENT * (1 + shared) / (1 + max(len(a), len(c))))]))
        parent = b.path[-2] if len(b.path) > 1 else 0
        if not out:
            if (j := last.get((parent, aside))) is not None and j != i - 1:
                net.join(j, i, SIBLING, SIBLING)
            last[parent, aside] = i
    return net.source_side(s, t)[:n]


def main_text(weights: np.ndarray, page: str | None) -> tuple:
    found = blocks(page)
    inside = label(found, weights)
    kept = [b.text for b, x in zip(found, inside, strict=True) if x]
    text = " ".join(kept)
    return text, len(text), len(found), len(kept)


def extract_main_text(df: DataFrame, html_col: str = "html", keep: list[str] = ("page_id", "url")) -> DataFrame:
    """``keep``, text, n_chars, n_blocks, n_kept: one row per row of ``df``."""
    pages = df.select(F.col(html_col).alias("html"))
    weights = df.sparkSession.sparkContext.broadcast(learn(pages, pages.count()))
    out = T.StructType([T.StructField("text", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("n_chars", "n_blocks", "n_kept"))])
    return map_rows(df, main_text, [html_col], out, list(keep), setup=lambda: weights.value)


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op5_extract": op5_extract}
ORACLE: dict[str, str] = {}
