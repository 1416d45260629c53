"""Main text of web pages by tag-path ratios.

Per page: the markup becomes text nodes with their root-to-leaf tag paths (names and classes).
Subtrees whose element, role, class or id says menu, header, footer, sidebar, notice, advert,
form, comment and the like are set aside; by class, role or id only if the subtree doesn't hold
most of the text. For each path the text outside links and the
punctuation are added up and divided by its nodes; both ratios are smoothed over the nodes in
page order, fused by their product, and paths whose fused mean stays below a share of the
page's spread are dropped. The least element that holds all nodes of kept paths is the
article; its remaining nodes (headings, short lines, lists) belong to it, but not bare boxes
of paths below the bar. An <article> or
<main> that holds most of the kept text is the article whatever stands beside it. If only
the page's body holds them all, each of its children is gone into by itself, and links in
a block go with the block.

Defined results: a null or empty page has an empty text; a page without any content path too;
character references are decoded; white space inside a block becomes one space; blocks are
joined by one space; repeated rows give the same text each. Each page is one row's work, so
hot hosts need no care.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption address summary".split())
#: Elements and words of class, id and role that mark what is not the article.
ASIDE = frozenset("nav footer aside form menu dialog button fieldset datalist head".split())
NOT_ARTICLE = frozenset((
    "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar masthead banner footer footnav sidebar aside rail "
    "ad ads adv advert advertisement adsense advertising sponsor sponsored promo promotion notice notices cookie cookies consent gdpr "
    "alert popup modal overlay dialog toast newsletter subscribe subscription signup login register search searchbox form "
    "comment comments commentlist respond disqus reply replies discussion share sharing social follow related recommended recommendations "
    "trending popular widget widgets toolbar pagination pager skip contentinfo complementary copyright legal disclaimer hidden").split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|=\s*[^\s>\"'][^\s>]*|[^>])*+)>", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
#: Of ``no-sidebar`` or ``hasComments`` the second word names what the element is not.
_ABOUT = re.compile(r"(?:\b|(?<=[-_]))(?:no|has|have|with|without|hide|show)[-_]?(?=[-_A-Z])[-_]?[A-Za-z]+")
#: Listed words that name readers' words.
READERS = frozenset("comment comments commentlist respond disqus reply replies discussion".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PUNCT = re.compile(r"[.,;:!?…。、，！？；：¿¡]")
#: What starts closes an open element of these.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "thead": {"thead", "tbody", "tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
_SCOPE = frozenset("table ul ol dl article section div main body td th".split())
KERNEL = np.array([0.25, 0.5, 0.25])
#: Share of the fused ratios' mean that a path must reach.
THRESHOLD = 0.2
#: Share of the kept text that an <article> or <main> must hold to be the only place looked at.
HOLDS = 0.7
TOP = frozenset(("#", "html", "body"))
LISTS = frozenset(("ul", "ol", "dl"))
BOXES = frozenset(("div", "section"))


class Page:
    """Elements (parent, name, aside, path) and text nodes (element, text, link, block) of a page."""

    def __init__(self, markup: str):
        self.parent, self.name, self.aside, self.path = [-1], ["#"], [False], [0]
        self.listed: list[str] = [""]  # why an element is aside by itself: "" (not), "name", "word" or "readers"
        self.inside, self.link = [False], [False]  # within an <article> or <main>; within a link
        self.paths: dict[tuple[int, str], int] = {}  # (path above, label) -> number of the path
        self.nodes: list[tuple[int, str, bool, int]] = []
        self.block = 0
        self._read(markup)
        self._set_aside()

    def _open(self, stack, name, attrs):
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs.strip(" /") else {}
        told = [_ABOUT.sub(" ", found[k]) for k in ("class", "id", "role") if k in found]
        words = {w.lower() for t in told for w in _PART.findall(t)}
        listed = (words | {w.lower() for t in told for w in t.split()}) & NOT_ARTICLE
        inside = self.inside[stack[-1]]
        why = ""
        if name not in ("html", "body", "article", "main"):
            if (name in ASIDE or "hidden" in found or found.get("aria-hidden") == "true"
                    or "display:none" in found.get("style", "").replace(" ", "").lower() or not inside and name == "header"):
                why = "name"
            elif listed or not inside and "header" in words:
                why = "readers" if listed & READERS else "word"
        self.listed.append(why)
        self.inside.append(inside or name in ("article", "main"))
        self.link.append(self.link[stack[-1]] or name == "a")
        self.parent.append(stack[-1])
        self.name.append(name)
        kind = ".".join(sorted(found.get("class", "").split()))
        above = self.path[stack[-1]]
        self.path.append(above if name in INLINE and name != "a" else
                         self.paths.setdefault((above, f"{name}.{kind}" if kind else name), len(self.paths) + 1))
        stack.append(len(self.name) - 1)

    def _text(self, stack, text):
        if text and not text.isspace():
            self.nodes.append((stack[-1], html.unescape(text), self.link[stack[-1]], self.block))
        elif text and self.nodes:
            self.nodes.append((stack[-1], " ", False, self.block))

    def _set_aside(self):
        """What is aside: elements by name always; by a listed word, those that don't hold most
        of the text outside the former, or that stand beside an <article> with text of its own.
        Readers' words go unless a headline or the article is in them."""
        n = len(self.name)
        gone = [False] * n
        for e in range(1, n):
            gone[e] = gone[self.parent[e]] or self.listed[e] == "name"
        held, own = [0] * n, [0] * n  # text; that of an <article> or <main>, without its headline
        head = [name in ("h1", "article", "main") for name in self.name]
        for e, text, link, _ in self.nodes:
            if not gone[e] and not link:
                held[e] += len(text.strip())
                own[e] += len(text.strip()) * (self.inside[e] and self.name[e] != "h1")
        for e in range(n - 1, 0, -1):  # children come after their parents
            above = self.parent[e]
            held[above] += held[e]
            own[above] += own[e]
            head[above] = head[above] or head[e]
        self.aside = gone
        for e in range(1, n):
            most = 2 * held[e] > held[0] and (head[e] or self.listed[e] != "readers" and own[e] == own[0])
            self.aside[e] = self.aside[e] or self.aside[self.parent[e]] or bool(self.listed[e]) and not most

    def _close_p(self, stack):
        for i in range(len(stack) - 1, 0, -1):
            if self.name[stack[i]] == "p":
                del stack[i:]
                return
            if self.name[stack[i]] in _SCOPE:
                return

    def _read(self, markup: str):
        stack, at, skip = [0], 0, None
        for m in _TOKEN.finditer(markup):
            if m.start() < at:
                continue
            if skip is None:
                self._text(stack, markup[at:m.start()])
            at = m.end()
            end, name = m[1], m[2]
            if name is None:
                continue
            name = name.lower()
            if end:
                if name not in INLINE:
                    self.block += 1
                for i in range(len(stack) - 1, 0, -1):
                    if self.name[stack[i]] == name:
                        del stack[i:]
                        break
                    if name in INLINE and self.name[stack[i]] not in INLINE:
                        break
                continue
            if name not in INLINE:
                self.block += 1
                self._close_p(stack)
            for_end = _CLOSES.get(name)
            if for_end:
                while len(stack) > 1 and (self.name[stack[-1]] in for_end or self.name[stack[-1]] in INLINE):
                    stack.pop()
            if name in RAW:
                if not m[3].rstrip().endswith("/"):
                    close = re.compile(rf"</{name}\s*>", re.I).search(markup, at)
                    at = close.end() if close else len(markup)
                continue
            if name in VOID:
                continue
            if name == "body" and self.name[stack[-1]] == "head":
                stack.pop()
            self._open(stack, name, m[3])
        self._text(stack, markup[at:])


def _joined(nodes) -> str:
    """Blocks with their white space turned into single spaces, joined by one space."""
    blocks: dict[int, list[str]] = {}
    for _, text, _, block in nodes:
        blocks.setdefault(block, []).append(text)
    return " ".join(t for t in (" ".join("".join(parts).split()) for parts in blocks.values()) if t)


def main_text(markup: str | None) -> str:
    if not markup:
        return ""
    page = Page(markup)
    nodes = [n for n in page.nodes if not page.aside[n[0]]]
    if not any(t.strip() for _, t, _, _ in nodes):
        return ""
    # sums per path
    length, punct, count = defaultdict(int), defaultdict(int), defaultdict(int)
    real = [n for n in nodes if n[1].strip()]
    paths = [page.path[e] for e, _, _, _ in real]
    size = [len(t.strip()) for _, t, _, _ in real]
    def up(e, names):
        while page.name[e] in names:
            e = page.parent[e]
        return e

    block = [up(e, INLINE) for e, _, _, _ in real]
    # an article may consist of links: where there is no other text, those in paragraphs count
    only = all(link for _, _, link, _ in real)
    for p, (e, t, link, _), k, b in zip(paths, real, size, block):
        count[p] += 1
        if not link or only and page.name[b] == "p":
            length[p] += k
            punct[p] += len(_PUNCT.findall(t))
    text_ratio = np.array([length[p] / count[p] for p in paths], float)
    punct_ratio = np.array([1 + punct[p] / count[p] for p in paths], float)

    def smooth(x):
        return np.convolve(np.pad(x, 1, mode="edge"), KERNEL, mode="valid")

    fused = smooth(text_ratio) * np.log1p(smooth(punct_ratio))
    total: dict = defaultdict(float)
    for p, f in zip(paths, fused):
        total[p] += f
    weight = np.array(size, float)
    bar = THRESHOLD * float((fused * weight).sum() / max(weight.sum(), 1))
    kept_paths = {p for p in total if length[p] and total[p] / count[p] >= bar}
    kept = [i for i, p in enumerate(paths) if p in kept_paths]
    if not kept:
        return ""
    # kept text and kept nodes within each element
    held: dict = defaultdict(float)
    n_kept: dict = defaultdict(int)
    children: dict = defaultdict(set)
    heading: dict = defaultdict(bool)
    for i, (e, _, _, _) in enumerate(real):
        held[e] += weight[i] if paths[i] in kept_paths else 0.0
        n_kept[e] += paths[i] in kept_paths
    for e in range(len(page.name) - 1, 0, -1):  # children come after their parents
        if e in held:
            above = page.parent[e]
            heading[e] = heading[e] or page.name[e] == "h1"
            held[above] += held[e]
            n_kept[above] += n_kept[e]
            heading[above] = heading[above] or heading[e]
            children[above].add(e)

    def holder(at):
        """The least element within ``at`` that holds all its kept nodes, above leaves and beside headlines."""
        while True:
            best = max(children[at], key=lambda c: n_kept[c], default=None)
            if best is None or n_kept[best] < n_kept[at] or page.name[best] in LEAF or page.name[best] in INLINE:
                return at
            if page.name[at] in ("article", "main") and page.name[best] not in ("article", "main"):
                return at
            if page.name[at] not in TOP and heading[at] and not heading[best]:
                return at  # the headline stands beside the text
            at = best

    marked = (e for e in sorted(held) if page.name[e] in ("article", "main") and held[e] >= HOLDS * held[0])
    at = holder(next(marked, 0))  # parents come first
    whole = page.name[at] not in TOP
    roots = {at} if whole else {holder(c) for c in children[at] if n_kept[c]}
    inside = [False] * len(page.name)
    for e in range(len(inside)):
        inside[e] = e in roots or e > 0 and inside[page.parent[e]]
    leaves = any(page.name[e] in LEAF and page.parent[e] == at for e in roots)

    first, last = kept[0], kept[-1]
    # within the article a bare box whose path's own ratios are below the bar is no text of it (smoothing has
    # lent it its neighbours'); headings, lists, cells are
    plain = {p for p in kept_paths if length[p] / count[p] * np.log1p(1 + punct[p] / count[p]) >= bar}
    full = {b for b, p in zip(block, paths) if p in plain}
    ok = [inside[e] and (p in plain or page.name[b] not in BOXES or b in full or b == at) for (e, _, _, _), p, b in zip(real, paths, block)]
    if not whole:
        # no single element holds the article: kept paths, what stands among them, and blocks beside kept blocks
        for i, (_, _, link, _) in enumerate(real):
            b = block[i]
            ok[i] = ok[i] or paths[i] in kept_paths or page.name[b] == "h1" or not link and (
                first < i < last or leaves and page.name[b] in LEAF and up(b, LEAF | LISTS) == at)
        taken = {b for b, (_, _, link, _), k in zip(block, real, ok) if k and not link}
        ok = [k or link and (page.path[b] in kept_paths or b in taken) for b, (_, _, link, _), k in zip(block, real, ok)]
    order = {id(n): i for i, n in enumerate(real)}
    out = []
    for n in nodes:
        i = order.get(id(n))
        if i is None:  # white space
            keep = inside[n[0]] if whole else bool(out) and out[-1][3] == n[3]
        else:
            keep = ok[i]
        if keep:
            out.append(n)
    return _joined(out)


def extract(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of the page in ``name``."""
    @F.pandas_udf("string")
    def of(markup: pd.Series) -> pd.Series:
        return markup.map(main_text)

    return pages.withColumn(name, of(F.coalesce(F.col(html_col), F.lit(""))))
