"""Main text of web pages by composite text density.

A page is read into a flat list of nodes. Parts that are never article text (menus, headers and footers of the
page, scripts, styles) are cut by element. Forms and elements whose class, id or role names such a part (sidebars,
notices, adverts, reader comments) are cut only if the text agrees: they stay if they hold the article or most of the
page's characters outside links. For every remaining node the characters, tags, link characters and link tags below it give a
composite density: characters per tag, lowered the more of them are links. The density sum of a node adds the
densities of its children. The node with the largest sum is the core; the least density on its path to the body
is the threshold; every other branch that reaches the threshold adds its own core, and the article is the smallest
node that holds all cores.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import as_texts, map_texts, resident

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp", "noframes")
#: Elements that never hold article text.
OUTSIDE = frozenset(
    "head nav aside footer button select option input label menu dialog object embed applet canvas audio video map script style "
    "textarea title noscript iframe template svg xmp noframes".split()
)
#: Elements that hold a few fields or the whole page.
FORMS = frozenset(("form", "fieldset"))
#: Words of class, id or role that mark such parts.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted outbrain taboola "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar header masthead footer colophon sidebar side rail aside widget "
    "complementary contentinfo search form login signup newsletter subscribe subscription cookie cookies consent gdpr notice notices alert "
    "disclaimer popup modal overlay share sharing social related recommended recommendations comment comments commentlist disqus respond "
    "reply replies skip".split()
)
#: Marks of what others wrote or sell: often longer than the article, so they stay only where hardly anything else is.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted outbrain taboola cookie cookies consent gdpr "
    "comment comments commentlist disqus respond reply replies".split()
)
#: Before a mark: the element has such a part, or lacks it, but is none (has-sidebar, no-header).
STATES = frozenset("has have no non not with without hide hides".split())
#: With these words, and inside an article, a header is the article's own.
HEADS, ARTICLE = frozenset(("header", "masthead")), frozenset(("article", "entry", "post", "story"))
#: A start tag of the key closes an open element of the value.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",)}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[(?:.*?\]\]>|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_MARKED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE) for name in RAW}


def _marks(name: str, attributes: str, in_article: bool) -> frozenset | None:
    """None for an element that never holds article text, else the marks of its class, id and role."""
    if name in OUTSIDE or (name == "header" and not in_article):
        return None
    found = {name} if name in FORMS else set()
    if not attributes or name in ("html", "body", "article", "main"):
        return frozenset(found)
    if _HIDDEN.search(attributes):
        return None
    for m in _MARKED.finditer(attributes):
        for part in (m[1] or m[2] or m[3] or "").split():
            words = [w.lower() for w in _WORDS.findall(part)]
            state = next((i for i, w in enumerate(words) if w in STATES), len(words))
            own = in_article or not ARTICLE.isdisjoint(words)
            found.update(w for w in words[:state] if w in MARKS and not (own and w in HEADS))
    return frozenset(found)


class Page:
    """The nodes of a page in document order: parent, name, whether cut, and the text pieces with their node."""

    def __init__(self, html: str):
        self.parent, self.name, marks = [-1], ["#page"], [frozenset()]
        self.pieces: list[tuple[int, str]] = []  # (node, text); a block boundary is (node, None)
        open_nodes, at, in_article = [0], 0, 0
        find = _TOKEN.search
        while True:
            match = find(html, at)
            text = html[at : match.start()] if match else html[at:]
            if text:
                self.pieces.append((open_nodes[-1], text))
            if not match:
                break
            at = match.end()
            closing, name, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
            if not name:
                if match[0].startswith("<![CDATA["):
                    self.pieces.append((open_nodes[-1], match[0][9:].removesuffix("]]>")))
                continue
            if not match[0].endswith(">"):
                break  # a tag that the page's end cuts off
            name = name.lower()
            block = name in BLOCK
            if closing:
                if name == "br":
                    self.pieces.append((open_nodes[-1], " "))
                for depth in range(len(open_nodes) - 1, 0, -1):
                    opened = self.name[open_nodes[depth]]
                    if opened == name:
                        in_article -= sum(self.name[n] in ("article", "main") for n in open_nodes[depth:])
                        del open_nodes[depth:]
                        break
                    if opened in ("table", "td", "th") and name not in BLOCK:
                        break
                if block:
                    self.pieces.append((open_nodes[-1], None))
                continue
            if block:
                self._close(open_nodes, ("p",), ("table", "td", "th", "button", "object")) if name not in ("html", "body") else None
                if name in CLOSES:
                    self._close(open_nodes, CLOSES[name], SCOPE.get(name, ()))
            if name in ("html", "body") and name in (self.name[n] for n in open_nodes):
                continue
            if name in ("body",) and "head" in (self.name[n] for n in open_nodes):
                del open_nodes[next(i for i, n in enumerate(open_nodes) if self.name[n] == "head") :]
            node = len(self.name)
            self.parent.append(open_nodes[-1])
            self.name.append(name)
            marks.append(_marks(name, attributes, in_article > 0))
            if block:
                self.pieces.append((node, None))
            elif name == "br":
                self.pieces.append((node, " "))
            if name in RAW:
                end = _RAW_END[name].search(html, at)
                at = end.end() if end else len(html)
            elif name not in VOID and not attributes.endswith("/"):
                open_nodes.append(node)
                in_article += name in ("article", "main")

        self.cut = self._cut(marks)

    def _cut(self, marks: list[frozenset | None]) -> list[bool]:
        """Whether each node is cut: below an element that never holds article text, or below a marked one that the
        text does not speak for."""
        n, parent = len(self.name), self.parent
        holds, linked, hard = [name in ("article", "main") for name in self.name], [False] * n, [False] * n
        for i in range(n - 1, 0, -1):
            holds[parent[i]] |= holds[i]
        for i in range(1, n):
            linked[i] = linked[parent[i]] or self.name[i] == "a"
            hard[i] = hard[parent[i]] or marks[i] is None
        if not any(marks):
            return hard
        own = [0] * n
        for node, text in self.pieces:
            if text and not linked[node] and not hard[node]:
                own[node] += len(text.strip())

        def below(skip: list[bool]) -> tuple[list[int], list[int]]:
            """Characters outside links, and blocks with any, in each node and in the nodes below it."""
            chars = [0 if skip[i] else own[i] for i in range(n)]
            blocks = [int(chars[i] > 0 and self.name[i] in BLOCK) for i in range(n)]
            for i in range(n - 1, 0, -1):
                chars[parent[i]] += chars[i]
                blocks[parent[i]] += blocks[i]
            return chars, blocks

        chars, blocks = below(hard)
        foreign = [False] * n
        for i in range(1, n):
            alone = chars[i] * 10 >= chars[0] * 9 and blocks[i] > 3
            foreign[i] = foreign[parent[i]] or bool(marks[i] and marks[i] & FOREIGN and not holds[i] and not alone)
        chars, blocks = below(foreign)
        common: set[str] = set()  # marks of elements that together hold most of the page
        while True:
            cut, held, places = hard[:], Counter(), Counter()
            for i in range(1, n):
                p = parent[i]
                cut[i] |= cut[p] or foreign[i]
                left = not cut[i] and marks[i] and (marks[i] - FOREIGN) - common
                if left and not holds[i] and not (chars[i] * 2 > chars[0] and blocks[i] > (self.name[i] in BLOCK and own[i] > 0)):
                    cut[i] = True
                    for word in left:
                        held[word] += chars[i]
                        places[word] += 1 if chars[i] else 0
            found = {w for w in held if held[w] * 2 > chars[0] and places[w] > 1}
            if not found:
                return cut
            common |= found

    def _close(self, open_nodes: list[int], names: tuple, scope: tuple) -> None:
        for depth in range(len(open_nodes) - 1, 0, -1):
            name = self.name[open_nodes[depth]]
            if name in names:
                del open_nodes[depth:]
                return
            if name in scope or (name in BLOCK and name != "p" and "p" in names):
                return

    def _densities(self) -> tuple[list[float], list[float]]:
        n = len(self.name)
        chars, tags, link_chars, link_tags = [0] * n, [1] * n, [0] * n, [0] * n
        for node, text in self.pieces:
            if text and not self.cut[node]:
                chars[node] += len(text.strip())
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = self.name[i] == "a" or in_link[self.parent[i]]
            if in_link[i]:
                link_chars[i] = chars[i]
            link_tags[i] = int(self.name[i] == "a")
        for i in range(n - 1, 0, -1):
            if not self.cut[i]:
                p = self.parent[i]
                chars[p] += chars[i]
                tags[p] += tags[i]
                link_chars[p] += link_chars[i]
                link_tags[p] += link_tags[i]
        body = next((i for i in range(n) if self.name[i] == "body"), 0)
        share = link_chars[body] / chars[body] if chars[body] else 0.0
        density = [0.0] * n
        for i in range(n):
            if chars[i] and not self.cut[i]:
                other = max(1, chars[i] - link_chars[i])
                base = log(chars[i] / other * link_chars[i] + share * chars[i] + e)
                density[i] = chars[i] / tags[i] * log(chars[i] * tags[i] / (max(1, link_chars[i]) * max(1, link_tags[i])) + 1) / base
        total = [0.0] * n
        for i in range(1, n):
            total[self.parent[i]] += density[i]
        return density, [t or d for t, d in zip(total, density)]

    def article(self) -> int:
        """The smallest node that holds the core and every branch of at least its path's least density."""
        density, total = self._densities()
        n = len(self.name)
        core = max(range(n), key=lambda i: (total[i], -i))
        if not total[core]:
            return 0
        threshold, i = density[core], core
        while i > 0 and self.name[i] != "body":
            threshold = min(threshold, density[i])
            i = self.parent[i]
        body = i
        path = [core]
        while path[-1] != body and path[-1] > 0:
            path.append(self.parent[path[-1]])
        holds = {node: k for k, node in enumerate(path)}  # how far above the core
        reach = 0
        for i in range(n):
            if density[i] >= threshold and density[i] > 0 and self.parent[i] in holds and i not in holds:
                reach = max(reach, holds[self.parent[i]])
        while reach < len(path) - 1 and self.name[path[reach]] not in ("article", "main", "body") and any(
            self.name[p] in ("article", "main") for p in path[reach:]
        ):
            reach += 1
        return path[reach]

    def text(self) -> str:
        root = self.article()
        inside = [False] * len(self.name)
        inside[root] = True
        for i in range(root + 1, len(self.name)):
            inside[i] = inside[self.parent[i]]
        parts = [" " if t is None else t for node, t in self.pieces if t is None or (inside[node] and not self.cut[node])]
        return " ".join(unescape("".join(parts)).split())


def main_text(html: str) -> str:
    return Page(html).text() if html else ""


def main_texts(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars (code points), one row per row of `pages`.

    Null or empty html and pages without article text give the empty text. White space becomes one space, blocks
    are joined by one space in page order, character references are decoded. Works page by page, without a
    shuffle; the whole html is read.
    """

    def make():
        resident(None, None)
        def step(values: pa.Array):
            texts = [main_text(h) for h in as_texts(values)]
            return pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())

        return step

    return map_texts(pages, {"page_id": page_id, "url": url}, F.col(html), make, "text string, n_chars long")
