"""Main text of web pages by composite text density.

For every node of the page's tree, with ``C`` characters and ``T`` tags below
it, of which ``LC`` characters and ``LT`` tags belong to links, and ``n`` its
characters outside of links, the density is

    D = C / T * log(C / LC * T / LT) / log(ln(C / n * LC + LCb / Cb * C + e))

(counts of 0 taken as 1; ``LCb`` and ``Cb`` are those of the body): characters
per tag, lowered where the characters are links.  A container's density sum is
the sum of the densities of its blocks; an ``article`` or ``main`` element adds
the largest sum inside it to its own, so it comes before its parts, but not
before a denser container outside.  The container with the largest sum is
the core of the article; the threshold is the least density on the path from
it to the body, and at every step of that path sibling blocks at or above the
threshold belong to the article too.

Elements that are never article text by their name (menus, footers, asides,
controls, scripts, styles) and reader comments are taken out first.  A form, a
page header and an element with a word in class, id or role that marks menus,
sidebars, notices, adverts and the like stays if it holds an outermost
``article`` or ``main`` or, on a page without such, more than half of the text
outside of links: a layout class, or a form around a whole page, says nothing
about the text.  Heads stay inside an ``article``.  A head ends at the first element that
cannot stand in one.  What is kept loses no block, however short.

Character references are decoded, white space inside a block becomes one space
and is trimmed (a line break element is white space), and non-empty blocks are
joined in page order by a line feed.  Null or empty html, and a page without
text, give an empty text.  Rows are handled one by one, so repeated rows come
back repeatedly; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import deque
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose text is never article text.
OUT = frozenset("script style noscript template head title nav footer aside button select option textarea input "
                "iframe object embed svg canvas audio video map dialog menu".split())
#: Elements that a head may hold.
IN_HEAD = frozenset("head title base link meta style script noscript template".split())
#: Words of class, id or role that mark an element as no article text.
OUT_WORDS = frozenset(
    "hidden nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer sidebar aside complementary "
    "banner ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login form search share sharing "
    "social related recommended comment comments disqus respond reply replies contentinfo copyright pagination pager".split())
OUT_COMMENTS = frozenset("comment comments disqus respond reply replies".split())
#: Marks of a page's head, which inside an article may hold its title.
OUT_HEADS = frozenset("header masthead topbar".split())
#: Start tags that end an open paragraph.
BREAKS_P = frozenset("address article aside blockquote body center details dialog dir div dl dd dt fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
#: Start tags that end an open element of the named kinds.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
STOPS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
         "thead": ("table",), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}
_WORD = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "out", "marked", "outermost", "inline", "parent", "holder", "items", "own", "plain", "c", "t", "lc", "lt", "density",
                 "total", "best")

    def __init__(self, tag: str, parent: "Node | None"):
        self.tag, self.parent = tag, parent
        self.out = tag in OUT
        self.inline = tag in INLINE
        #: The nearest block around.
        self.holder = parent if parent is None or not parent.inline else parent.holder or parent
        self.marked = False  # out if it holds little of the page
        self.outermost = False  # an article or main that is in no other, or holds one
        self.items: list[Node | str] = []
        self.own = self.plain = self.c = self.t = self.lc = self.lt = 0
        self.density = self.total = self.best = 0.0


class Tree(HTMLParser):
    """Nodes of one page; elements that are left open end with their parent.

    The places of the open elements of each name are kept, so that a tag costs
    no walk over the open elements, however deep the page is."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", None)
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}
        self.body: Node | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in IN_HEAD and self.places.get("head"):
            self._end_upto(("head",), ())
        if tag in BREAKS_P:
            self._end_upto(("p",), ("td", "th", "button", "table") if tag != "table" else ("td", "th", "button"))
        if tag in ENDS:
            for kind in ENDS[tag]:
                self._end_upto((kind,), STOPS[tag])
        top = self.open[-1]
        node = Node(tag, top)
        if not node.out and (marks := self._marks(tag, attrs)):
            node.out = not OUT_COMMENTS.isdisjoint(marks)
            node.marked = not node.out
        if tag in ("article", "main") and not node.out:
            node.outermost = not (self.places.get("article") or self.places.get("main"))
        top.items.append(node)
        if tag == "body" and self.body is None:
            self.body = node
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self._end_upto((tag,), ("td", "th", "table") if tag in ("p", "li", "div") else ())

    def handle_data(self, data: str) -> None:
        self.open[-1].items.append(data)

    def _end_upto(self, tags: tuple, stops: tuple) -> None:
        """Ends the innermost open element of ``tags`` unless one of ``stops``
        was opened after it."""
        at, stop = (max((p[-1] for t in names if (p := self.places.get(t))), default=0) for names in (tags, stops))
        if at > stop:
            while len(self.open) > at:
                self.places[self.open.pop().tag].pop()

    def _marks(self, tag: str, attrs: list) -> set:
        """The words of class, id or role, or the name, that speak against the
        element."""
        if tag in ("html", "body", "main"):
            return set()
        words = {w for k, v in attrs if k in ("class", "id", "role") and v for w in _words(v)}
        if tag in ("header", "form"):
            words.add("header" if tag == "header" else "login")
        if any(k == "hidden" for k, _ in attrs):
            words.add("hidden")
        marks = words & (OUT_COMMENTS if tag == "article" else OUT_WORDS)
        if not marks.isdisjoint(OUT_HEADS) and self.places.get("article"):
            marks -= OUT_HEADS
        return marks


def _words(value: str) -> list[str]:
    return _WORD.findall(_CAMEL.sub(" ", value).lower())


def _ordered(root: Node) -> list[Node]:
    """Nodes that count, every one after its parent."""
    out = [root]
    for node in out:
        out.extend(x for x in node.items if type(x) is Node and not x.out)
    return out


def _settle(nodes: list[Node]) -> None:
    """Decides which marked elements are out, from what they hold."""
    for node in reversed(nodes):
        node.own = sum(len(" ".join(x.split())) for x in node.items if type(x) is str)
        node.plain = 0 if node.tag == "a" else node.plain + node.own
        if node.parent is not None:
            node.parent.plain += node.plain
            node.parent.outermost = node.parent.outermost or node.outermost
    for node in nodes:
        node.out = node.marked and not node.outermost and (nodes[0].outermost or 2 * node.plain <= nodes[0].plain)


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        node.c += node.own
        if node.tag == "a":
            node.lc, node.lt = node.c, node.t + 1
        if node.parent is not None:
            up = node.parent
            up.c += node.c
            up.t += node.t + 1
            up.lc += node.lc
            up.lt += node.lt
    body = nodes[0]
    share = body.lc / max(body.c, 1)
    for node in reversed(nodes):
        if node.c:
            lc, lt, t, plain = max(node.lc, 1), max(node.lt, 1), max(node.t, 1), max(node.c - node.lc, 1)
            base = math.log(node.c / plain * lc + share * node.c + math.e)
            node.density = node.c / t * max(0.0, math.log(node.c / lc * t / lt) / math.log(base))
        if node.tag in ("article", "main"):
            node.total += node.best
        node.best = max(node.best, node.total)
        if node.parent is not None:
            node.parent.best = max(node.parent.best, node.best)
        if node.holder is not None and not node.inline:
            node.holder.total += node.density


def _write(node: Node, keep: set | None, blocks: list[list[str]]) -> None:
    """Texts of ``node`` block by block (explicit stack: pages can be deep)."""
    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        node, i = stack.pop()
        if i == 0 and not node.inline:
            blocks.append([])
        while i < len(node.items):
            x = node.items[i]
            i += 1
            if type(x) is str:
                blocks[-1].append(x)
            elif x.tag == "br":
                blocks[-1].append(" ")
            elif not x.out and (keep is None or id(x) in keep):
                stack.append((node, i))
                stack.append((x, 0))
                break
        else:
            if not node.inline:
                blocks.append([])


def main_text(html: str | None) -> str:
    """The article of one page."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    body = tree.body or tree.root
    body.parent, body.holder, body.out, body.marked = None, None, False, False
    _settle(_ordered(body))
    nodes = _ordered(body)
    _measure(nodes)
    core = max(nodes, key=lambda x: (not x.inline, x.total))
    if not core.c:
        core = body
    path, up = [], core
    while up is not None:
        path.append(up)
        up = up.parent
    least = min(x.density for x in path)
    parts = deque([core])
    for child, up in zip(path, path[1:]):
        own = [x for x in up.items if type(x) is Node and not x.out and not x.inline]
        at = own.index(child) if child in own else 0
        near = [x.c > 0 and x.density >= least for x in own]
        parts.extendleft(x for x, ok in zip(own[at - 1 :: -1] if at else [], near[at - 1 :: -1]) if ok)
        parts.extend(x for x, ok in zip(own[at + 1 :], near[at + 1 :]) if ok)
    blocks: list[list[str]] = []
    for part in parts:
        _write(part, None, blocks)
    return "\n".join(x for x in (" ".join("".join(b).split()) for b in blocks) if x)


def main_texts(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, url, text, n_chars) of every page; no shuffle."""

    def extract(part: dict) -> dict:
        found = [main_text(x) for x in part["html"]]
        return {key: part[key], "url": part["url"], "text": found, "n_chars": [len(x) for x in found]}

    own = pages.select(F.col(key).cast("long").alias(key), F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    return map_batches(own, extract, f"`{key}` long, url string, text string, n_chars long")
