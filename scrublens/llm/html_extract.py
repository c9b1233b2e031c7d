"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text at its block elements. A classifier gives each block a
cost for being called content and one for being called boilerplate, from the elements around
it, its words and its links. These are the capacities of its edges to the two terminals of a
network. Neighbouring blocks are joined by an edge, and so is each block with its element and
each element with its parent: whoever separates them pays. The minimum cut, found by maximum
flow, is the labelling of least total cost; the blocks on the source's side are the text.

A page is one row and needs no other, so there is no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrublens.operators.columns import column

#: Elements by what they mean for the text inside.
DROPPED = frozenset(
    "head title script style noscript template svg math iframe object select textarea button "
    "canvas audio video".split()
)
#: Elements of other vocabularies, and others whose text is dropped, that a slash closes. A
#: slash means nothing to scripts and the like, as in browsers.
FOREIGN = frozenset(["svg", "math"])
CLOSED_BY_SLASH = FOREIGN | frozenset("iframe object select button canvas audio video".split())
#: Elements that may stand in a head; any other one, and text, ends it.
IN_HEAD = frozenset(
    "base basefont bgsound head link meta noframes noscript script style template title".split()
)
BOILERPLATE = frozenset("nav header footer aside menu dialog".split())
CONTENT = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Parts of class names and ids that name such elements.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies disqus footer header login masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination popup promo promoted related respond share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget".split()
)
CONTENT_NAMES = frozenset("article content entry main post story".split())
CONTENT_ROLES = frozenset(["main", "article"])
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
#: Elements that end an open element of these kinds before they begin.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}

#: What the elements around a block say. A form may be round a whole page, so it says little,
#: and what stands in it may say other than it.
NOT_TEXT, FORM, UNKNOWN, TEXT = -2, -1, 0, 1
#: Costs: an element that tells, and labels that differ between neighbours, a block and its
#: element, an element and its parent.
REGION = {NOT_TEXT: -120, FORM: -35, UNKNOWN: 0, TEXT: 120}
ADJACENT, IN_ELEMENT, IN_PARENT = 10, 20, 10

_NAME = re.compile(r"[a-z]+")


def _names(attrs: dict[str, str | None]) -> set[str]:
    found: set[str] = set()
    for key in ("class", "id"):
        for name in (attrs.get(key) or "").lower().split():
            parts = _NAME.findall(name)
            if parts and parts[0] not in ("has", "with", "no"):
                found.update(parts)
    return found


class Block:
    """Text of one block, the element it stands in, and what surrounds it."""

    __slots__ = ("element", "heading", "links", "parts", "region")

    def __init__(self, element: int, region: int, heading: bool) -> None:
        self.element, self.region, self.heading = element, region, heading
        self.parts: list[str] = []
        self.links = 0


class Page(HTMLParser):
    """Blocks of a page in order, and for each element the number of its parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.parents = [-1]
        # tag, element, region and whether text is dropped
        self.stack: list[tuple[str, int, int, bool]] = [("", 0, UNKNOWN, False)]
        self.open: Counter[str] = Counter()
        self.current: Block | None = None

    def pop_to(self, tags: set[str]) -> None:
        while True:
            tag = self.stack.pop()[0]
            self.open[tag] -= 1
            if tag in tags:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.stack[-1][0] == "head" and tag not in IN_HEAD or tag == "body" and self.open["head"] > 0:
            self.pop_to({"head"})
        if tag in BLOCK:
            self.current = None
            if self.open["p"] > 0:
                self.pop_to({"p"})
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        closed = CLOSES.get(tag)
        if closed and self.stack[-1][0] in closed:
            self.pop_to(closed)
        _, parent, region, dropped = self.stack[-1]
        given = dict(attrs)
        names = _names(given) if tag not in ("html", "body") else set()
        role = (given.get("role") or "").lower()
        if region != NOT_TEXT:
            if tag in BOILERPLATE or role in BOILERPLATE_ROLES:
                region = NOT_TEXT
            elif tag in CONTENT or role in CONTENT_ROLES:
                region = NOT_TEXT if names & {"comment", "comments"} else TEXT
            elif names & BOILERPLATE_NAMES and not names & CONTENT_NAMES:
                region = NOT_TEXT
            elif names & {"comment", "comments"}:
                region = NOT_TEXT
            elif tag == "form":
                region = FORM
            elif names & CONTENT_NAMES:
                region = TEXT
        hidden = "hidden" in given
        if tag in BLOCK:
            self.parents.append(parent)
            parent = len(self.parents) - 1
        self.stack.append((tag, parent, region, dropped or hidden or tag in DROPPED))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        foreign = any(self.open[name] > 0 for name in FOREIGN)
        self.handle_starttag(tag, attrs)
        if tag not in VOID and (foreign or tag in CLOSED_BY_SLASH):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.current = None
        if self.open[tag] > 0:
            self.pop_to({tag})

    def handle_data(self, data: str) -> None:
        if self.stack[-1][0] == "head" and data.strip():
            self.pop_to({"head"})
        _, element, region, dropped = self.stack[-1]
        if dropped:
            return
        if self.current is None:
            if not data.strip():
                return
            heading = any(self.open[f"h{i}"] > 0 for i in range(1, 7))
            self.current = Block(element, region, heading)
            self.blocks.append(self.current)
        self.current.parts.append(data)
        if self.open["a"] > 0:
            self.current.links += len(data)
        if region < self.current.region:
            self.current.region = region


def weight(block: Block, text: str) -> int:
    """Cost of calling the block boilerplate less that of calling it content."""
    words = text.count(" ") + 1
    found = REGION[block.region] + 2 * min(words, 40) - 15
    found -= 60 * min(block.links, len(text)) // max(len(text), 1)
    if text[-1] in ".!?…:;\"'»”":
        found += 10
    return found + 15 * block.heading


def minimum_cut(weights: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stand on the source's side of a minimum cut. A node of weight w > 0 has
    an edge of capacity w from the source, one of weight w < 0 an edge of -w to the sink;
    ``edges`` hold in both directions. Of several minimum cuts, the one with most nodes on
    the source's side. Maximum flow by levels (Dinic)."""
    nodes = len(weights)
    source, sink = nodes, nodes + 1
    out: list[list[int]] = [[] for _ in range(nodes + 2)]
    to: list[int] = []
    room: list[int] = []

    def join(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for node, w in enumerate(weights):
        if w > 0:
            join(source, node, w, 0)
        elif w < 0:
            join(node, sink, -w, 0)
    for a, b, w in edges:
        join(a, b, w, w)

    while True:
        level = [-1] * (nodes + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for e in out[node]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[node] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            break
        upcoming = [0] * (nodes + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if not room[e])
                node = to[path[first] ^ 1]
                del path[first:]
                continue
            while upcoming[node] < len(out[node]):
                e = out[node][upcoming[node]]
                if room[e] and level[to[e]] == level[node] + 1:
                    break
                upcoming[node] += 1
            else:
                if not path:
                    break
                node = to[path.pop() ^ 1]
                upcoming[node] += 1
                continue
            path.append(e)
            node = to[e]

    # What cannot reach the sink any more belongs to the source.
    reaches = [False] * (nodes + 2)
    reaches[sink] = True
    queue = deque([sink])
    while queue:
        node = queue.popleft()
        for e in out[node]:
            if room[e ^ 1] and not reaches[to[e]]:
                reaches[to[e]] = True
                queue.append(to[e])
    return [not r for r in reaches[:nodes]]


def main_text(html: str | None) -> str:
    """The text of a page: its content blocks, joined by a line break."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    page.close()
    found = [(block, " ".join("".join(block.parts).split())) for block in page.blocks]
    found = [(block, text) for block, text in found if text]
    weights = [weight(block, text) for block, text in found]
    if all(w < 0 for w in weights):
        return ""
    n = len(found)
    edges = []
    for i in range(1, n):
        # Blocks of a known and another region are not neighbours in the page's sense.
        if found[i - 1][0].region == found[i][0].region:
            edges.append((i - 1, i, ADJACENT))
    used: dict[int, int] = {}

    def node(element: int) -> int:
        """The node of an element; its way up to the root is joined once."""
        first = at = element
        while at not in used and at >= 0:
            used[at] = n + len(used)
            at = page.parents[at]
        at = first
        while at > 0 and at not in joined:
            joined.add(at)
            edges.append((used[at], used[page.parents[at]], IN_PARENT))
            at = page.parents[at]
        return used[first]

    joined: set[int] = set()
    for i, (block, _) in enumerate(found):
        edges.append((i, node(block.element), IN_ELEMENT))
    content = minimum_cut(weights + [0] * len(used), edges)
    return "\n".join(text for (_, text), kept in zip(found, content) if kept)


def extract_text(pages: DataFrame, html_col: str, text_col: str = "text") -> DataFrame:
    """``pages`` without ``html_col``, with ``text_col`` and ``n_chars``, its code points.

    A null or empty page, and one of boilerplate alone, gives an empty text. Menus, headers,
    footers, sidebars, notices, adverts, forms, scripts, styles and comments go; nothing
    else is left out, whatever the length. Character references are decoded, white space in
    a block becomes one space. Repeated rows give repeated rows, an empty table none; other
    columns stay as they are, except such named like the two new ones, which are replaced.
    """

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(html) for html in batch], dtype=object)

    others = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]
    found = pages.select(*map(column, others), extracted(column(html_col)).alias(text_col))
    return found.select("*", F.length(column(text_col)).cast("long").alias("n_chars"))
