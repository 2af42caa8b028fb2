"""Main text of web pages by a minimum cut between content and boilerplate."""

from __future__ import annotations

import re
from collections import Counter, deque
from html.parser import HTMLParser
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_batches

# What HTML elements mean, and words in class and id names.
UNSEEN = {"head", "iframe", "noscript", "object", "script", "style", "svg", "template", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q",
    "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
HOLDS = {"article", "aside", "body", "div", "dl", "footer", "form", "header", "main", "nav", "ol", "section", "table", "ul"}
PLAIN_ELEMENTS = {"article", "main"}
OTHER_ELEMENTS = {
    "aside", "button", "dialog", "fieldset", "footer", "form", "label", "legend", "menu", "nav", "option", "select", "textarea",
}
PLAIN_NAMES = {"article", "articlebody", "content", "entry", "main", "post", "story"}
OTHER_NAMES = {
    "ad", "ads", "advert", "advertisement", "aside", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "form", "login", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "recommended", "related", "replies", "reply",
    "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NAME_PART = re.compile(r"[a-z]+")
SENTENCE_END = (".", "!", "?", "…", ":", "”", '"')

HINT, HEADING, LONG, ENDED, LINKED, OUTSIDE, START = 4.0, 1.0, 1.5, 0.5, -3.0, -2.5, -0.5  # log odds
NEXT, KIN = 0.8, 0.6  # smoothness of neighbours and of blocks under one parent


class Element(NamedTuple):
    """An open element and what its block's score needs of those around it."""

    tag: str
    number: int
    hint: int  # the nearest one that says anything, itself included
    heading: bool  # in a heading
    article: bool  # in something that says content


class Blocks(HTMLParser):
    """A page as blocks of text, each with its place among the elements and its linked share."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.path: list[Element] = []
        self.outer: list[int] = []  # numbers of the open elements that aren't inline
        self.open: Counter[str] = Counter()
        self.blocks: list[dict] = []
        self.parts: list[str] = []
        self.linked = self.unseen = self.number = 0
        self.common = 0  # outer elements that have stayed open since the last block

    def parse_html_declaration(self, i: int) -> int:
        """A declaration that has no name is a comment, as browsers read it."""
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                at = self.path[-1] if self.path else Element("", 0, 0, False, False)
                parent = self.outer[-2] if len(self.outer) > 1 else 0
                self.blocks.append({"text": text, "at": at, "depth": len(self.outer), "common": self.common, "parent": parent, "linked": self.linked})
                self.common = len(self.outer)
            self.parts = []
        self.linked = 0

    def _pop_to(self, at: int) -> None:
        for element in self.path[at:]:
            self.open[element.tag] -= 1
            self.unseen -= element.tag in UNSEEN
            if element.tag not in INLINE:
                self.outer.pop()
        self.common = min(self.common, len(self.outer))
        del self.path[at:]

    def _find(self, tags: set[str], stop: set[str]) -> int | None:
        if not any(self.open[tag] for tag in tags):
            return None
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i].tag in tags:
                return i
            if self.path[i].tag in stop:
                return None
        return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._end_block()
            return
        if tag not in INLINE:
            self._end_block()
            # A paragraph ends where a block begins; list items and cells where the next does.
            closed = self._find({"p"}, HOLDS | {"li", "td"}) if tag not in UNSEEN else None
            if closed is not None:
                self._pop_to(closed)
            if tag in CLOSED_BY:
                closed = self._find(CLOSED_BY[tag], {"ul", "ol", "dl", "table", "select"} - {tag})
                if closed is not None:
                    self._pop_to(closed)
            if tag == "body" and (at := self._find({"head"}, set())) is not None:
                self._pop_to(at)
        self.number += 1
        around = self.path[-1] if self.path else Element("", 0, 0, False, False)
        own = self._hint(tag, attrs)
        if tag in INLINE:  # says nothing of a block
            element = Element(tag, self.number, *around[2:])
        else:
            element = Element(tag, self.number, own or around.hint, around.heading or tag in HEADINGS, around.article or own == 1)
            self.outer.append(self.number)
        self.path.append(element)
        self.open[tag] += 1
        self.unseen += tag in UNSEEN

    def _hint(self, tag: str, attrs: list) -> int:
        if tag in OTHER_ELEMENTS:
            return -1
        if tag == "header":
            return 0 if any(self.open[t] for t in PLAIN_ELEMENTS) else -1
        names: set[str] = set()
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names.update(NAME_PART.findall(value.lower()))
        if tag not in ("html", "body"):
            if names & OTHER_NAMES:
                return -1
            if names & PLAIN_NAMES:
                return 1
        return 1 if tag in PLAIN_ELEMENTS else 0

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in UNSEEN:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_block()
        at = self._find({tag}, HOLDS if tag in INLINE or tag == "p" else set())
        if at is not None:
            self._pop_to(at)

    def handle_data(self, data: str) -> None:
        if self.unseen:
            return
        self.parts.append(data)
        if self.open["a"]:
            self.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._end_block()


def log_odds(block: dict, has_article: bool) -> float:
    """How much a block looks like content (over 0) rather than boilerplate."""
    text, at = block["text"], block["at"]
    # What stands in a menu, a form or a comment isn't content, whatever stands around it.
    odds = START + HINT * at.hint + LONG * min(1.0, (text.count(" ") + 1) / 20) + ENDED * text.endswith(SENTENCE_END)
    odds += LINKED * min(1.0, block["linked"] / len(text)) + HEADING * at.heading
    return odds + (OUTSIDE if has_article and at.hint != 1 else 0.0)


def smoothness(blocks: list[dict]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, by the share of their paths, and to the last block of a parent."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT * block["common"] / max(block["depth"], blocks[i - 1]["depth"], 1)))
        parent = block["parent"]
        if parent in last and last[parent] != i - 1:
            edges.append((last[parent], i, KIN))
        last[parent] = i
    return [e for e in edges if e[2] > 0]


def minimum_cut(terminal: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut.

    ``terminal`` is a node's capacity from the source less that to the sink. Each node with
    spare capacity from the source pushes flow along shortest paths to the nearest nodes
    with spare capacity to the sink. When none can be reached, all that it reaches is on
    the source's side, and no later path can lead through there, so these nodes are closed:
    searches stay near their source and a closed node is never seen again.
    """
    spare = list(terminal)
    room: list[dict[int, float]] = [{} for _ in terminal]
    for a, b, w in edges:
        room[a][b] = room[a].get(b, 0.0) + w
        room[b][a] = room[b].get(a, 0.0) + w
    closed = [False] * len(spare)
    for source in range(len(spare)):
        while spare[source] > 1e-12 and not closed[source]:
            parent, queue, end = {source: source}, deque([source]), None
            while queue and end is None:
                a = queue.popleft()
                for b, w in room[a].items():
                    if w > 1e-12 and b not in parent and not closed[b]:
                        parent[b] = a
                        if spare[b] < -1e-12:
                            end = b
                            break
                        queue.append(b)
            if end is None:
                for a in parent:
                    closed[a] = True
                break
            path = [end]
            while parent[path[-1]] != path[-1]:
                path.append(parent[path[-1]])
            path.reverse()
            push = min(spare[source], -spare[end], *[room[a][b] for a, b in zip(path, path[1:], strict=False)])
            spare[source] -= push
            spare[end] += push
            for a, b in zip(path, path[1:], strict=False):
                room[a][b] -= push
                room[b][a] += push
    return closed


def main_text(html: str | None) -> str:
    """The page's content blocks, one per line."""
    if not html:
        return ""
    parser = Blocks()
    parser.feed(html)
    parser.close()
    blocks = parser.blocks
    has_article = any(b["at"].article for b in blocks)
    odds = [log_odds(b, has_article) for b in blocks]
    keep = minimum_cut(odds, smoothness(blocks))
    return "\n".join(b["text"] for b, k in zip(blocks, keep, strict=True) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A page's blocks are nodes. A classifier's log odds are their capacities to the two
    terminals; neighbours and blocks under one parent are joined by smoothness edges; the
    minimum cut separates content from boilerplate. Character references are decoded,
    white space inside a block is one space, blocks stand in page order, one a line. Pages
    are independent: nothing is shuffled, a task holds one batch of pages, and the flow
    network has about two edges per block.

    A null, empty or broken page gives the text that can be read, else an empty string with
    0 characters. Repeated rows and null ids keep their rows; an empty table gives an empty
    one; further columns are ignored.
    """

    def start():
        return lambda rows: {"text": [main_text(h) for h in rows]}

    made = map_batches(pages.select("page_id", "url", "html"), start, "text string", over="html")
    return made.withColumn("n_chars", F.length("text").cast("long"))
