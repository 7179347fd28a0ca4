"""Main text of web pages from parser events, by text-to-tag ratio.

Events become blocks of text and a tree of the elements around them. Names such as ``sidebar`` and elements such as ``nav``
are evidence that a part is no article; it weighs against the share of the text that the part holds, so a page whose
whole body lies in a form or in a nav that was never closed keeps its article.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.tasks import Batches, map_batches, only

# Elements whose content is never text of a page.
DROPPED = frozenset(
    "head title script style noscript template button select textarea option input datalist iframe object embed canvas svg math map audio video".split()
)
# Elements that start and end a block of text.
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption hr address details summary hgroup center fieldset legend nav header footer aside form dialog menu".split()
)
# Elements that stand beside an article by their meaning.
BESIDE = frozenset("nav header footer aside form dialog menu".split())
# Elements that can be the container of an article inside the body; the first two are taken whole.
FRAMES = ("article", "main")
CONTAINERS = frozenset((*FRAMES, *"section div td center fieldset form nav header footer aside dialog".split()))
# Elements that hold several blocks; of the other named ones only short ones go.
HOLDERS = CONTAINERS | BESIDE | frozenset("ul ol dl table thead tbody tfoot tr details hgroup figure".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
INLINE = frozenset("span a ins em strong small b i label".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# What may stand in a head; any other element or text ends one that is still open.
HEADING = frozenset("html head base basefont bgsound link meta title style script noscript template".split())
# Elements with optional end tags: a start tag ends open elements of these names, up to the nearest element of the second set
# (parts of tables, options) or up to one that is in neither (lists).
_CELLS, _PASSED = frozenset("td th caption".split()), frozenset("address div p".split())
ENDS = {
    "li": ("li",), **dict.fromkeys(("dt", "dd"), ("dt", "dd")), "option": ("option",),
    **dict.fromkeys(("td", "th"), tuple(_CELLS)), "tr": (*_CELLS, "tr"), **dict.fromkeys(("thead", "tbody", "tfoot"), (*_CELLS, "tr", "thead", "tbody", "tfoot")),
}
BEYOND = {**dict.fromkeys("td th tr thead tbody tfoot".split(), ("table",)), "option": ("select", "datalist")}
# Words in class, id or role that mark parts around an article, words that mark the article itself, and words that turn a
# name into a remark on the layout ("with-sidebar", "hidden-xs").
AROUND = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead banner footer contentinfo sidebar aside complementary widget "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe signup login search searchbox form social share sharing related recommended "
    "respond disqus reply replies pagination pager copyright legal disclaimer skip toolbar hidden".split()
)
WITHIN = frozenset("content main article post entry story body text page prose container wrapper layout".split())
REMARKS = frozenset("with has have no not without is if xs sm md lg xl xxl open closed enabled disabled".split())
# Of these, the words that count on runs of words inside a block, and on headings.
CLEAR = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo share sharing".split())
# Beginnings of words for reader comments.
COMMENT = ("comment", "disqus")
# A part with evidence goes if it holds at most this share of the text around it: by its element's meaning or comment
# names, by other names, and for single paragraphs, items and headings.
LIMITS = CLOSED, NAMED, SMALL = 0.9, 0.5, 0.25
# Width of the Gaussian that smooths the ratios, in blocks.
SIGMA = 1.0
# A region's container is the innermost element that holds this share of the text found.
SHARE = 0.8
FEED = 1 << 16

_WORDS = re.compile(r"[a-z0-9]+")


@dataclass
class Element:
    """An element of block level: number of the one around it (-1: none), blocks from ``first`` to before ``last``, and the
    share of the text it may hold at most to be left out (0: no evidence against it)."""

    tag: str
    parent: int
    first: int
    limit: float = 0.0
    last: int = 0


@dataclass
class Block:
    """One run of text between block tags, in the innermost element ``home``; ``place`` is its number on the page."""

    home: int
    place: int = 0
    parts: list[str] = field(default_factory=list)
    tags: int = 1
    linked: int = 0
    text: str = ""


class Reader(HTMLParser):
    """Turns parser events into blocks and elements, with a few steps per event however deep elements are nested."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self.open: list[int] = []
        # Places in ``open`` of the elements of each name, and of those that end the search for an open li, or dt and dd.
        self.places: dict[str, list[int]] = {}
        self.walls: dict[str, list[int]] = {"li": [], "dt": []}
        self.skipping = 0
        self.links = 0
        self.inline: tuple[str, int] | None = None
        self.blocks: list[Block] = []
        self.block = Block(-1)

    def _cut(self) -> None:
        if self.block.parts:
            self.block.text = " ".join("".join(self.block.parts).split())
            if self.block.text:
                self.block.parts, self.block.place = [], len(self.blocks)
                self.blocks.append(self.block)
        self.inline = None
        self.block = Block(self.open[-1] if self.open else -1)

    def _push(self, tag: str, limit: float) -> None:
        self._cut()
        at = len(self.open)
        self.places.setdefault(tag, []).append(at)
        for name, walls in self.walls.items():
            if tag not in ENDS[name] and tag not in _PASSED:
                walls.append(at)
        self.open.append(len(self.elements))
        self.elements.append(Element(tag, self.block.home, len(self.blocks), limit))
        self.skipping += tag in DROPPED
        self.block.home = self.open[-1]

    def _pop(self, depth: int) -> None:
        """Ends all elements from this depth on."""
        self._cut()
        while len(self.open) > depth:
            ended = self.elements[self.open.pop()]
            ended.last = len(self.blocks)
            self.places[ended.tag].pop()
            for walls in self.walls.values():
                if walls and walls[-1] == len(self.open):
                    walls.pop()
            self.skipping -= ended.tag in DROPPED
        self.links = 0
        self.block.home = self.open[-1] if self.open else -1

    def _last(self, *tags: str) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def handle_starttag(self, tag: str, attrs) -> None:
        self.block.tags += 1
        if tag == "br":
            self.block.parts.append(" ") if not self.skipping and self.block.parts else None
        if tag == "a":
            self.links += 1
        self._end_open(tag)
        if tag in BLOCKS or tag in DROPPED:
            if self.open and self.elements[self.open[-1]].tag == "p":
                self._pop(len(self.open) - 1)
            if tag in VOID:
                self._cut()
            else:
                self._push(tag, self._limit(tag, dict(attrs)))
        elif tag in INLINE and not self.skipping:
            if self.inline:
                self.inline = (self.inline[0], self.inline[1] + (tag == self.inline[0]))
            elif self._against(tag, dict(attrs)):
                self.inline = (tag, 1)

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag in VOID or tag not in BLOCKS | DROPPED | INLINE:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.block.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if self.inline and tag == self.inline[0]:
            self.inline = (tag, self.inline[1] - 1) if self.inline[1] > 1 else None
        if (at := self._last(tag)) >= 0:
            self._pop(at)

    def _end_open(self, tag: str) -> None:
        """Closes the elements whose end tag is left out before this start tag."""
        if tag not in HEADING and self.open and self.elements[self.open[-1]].tag == "head" or tag == "body" and self.places.get("head"):
            self._pop(self.places["head"][0])
        elif tag in ENDS:
            wall = self._last(*BEYOND[tag]) if tag in BEYOND else max(self.walls["li" if tag == "li" else "dt"][-1:], default=-1)
            found = [p[i] for t in ENDS[tag] if (p := self.places.get(t)) and (i := bisect_right(p, wall)) < len(p)]
            if found:
                self._pop(min(found))

    def handle_data(self, data: str) -> None:
        if self.open and self.elements[self.open[-1]].tag == "head" and not data.isspace():
            self._pop(len(self.open) - 1)
        if not self.skipping and not self.inline:
            self.block.parts.append(data)
            if self.links:
                self.block.linked += len(data)

    def _limit(self, tag: str, attrs: dict) -> float:
        """The largest share of the text that an element may hold to be left out."""
        if tag in ("html", "body", "main") or tag in DROPPED:
            return 0.0
        if tag in BESIDE and not (tag == "header" and self.places.get("article")):
            return CLOSED
        found = self._against(tag, attrs)
        return found and (CLOSED if found == "comment" else NAMED if tag in HOLDERS or found == "hidden" else SMALL)

    def _against(self, tag: str, attrs: dict) -> str | float:
        """``comment``, ``hidden`` or ``named`` if the attributes speak against an element, else 0."""
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return "hidden"
        keys = ("class", "role") if tag == "section" or tag not in HOLDERS else ("class", "id", "role")
        names = [_WORDS.findall(n) for k in keys for n in (attrs.get(k) or "").lower().split()]
        names = [n for n in names if n and REMARKS.isdisjoint(n)]
        if any(w.startswith(COMMENT) for n in names for w in n):
            return "comment"
        if tag == "article" or any(w in WITHIN for n in names for w in n):
            return 0.0
        words = CLEAR if tag in INLINE or tag in HEADINGS else AROUND
        if tag == "li" and any(t in self.places for t in FRAMES):
            words = words - {"share", "sharing"}
        return "named" if any(n[0] in words or n[-1] in words for n in names) else 0.0


def read(html: str) -> tuple[list[Block], list[Element]]:
    """The blocks of a page that hold text, in page order, and its elements, outer ones first."""
    reader = Reader()
    for i in range(0, len(html), FEED):
        reader.feed(html[i : i + FEED])
    reader.close()
    reader._pop(0)
    return reader.blocks, reader.elements


def article(blocks: list[Block], elements: list[Element]) -> list[Block]:
    """The blocks outside parts with evidence against them.

    A part goes if its share of the text without links, in the article or main around it, else in the page, is
    within its limit. Where that would leave nothing, everything stays.
    """
    weight = np.cumsum([0, *(max(0, len(b.text) - b.linked) for b in blocks)])
    held = lambda e: int(weight[e.last] - weight[e.first])
    gone, frame = [], []
    for e in elements:
        around = frame[e.parent] if e.parent >= 0 else int(weight[-1])
        lost = e.parent >= 0 and gone[e.parent]
        gone.append(lost or e.limit > 0 and held(e) <= e.limit * max(around, 1))
        frame.append(held(e) if e.tag in FRAMES and held(e) else around)
    kept = [b for b in blocks if b.home < 0 or not gone[b.home]]
    return kept or blocks


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel is cut and weighed anew."""
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, "full")[reach:-reach]
    return np.convolve(values, kernel, "full")[reach:-reach] / weight


def select(blocks: list[Block], elements: list[Element]) -> list[Block]:
    """The blocks of the content region.

    Each block has its characters per tag; the smoothed ratios are split at half their mean into content and
    the rest. The region is the outermost article or main element that holds most of the content found, or else the innermost
    container that does, widened to outer containers that add few links and to content blocks next to it. Inside an article or main every block stays,
    inside another region all but low blocks that consist of links.
    """
    if not blocks:
        return []
    ratio = smooth(np.array([max(0, len(b.text) - b.linked) / b.tags for b in blocks]))
    high = ratio >= max(ratio.mean() / 2, 1e-9)
    if not high.any():
        return blocks
    weight = np.zeros(len(elements) + 1, np.int64)
    for block, dense in zip(blocks, high):
        if dense:
            weight[block.home] += len(block.text)
    for at in range(len(elements) - 1, -1, -1):
        weight[elements[at].parent] += weight[at]
    # Elements that hold most of the text lie inside each other, inner ones later.
    held = [at for at in np.flatnonzero(weight[:-1] >= SHARE * weight[-1]) if elements[at].tag in CONTAINERS]
    framed = [at for at in held if elements[at].tag in FRAMES]
    place = np.array([b.place for b in blocks])
    inside = lambda at: np.searchsorted(place, (elements[at].first, elements[at].last))
    if framed:
        first, last = inside(framed[0])
        return blocks[first:last]
    length, linked = np.array([len(b.text) for b in blocks]), np.array([b.linked for b in blocks])
    sums = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum([length, linked], axis=1)], axis=1)
    first, last = 0, len(blocks)
    if held:
        first, last = inside(held[-1])
        for outer in held[-2::-1]:
            start, end = inside(outer)
            more, links = (sums[:, end] - sums[:, start]) - (sums[:, last] - sums[:, first])
            if 5 * links > more:
                break
            first, last = start, end
    region = np.zeros(len(blocks), bool)
    region[first:last] = True
    prose = high & (2 * linked <= length)
    while first > 0 and prose[first - 1]:
        first -= 1
        region[first] = True
    while last < len(blocks) and prose[last]:
        region[last] = True
        last += 1
    return [b for b, stays, kept in zip(blocks, region, high | (2 * linked <= length)) if stays and kept]


def main_text(html: str | None) -> str:
    """The article of a page: white space inside a block is one space, blocks are joined by an empty line.

    Null and empty pages, and pages without text outside dropped elements, give an empty text. A page whose every part
    has evidence against it is judged as if none had.
    """
    blocks, elements = read(html or "")
    return "\n\n".join(b.text for b in select(article(blocks, elements), elements))


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` of every page. Pages are read one by one inside the tasks;
    nothing is shuffled, repeated rows come back as often as they went in, an empty table gives no rows."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(len(keep)).to_pylist()]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], *made], [*keep, "text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in only(pages, *keep).schema]
    return map_batches(only(pages, *keep, html), work, ", ".join([*fields, "text string", "n_chars bigint"]), 500)
