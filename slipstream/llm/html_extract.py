"""Main text of web pages by text-to-tag ratios.

The standard library's parser reads a page as a stream of events. Every block-level tag begins a line; a line's ratio is
its characters of text over its tags. Lines inside elements that hold no article text (menus, forms, scripts and so on, by
tag, role or name) count no text. The ratios are smoothed with a Gaussian; consecutive lines over a threshold of the page's own
deviation are a cluster. The clusters that hold a share of the content decide: the lowest common ancestor of their lines of
text and headings is the content region, whatever it is called. Every block of the region is kept, short ones too, except
those in elements without article text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.arrowtext import slices

RADIUS, SIGMA = 2, 1.0
#: Of the deviation of the smoothed ratios: lines over it are content.
THRESHOLD = 0.5
#: Of the text of the largest cluster: smaller clusters do not widen the region.
SHARE = 0.1
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FEED = 1 << 16

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that go on within a line.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr link meta".split()
)
#: Tags whose text is not the article's.
APART = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video map nav footer aside form button "
    "select option textarea input dialog menu".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words of a class or id that name such an element.
NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs masthead header footer sidebar aside widget widgets related recommended share "
    "sharing social cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login search searchbox form comment comments commentlist reply replies respond disqus discussion "
    "pagination pager toolbar copyright disclaimer".split()
)
#: Last words of a name that only say how such an element is laid out, so that the first word counts.
CARRIERS = frozenset("area bar block box button buttons container group icons inner item items left link links list outer panel posts right section top bottom wrap wrapper".split())
#: Blocks of a text.
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li td th tr dt dd ul ol dl table tbody blockquote pre".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class _Element:
    __slots__ = ("tag", "parent", "apart")

    def __init__(self, tag: str, parent: _Element | None, apart: bool) -> None:
        self.tag, self.parent, self.apart = tag, parent, apart


class _Line:
    __slots__ = ("parts", "tags", "element")

    def __init__(self, element: _Element) -> None:
        self.parts, self.tags, self.element = [], 0, element


class LineParser(HTMLParser):
    """Collects lines of text with their tags, and the block element that each is in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = _Element("", None, False)
        self.lines = [_Line(self.at)]
        self.seen = False

    def _line(self) -> None:
        last = self.lines[-1]
        if last.parts:
            self.lines.append(_Line(self.at))
        else:
            last.element = self.at

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE and tag not in APART:
            self.lines[-1].tags += 1
            if not (attrs and self._apart_by_name(attrs)) or tag in VOID:
                return
        if tag in VOID:
            if tag not in INLINE:
                self._line()
                self.lines[-1].tags += 1
            return
        main = tag in ("article", "main")
        by_name = bool(attrs) and self._apart_by_name(attrs, self._inside_main(), main)
        if main and not by_name and not self.seen:  # menus and the like that were never closed end before the article
            self.seen = True
            element = self.at
            while element is not None:
                if element.apart and element.tag in ("nav", "header", "footer", "aside", "head", "ul", "div", "section"):
                    self.at = element.parent
                element = element.parent
        apart = (tag in APART or tag == "header" and not self._inside_main() or by_name) and tag not in ("html", "body", "main")
        self.at = _Element(tag, self.at, apart or self.at.apart)
        self._line()
        self.lines[-1].tags += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        element = self.at
        while element is not None and element.tag != tag:
            if element.tag in ("article", "main", "body") and tag not in ("html", "body", "article", "main"):
                return  # an end tag without its start does not close the article
            element = element.parent
        self.lines[-1].tags += 1
        if element is None or element.parent is None:
            if tag in ("p", "br"):
                self._line()
            return
        self.at = element.parent
        if tag not in INLINE:
            self._line()
        else:
            self.lines.append(_Line(self.at))

    def handle_data(self, data: str) -> None:
        self.lines[-1].parts.append(data)

    def _inside_main(self) -> bool:
        element = self.at
        while element is not None:
            if element.tag in ("article", "main"):
                return True
            element = element.parent
        return False

    @staticmethod
    def _apart_by_name(attrs: list[tuple[str, str | None]], inside_main: bool = False, main: bool = False) -> bool:
        """Whether a role, or a class or id as a whole, names an element that holds no article text.

        A name counts by its last word (``top-menu``, but not ``share-price``), or by its first where the last one only tells
        the layout (``sidebar-left``). An article or main element has to be named by a single word.
        """
        if any(k == "role" and v and v.lower() in ROLES for k, v in attrs):
            return True
        for k, v in attrs:
            if k not in ("class", "id") or not v:
                continue
            for token in v.split():
                words = [w.lower() for w in _WORDS.findall(token)]
                if token.lower() in NAMES:
                    words = [token.lower()]
                if not words or main and len(words) > 1:
                    continue
                named = words[-1] if words[-1] not in CARRIERS else words[0]
                if named in NAMES and not (inside_main and named == "header"):
                    return True
        return False


def smoothed(ratios: np.ndarray, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over ``radius`` lines on each side; beyond the page the ratio is 0."""
    kernel = np.array([math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)])
    return np.convolve(ratios, kernel / kernel.sum(), mode="full")[radius : radius + len(ratios)]


def clusters(ratios: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which lines are in a cluster that counts: consecutive lines of text whose smoothed ratio is over the threshold, with
    ``SHARE`` of the text of the largest such cluster."""
    smooth = smoothed(ratios)
    content = smooth >= THRESHOLD * smooth.std()
    number = np.cumsum(content & ~np.concatenate([[False], content[:-1]]))
    text = np.bincount(number, weights=sizes * content)
    return content & (ratios > 0) & (text[number] >= SHARE * text.max())


def _path(element: _Element | None) -> list[_Element]:
    """An element and all it is in, from the outermost."""
    found = []
    while element is not None:
        found.append(element)
        element = element.parent
    return found[::-1]


def _region(lines: list[_Line]) -> _Element:
    """The lowest common ancestor of lines."""
    common = _path(lines[0].element)
    for line in lines[1:]:
        other = _path(line.element)
        common = common[: next((k for k, (a, b) in enumerate(zip(common, other, strict=False)) if a is not b), min(len(common), len(other)))]
    # a block of a text is no region of its own
    while len(common) > 1 and common[-1].tag in BLOCKS:
        common.pop()
    return common[-1]


def extract(html: str) -> str:
    """Main text: blocks of the content region in page order, white space in each made one space, joined by one space."""
    parser = LineParser()
    for at in range(0, len(html), FEED):
        parser.feed(html[at : at + FEED])
    parser.close()
    lines = [line for line in parser.lines if line.parts or line.tags]
    texts = ["" if line.element.apart else " ".join("".join(line.parts).split()) for line in lines]
    ratios = np.array([len(t) / max(line.tags, 1) for t, line in zip(texts, lines, strict=True)])
    if not len(ratios) or not ratios.any():
        return ""
    chosen = clusters(ratios, np.array([len(t) for t in texts], float))
    least = THRESHOLD * smoothed(ratios).std()
    # what smoothing alone has raised does not widen the region, but for headings
    region = _region([line for line, c, r in zip(lines, chosen.tolist(), ratios.tolist(), strict=True) if c and (r >= least or line.element.tag in HEADINGS)])
    return " ".join(t for t, line in zip(texts, lines, strict=True) if t and _inside(line.element, region))


def _inside(element: _Element | None, region: _Element) -> bool:
    while element is not None:
        if element is region:
            return True
        element = element.parent
    return False


def main_text(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages``; ``n_chars`` counts code points.

    Null, empty and text-free pages give an empty text. Pages cut off in the middle are read as far as they go. Repeated
    rows give repeated rows, an empty table an empty result; other columns, whatever their names, are not read.
    """
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            found = [extract(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    kept = ", ".join(f"{c} {kind}" for c, kind in own.dtypes[:2])
    return own.mapInArrow(work, f"{kept}, text string, n_chars long")
