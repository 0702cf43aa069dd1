"""Main text of web pages from a stream of parser events.

The standard library's parser gives events; a page becomes lines, one per block, each with its
text, its number of tags, and the open elements around it. A line's text-to-tag ratio (Weninger and
Hsu, 2008) is smoothed with a Gaussian over its neighbours, and lines above a threshold that the
page itself sets are content. The content region is the innermost element that holds most of the
content clusters' text. Elements that say themselves that they are no part of the article (menus,
notices, adverts, forms, reader comments and the like) count as boilerplate wherever they stand.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RADIUS = 2
SIGMA = 1.0
#: A child element becomes the region if it holds this share of the content's characters.
HOLDS = 0.7
#: Text outside of named elements is hardly any below this share of what one of them holds.
LITTLE = 0.1

#: Elements that can be the content region.
REGIONS = set(
    "html body div section article main td table tbody tr center figure".split()
)
VOID = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend "
    "li main menu nav noscript ol option p pre section select summary table tbody td template "
    "tfoot th thead title tr ul".split()
)
#: Elements that are never article text.
SILENT = set(
    "head title style script noscript template iframe object embed svg canvas audio video math "
    "map select option datalist button textarea input label".split()
)
ASIDE = set("nav header footer aside form menu dialog fieldset".split())
ROLES = set(
    "navigation banner contentinfo complementary search form menu menubar dialog alert "
    "alertdialog toolbar tablist note".split()
)
#: Words of class and id names that mark boilerplate, compared whole. What they mark is left out
#: unless the page's article turns out to be in it.
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs "
    "comment comments disqus cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay sidebar sidebars aside widget widgets nav navbar navigation menu menus "
    "masthead footer foot promo promotion promoted sponsor sponsored sponsors "
    "recommended recommendations share sharing newsletter subscribe subscription signup "
    "login search form pagination pager toolbar topbar bottombar copyright disclaimer "
    "replies reply respond rail teaser teasers outbrain taboola".split()
)
#: Words that articles are named by as well: they only lower the ratio of the lines in them.
HINTS = set("header legal social related discussion skip hidden".split())
HINT = 0.5
#: "with-sidebar" says what stands beside an element, not what is in it.
BESIDE = set("has with no without show hide contains".split())
_PARTS = re.compile(r"[A-Za-z][a-z]+|[A-Z]+(?![a-z])|[a-z]+")
CLOSES_P = BLOCKS - {"br", "option", "legend", "caption", "title", "head", "summary"}
#: An element whose start ends an open one of the second set, up to a parent of the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}


@dataclass
class Element:
    tag: str
    parent: Element | None
    silent: bool
    boilerplate: bool
    hard: bool = False  # by its tag, role or state, or by those around it
    named: bool = False  # by its own class or id
    hinted: bool = False
    content: int = 0
    titles: int = 0
    inside: bool = False
    heading: bool = False
    children: list[Element] = field(default_factory=list)


@dataclass
class Line:
    parts: list[str]
    tags: int
    linked: int
    element: Element

    def close(self) -> None:
        self.text = " ".join("".join(self.parts).split())


def _is_aside(tag: str, attributes: list[tuple[str, str | None]]) -> bool:
    """Whether tag, role or state say that an element is no part of the text."""
    if tag in ASIDE:
        return True
    for name, value in attributes:
        value = value or ""
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("hidden",) or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return True
    return False


_NO_WORDS: frozenset[str] = frozenset()


def _name_words(attributes: list[tuple[str, str | None]]) -> frozenset[str]:
    """The words of class and id names that tell what is in an element."""
    names = [value for name, value in attributes if name in ("class", "id") and value]
    return _words_of(" ".join(names)) if names else _NO_WORDS


@lru_cache(maxsize=4096)
def _words_of(names: str) -> frozenset[str]:
    found = set()
    for single in names.split():
        parts = [p.lower() for p in _PARTS.findall(single)]
        if len(parts) < 2 or parts[0] not in BESIDE:
            found.update(parts)
    return frozenset(found)


def _says_boilerplate(tag: str, words: frozenset[str]) -> bool:
    """Whether the element's own name, in its words, says so."""
    if not words or tag in ("html", "body", "main", "p"):
        return False
    if tag == "article":
        # A reader's comment can be an article of its own.
        return bool(words & {"comment", "comments", "reply", "ad", "advert", "teaser", "promo"})
    return bool(words & NAMES)


class Lines(HTMLParser):
    """Turns a page's events into lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", None, False, False)
        self.elements = [self.root]  # parents come before their children
        self.open: Counter[str] = Counter()
        self.lines: list[Line] = []
        self.line = Line([], 0, 0, self.root)
        self.links = 0

    def break_line(self) -> None:
        if self.line.parts:
            self.line.close()
            if self.line.text:
                self.lines.append(self.line)
                self.line = Line([], 0, 0, self.at)
                return
        self.line = Line([], self.line.tags, 0, self.at)

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self.close("p", {"table", "td", "th", "button", "article", "body", "div", "section"})
        if tag in IMPLIED:
            for other in IMPLIED[tag][0]:
                self.close(other, IMPLIED[tag][1])
        if tag in ("article", "main"):
            self.leave_boilerplate(tag, attributes)
        if tag in BLOCKS:
            self.break_line()
        self.line.tags += 1
        if tag in VOID:
            return
        if tag == "a":
            self.links += 1
        hard = self.at.hard or _is_aside(tag, attributes)
        words = _name_words(attributes) if attributes else _NO_WORDS
        named = _says_boilerplate(tag, words)
        element = Element(
            tag,
            self.at,
            self.at.silent or tag in SILENT,
            self.at.boilerplate or hard or named,
            hard,
            named,
            self.at.hinted or bool(words & HINTS),
        )
        element.titles = int(tag == "h1" and not element.boilerplate)
        element.heading = self.at.heading or tag in ("h1", "h2", "h3")
        self.at.children.append(element)
        self.elements.append(element)
        self.open[tag] += 1
        self.at = element
        if tag in BLOCKS:
            self.line.element = element

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in VOID or tag in ("svg", "path", "use"):
            if tag in BLOCKS:
                self.break_line()
            self.line.tags += 1
        else:
            self.handle_starttag(tag, attributes)

    def leave_boilerplate(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        """An article inside a menu or an advert that nobody closed ends it."""
        if not self.at.boilerplate or _is_aside(tag, attributes):
            return
        if _says_boilerplate(tag, _name_words(attributes)):
            return
        outer = self.at
        while outer.parent is not None and outer.parent.boilerplate:
            outer = outer.parent
        if outer.tag in ("nav", "header", "div", "ul", "menu", "form"):
            self.break_line()
            self.up_to(outer.parent or self.root)

    def up_to(self, element: Element) -> None:
        while self.at is not element:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def close(self, tag: str, borders: set[str] = frozenset()) -> None:
        """End the innermost open element of that name, and all in it, if no border is closer."""
        if not self.open[tag]:
            return
        element = self.at
        while element.parent is not None and element.tag != tag:
            if element.tag in borders:
                return
            element = element.parent
        if element.parent is None:
            return
        if tag in BLOCKS:
            self.break_line()
        self.up_to(element.parent)
        if tag in BLOCKS:
            self.line.element = self.at

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in BLOCKS:
            self.break_line()
        self.line.tags += 1
        if tag == "br":
            return
        # A formatting element's end does not reach out of its block.
        self.close(tag, set() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        if self.at.silent:
            return
        if not self.line.parts:
            self.line.element = self.at
        self.line.parts.append(data)
        if self.links:
            self.line.linked += len("".join(data.split()))

    def end(self) -> list[Line]:
        """Lines of the whole page; a tag that a cut page leaves unfinished is dropped."""
        cut = self.rawdata.rfind("<")
        if cut >= 0 and not self.cdata_elem and ">" not in self.rawdata[cut:]:
            self.rawdata = self.rawdata[:cut]
        self.close_parser()
        self.break_line()
        return self.lines

    def close_parser(self) -> None:
        HTMLParser.close(self)


def _smooth(ratio: np.ndarray, radius: int, sigma: float) -> np.ndarray:
    steps = np.arange(-radius, radius + 1)
    kernel = np.exp(-(steps**2) / (2 * sigma**2))
    padded = np.pad(ratio, radius, mode="constant")
    weight = np.convolve(np.pad(np.ones(len(ratio)), radius), kernel, "valid")
    return np.convolve(padded, kernel, "valid") / weight


def _content(lines: list[Line], radius: int, sigma: float) -> np.ndarray:
    """Which lines belong to content clusters."""
    length = np.array([len(x.text) for x in lines], dtype=np.float64)
    linked = np.array([x.linked for x in lines], dtype=np.float64)
    open_ = np.array([not x.element.boilerplate for x in lines])
    ratio = np.where(open_, length / np.array([max(x.tags, 1) for x in lines]), 0.0)
    ratio *= np.array([HINT if x.element.hinted else 1.0 for x in lines])
    smooth = _smooth(ratio, radius, sigma)
    # The two clusters of the smoothed ratios part where their means are equally far.
    least = smooth.mean()
    for _ in range(20):
        low, high = smooth[smooth < least], smooth[smooth >= least]
        if not len(low) or not len(high):
            break
        new = (low.mean() + high.mean()) / 2
        if abs(new - least) < 1e-9:
            break
        least = new
    return open_ & (smooth >= min(least, smooth.mean())) & (linked <= 0.5 * length)


def _open_wrappers(parser: Lines, lines: list[Line]) -> None:
    """Take back the verdict of a name where the page's article is in the named element: it holds
    the page's article, main or h1 while none stands outside of such elements, or there is hardly
    any text outside and it holds most of what its like holds.

    An element that names itself a comment or an advert stays closed inside of an opened one."""
    tops = [e for e in parser.elements if e.named and not e.hard and not e.parent.boilerplate]
    if not tops or not lines:
        return
    inside: dict[int, Element] = {id(e): e for e in tops}
    top_of: dict[int, Element | None] = {}
    for element in parser.elements:  # parents first
        above = top_of.get(id(element.parent)) if element.parent is not None else None
        top_of[id(element)] = above or inside.get(id(element))
    outside, size = 0, {id(e): 0 for e in tops}
    for line in lines:
        if line.element.hard or line.linked > 0.5 * len(line.text):
            continue
        top = top_of[id(line.element)]
        if top is None:
            outside += len(line.text)
        else:
            size[id(top)] += len(line.text)
    anchors = {None: 0} | {id(e): 0 for e in tops}
    for element in parser.elements:
        if element.tag in ("article", "main", "h1") and not element.hard and not element.named:
            top = top_of[id(element)]
            anchors[id(top) if top is not None else None] += 1
    total = sum(size.values())
    for top in tops:
        held = size[id(top)]
        anchored = anchors[id(top)] and not anchors[None] and held >= outside
        alone = outside < held * LITTLE and held > total / 2
        if held and (anchored or alone):
            _reopen(top)


def _reopen(top: Element) -> None:
    top.named = False
    todo = [top]
    while todo:
        element = todo.pop()
        element.boilerplate = element.parent.boilerplate or element.hard or element.named
        element.titles = int(element.tag == "h1" and not element.boilerplate)
        todo += element.children


def main_text(html: str | None, radius: int = RADIUS, sigma: float = SIGMA) -> str:
    """Text of the page's article: its blocks in order, joined by a blank; "" if there is none."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.end()
    _open_wrappers(parser, lines)
    if not any(not x.element.boilerplate for x in lines):
        return ""
    content = _content(lines, radius, sigma)
    for line, good in zip(lines, content):
        if good:
            line.element.content += len(line.text)
    for element in reversed(parser.elements[1:]):
        element.parent.content += element.content
        element.parent.titles += element.titles
    region = parser.root
    while region.tag != "article":
        # A main heading is part of the article, so the region does not shrink below it.
        inner = [
            c
            for c in region.children
            if c.content >= HOLDS * parser.root.content
            and c.content
            and c.tag in (REGIONS if region.tag != "main" else {"article"})
            and (c.titles or not region.titles)
        ]
        if not inner:
            break
        region = max(inner, key=lambda c: c.content)
    wide = region.tag in ("", "html", "body")
    # An article that is named as such is the region if content clusters lie in it.
    named = [
        e
        for e in parser.elements
        if e.tag in ("article", "main") and e.content and not e.boilerplate
    ]
    _mark(parser.elements, named)
    if named and not region.inside:
        region, wide = max(named, key=lambda e: e.content), False
    _mark(parser.elements, [region])
    last = max((i for i in range(len(lines)) if content[i]), default=-1)
    first = min((i for i in range(len(lines)) if content[i]), default=0)
    kept = []
    for i, line in enumerate(lines):
        if line.element.boilerplate or not line.element.inside:
            continue
        # Without a region of its own, the article reaches from heading to last cluster.
        if wide and not (i < first and line.element.heading):
            if not first <= i <= last or line.linked > 0.5 * len(line.text):
                continue
        kept.append(line.text)
    return " ".join(kept)


def _mark(elements: list[Element], regions: list[Element]) -> None:
    """Mark all elements that are in one of the regions."""
    chosen = {id(r) for r in regions}
    for element in elements:
        above = element.parent is not None and element.parent.inside
        element.inside = above or id(element) in chosen


def extract_pages(
    pages: DataFrame,
    html: str = "html",
    into: str = "text",
    radius: int = RADIUS,
    sigma: float = SIGMA,
) -> DataFrame:
    """All columns of ``pages`` but the markup, and the main text as ``into``.

    A null or empty page has the text "". Rows that repeat keep a row each. A column that is named
    ``into`` already is replaced."""
    rest = [c for c in pages.columns if c not in (html, into)]
    schema = pages.select(*rest).schema.add(into, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), radius, sigma) for x in batch.column(len(rest))]
            arrays = [batch.column(i) for i in range(len(rest))]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(texts, pa.string())], names=[*rest, into]
            )

    return pages.select(*rest, F.col(html)).mapInArrow(run, schema)
