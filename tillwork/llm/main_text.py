"""The main text of HTML pages, from the density of text along the page."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from tillwork.llm.workspace import map_batches

# Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Elements without content of their own; they never stay open.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# What these hold is never the main text.
DROPPED = frozenset(
    "head title nav footer aside form script style noscript template menu button select option "
    "textarea iframe object svg math canvas audio video dialog search".split()
)
# Their text is not markup, up to their end tag.
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noscript"))
# Nor is that of elements with one of these words in their class, id or role.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors "
    "promo promos promotion banner banners nav navbar navigation menu menus breadcrumb "
    "breadcrumbs footer sidebar sidebars aside complementary contentinfo cookie cookies consent "
    "gdpr notice notices notification notifications alert alerts popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments commentlist disqus respond reply replies discussion form "
    "search pagination pager paging toolbar skip hidden copyright legal disclaimer masthead "
    "outbrain taboola".split()
)
# Some of these words are also what an article may be about; there the density decides.
DOUBTFUL_WORDS = frozenset(
    "discussion form legal recommendations recommended related search social".split()
)
# After one of these a word says what stands beside an element, not what it is.
BESIDE = frozenset("has with without no".split())
# Only these words drop an article.
REMARKS = frozenset(("comment", "reply"))
# An element like this is the article.
ARTICLE = frozenset(("article", "main"))
# Without one, the main text is in one of these, not in a part of a text.
CONTAINERS = frozenset("html body center div section td".split())
# What ends an open paragraph, list item and so on, although its end tag is left out.
ENDS = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
}
SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")
_TAG = re.compile(r"<[a-zA-Z/!?]")
# Standard deviation of the smoothing, in lines, and how far it reaches.
SIGMA, REACH = 1.0, 2
# Lines this many standard deviations above none are content.
THRESHOLD = 1.0
# The element that holds the main text has this share of the content lines' text.
SHARE = 0.8
# Lines with this many characters for each tag are text, however dense others are.
PROSE = 20.0


def _names(attrs: list[tuple[str, str | None]], keys: tuple[str, ...]) -> set[str]:
    """The words of an element's class, id or role."""
    words = []
    for key, value in attrs:
        if key in keys:
            words += _WORD.findall((value or "").lower()) + [""]
    return {w for before, w in zip([""] + words, words, strict=False) if before not in BESIDE}


def _by_id(tag: str, attrs: list[tuple[str, str | None]], within: bool) -> set[str]:
    """The words of an element's id that say what it is.

    The id of a heading is made from its text, as is that of a section ``within`` an
    article; other ids there count only if they are one word.
    """
    if tag in HEADINGS or (within and tag == "section"):
        return set()
    words = _names(attrs, ("id",))
    return set() if within and len(words - {""}) > 1 else words


def _excluding(tag: str) -> frozenset[str]:
    if tag in ARTICLE:
        return REMARKS
    return frozenset() if tag in ("body", "html") else DROPPED_WORDS


@dataclass
class Element:
    tag: str
    parent: "Element | None"
    dropped: bool
    article: bool
    content: int = 0  # characters of content lines inside
    depth: int = 0
    teaser: bool = False  # an article by its tag, something else by its words
    doubtful: bool = False  # itself, by a word that the density has to confirm
    link: bool = False


@dataclass
class Line:
    """One block of text between two tags that break lines."""

    inside: Element
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    heading: bool = False
    linked: int = 0  # characters in links

    @property
    def text(self) -> str:
        return SPACE.sub(" ", "".join(self.parts)).strip()


class Lines(HTMLParser):
    """Collects a page's lines from the parser's events, as they come."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [Element("html", None, False, False)]
        self.lines = [Line(self.open[0])]
        self.doubtful = False

    def _break(self) -> None:
        self.lines.append(Line(self.open[-1]))

    def _close(self, n: int) -> None:
        """Closes the innermost elements until ``n`` are open."""
        blocks = any(e.tag in BLOCKS for e in self.open[n:])
        del self.open[n:]
        if blocks or self.lines[-1].inside not in self.open:
            self._break()

    def handle_starttag(self, tag, attrs):
        self.lines[-1].tags += 1
        if tag == "br":
            self.lines[-1].parts.append(" ")
            return
        if tag in BLOCKS:
            # A block ends an open paragraph; items end their likes in the same list.
            for n in range(len(self.open) - 1, 0, -1):
                other = self.open[n].tag
                if other == "p" or other in ENDS.get(tag, ()):
                    self._close(n)
                    break
                if other in BLOCKS:
                    break
        parent = self.open[-1]
        by_class, by_role = _names(attrs, ("class",)), _names(attrs, ("role",))
        by_id = _by_id(tag, attrs, parent.article)
        named = by_class | by_role | by_id
        # Beside an article a class is meant as it says.
        sure = by_role | (by_id - DOUBTFUL_WORDS) | (by_class - (DOUBTFUL_WORDS if parent.article else set()))
        article = tag in ARTICLE and not parent.dropped and REMARKS.isdisjoint(named)
        within = parent.article or article
        dropped = (
            parent.dropped
            or tag in DROPPED
            or (tag == "header" and not within)
            or not _excluding(tag).isdisjoint(sure)
            or any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        )
        element = Element(tag, parent, dropped, within, depth=parent.depth + 1)
        element.doubtful = not dropped and not _excluding(tag).isdisjoint(named)
        self.doubtful |= element.doubtful
        element.teaser = article and not DROPPED_WORDS.isdisjoint(named)
        element.link = parent.link or tag == "a"
        if tag in VOID:
            if tag in BLOCKS:
                self._break()
            return
        self.open.append(element)
        if tag in BLOCKS or dropped != parent.dropped or element.doubtful:
            self._break()
            self.lines[-1].heading = tag in HEADINGS

    def handle_startendtag(self, tag, attrs):
        # A slash does not end an element of HTML.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.lines[-1].tags += 1
        for n in range(len(self.open) - 1, 0, -1):
            if self.open[n].tag == tag:
                self._close(n)
                return
            if self.open[n].tag in ARTICLE | {"body", "td", "th"} and tag not in ARTICLE | {"body", "html", "table"}:
                return  # an end tag that fits nothing open here

    def handle_data(self, data):
        self.lines[-1].parts.append(data)
        if self.open[-1].link:
            self.lines[-1].linked += len(data.strip())


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    at = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(at**2) / (2 * SIGMA**2))
    return np.convolve(ratios, kernel / kernel.sum())[REACH:-REACH]


def _ratios(lines: list[Line]) -> np.ndarray:
    return np.array([len(line.text) / max(1, line.tags) for line in lines], float)


def content_lines(lines: list[Line]) -> np.ndarray:
    """Which lines belong to a region of dense text.

    The ratio of text to tags of each line is smoothed along the page; lines at or above
    the threshold form the regions.
    """
    ratios = _ratios(lines)
    smooth = _smoothed(ratios)
    return (smooth >= THRESHOLD * smooth.std()) & (ratios > 0)


def _above(element: Element | None) -> Iterator[Element]:
    """The element and all that it is in, from the inside."""
    while element is not None:
        yield element
        element = element.parent


def _text_lines(lines: list[Line]) -> np.ndarray:
    """Which lines are text, not links: dense, of some length, or headings of such.

    A line of much more text than others raises the threshold, but not above ``PROSE``.
    """
    smooth = _smoothed(_ratios(lines))
    text = smooth >= min(THRESHOLD * smooth.std(), PROSE)
    for i in range(len(lines) - 1, -1, -1):
        if 2 * lines[i].linked > len(lines[i].text):
            text[i] = False
        elif lines[i].heading:
            text[i] = text[i + 1 : i + 2 + REACH].any()
    return text


def _undoubted(lines: list[Line]) -> list[Line]:
    """The lines without those of doubtful elements that are not dense.

    Half of an element's characters must be in lines of text, and some line of it must be
    such by itself, not by what is beside it.
    """
    smooth, ratios = _smoothed(_ratios(lines)), _ratios(lines)
    floor = min(THRESHOLD * smooth.std(), PROSE)
    inside = defaultdict(lambda: [0, 0, False])
    for line, dense, ratio, text in zip(lines, smooth >= floor, ratios, _text_lines(lines), strict=True):
        for element in _above(line.inside):
            if element.doubtful:
                sums = inside[id(element)]
                sums[0] += len(line.text)
                sums[1] += len(line.text) if text else 0
                sums[2] |= bool(text and dense and ratio >= floor)
    gone = {e for e, (size, dense, own) in inside.items() if not own or 2 * dense < size}
    return [line for line in lines if gone.isdisjoint(id(e) for e in _above(line.inside))]


def _grown(best: Element, lines: list[Line], within: bool) -> set[int]:
    """The elements (by ``id``) that hold the text that ``best`` is the most of.

    From ``best`` up to the parent while all other lines there are text too; of the last
    parent, what is next to ``best`` and is text. ``within`` keeps to the article.
    """
    if within and not (best.parent and best.parent.article):
        return {id(best)}
    text = _text_lines(lines)
    path = [list(_above(line.inside))[::-1] for line in lines]
    while best.parent is not None and (best.parent.article or not within):
        parent = best.parent
        depth = parent.depth
        # The children of the parent, in page order; lines of its own are one each.
        units: list[tuple[object, list[int]]] = []
        for i, way in enumerate(path):
            if len(way) <= depth or way[depth] is not parent:
                continue
            child = way[depth + 1] if len(way) > depth + 1 else lines[i]
            if units and units[-1][0] is child:
                units[-1][1].append(i)
            else:
                units.append((child, [i]))
        at = [n for n, (child, _) in enumerate(units) if child is best]
        fits = [child is best or all(text[i] for i in rows) for child, rows in units]
        if not all(fits):
            taken = {id(best)}
            for step, n in ((-1, at[0] - 1), (1, at[-1] + 1)):
                while 0 <= n < len(units) and fits[n]:
                    taken.add(id(units[n][0]))
                    n += step
            return taken
        best = parent
    return {id(best)}


def _whole_markup(html: str) -> str:
    """The page without a tag that its end cuts off."""
    tag = html.rfind("<")
    if tag > html.rfind(">") and _TAG.match(html, tag):
        html = html[:tag]
    return html


def main_text(html: str | None) -> str:
    """The text of the article of one page; empty if there is none."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(_whole_markup(html))
    # What the parser waits for the end of; in a script or an attribute it is none.
    if parser.rawdata.startswith("<!--"):
        parser.rawdata = ""
    parser.close()
    lines = [line for line in parser.lines if line.text]
    kept = [line for line in lines if not line.inside.dropped]
    if kept and parser.doubtful:
        kept = _undoubted(kept)
    if not kept:
        return ""
    content = content_lines(kept)
    # The regions say which element holds the main text: the deepest with most of it.
    total = 0
    holders: dict[int, Element] = {}
    for line, dense in zip(kept, content, strict=True):
        size = len(line.text) if dense else 0
        total += size
        for element in _above(line.inside):
            element.content += size
            holders[id(element)] = element
    articles = [e for e in holders.values() if e.tag in ARTICLE and e.content > 0]
    if articles:
        best = max(articles, key=lambda e: (e.content, e.depth))
    else:
        enough = [e for e in holders.values() if e.content >= SHARE * total and e.tag in CONTAINERS]
        best = max(enough, key=lambda e: e.depth, default=parser.open[0])
    taken = _grown(best, kept, bool(articles))
    # A page may have its text in several articles, one after another.
    taken |= {id(e) for e in articles if e.tag == best.tag and e.parent is best.parent and not e.teaser}

    return "\n".join(
        line.text
        for line in kept
        if (id(line) in taken or not taken.isdisjoint(id(e) for e in _above(line.inside)))
        and (line.heading or not _in_header(line.inside))
    )


def _in_header(element: Element | None) -> bool:
    while element is not None:
        if element.tag == "header":
            return True
        element = element.parent
    return False


def main_texts(pages: DataFrame) -> DataFrame:
    """The main text of each page, as ``page_id, url, text``.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are not read. The page
    is parsed as a stream of events into lines, one for each block; lines in menus, page
    headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
    comments are dropped. Words that an article may be about, or that its ids are made of,
    drop only what is not dense. Of the rest, the ratio of text to tags, smoothed by a Gaussian
    along the page, is cut at a threshold into regions of dense text, and these select
    the element that holds the main text: the ``article`` or ``main`` with most of it, or
    else the deepest container with nearly all, and what is beside it and belongs to the same
    text: titles, leads, closing blocks, articles next to it. All lines are returned, in page order, one on each line, with single spaces. Of a header inside an article, the
    headings stay.

    A missing, empty or textless page gives an empty text. Broken markup is read as far as
    it goes. Pages are taken whole, whatever their length, each on its own.
    """

    def make():
        def convert(rows):
            return {
                "page_id": rows["page_id"],
                "url": rows["url"],
                "text": [main_text(html) for html in rows["html"]],
            }

        return convert

    wanted = pages.selectExpr("CAST(page_id AS long) AS page_id", "url", "html")
    return map_batches(wanted, "page_id long, url string, text string", make)
