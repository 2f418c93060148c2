"""Main text of web pages by line-block distribution.

Markup is stripped to lines: one per run of text between block-level tags, and
an empty one for each hidden element between two texts.  Hidden are menus, headers, footers, sidebars, notices, adverts, forms and reader
comments that say so, by an element's name or a class name's last part.  What does
not say so is decided by the distribution: the text outside links is summed over
windows of ``WINDOW`` lines; where the sums surge over a level taken from the
page's own highest one, a region begins, and it ends where they dive below.  At a
region's ends links, runs of short lines and copyright lines go, which the windows
only reached.  Lines outside all regions stay if they lie in the same article, main
or content element as the highest peak.  ``html``, ``body``, ``main`` and
``article`` are never hidden.

Cases: null or empty html gives an empty text; cut-off tags, comments, elements
and character references end with the page; nulls, repeated rows and pages of
any length are handled row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import beside

WINDOW = 6
# The level of a region: this share of the page's highest window, and so many characters where there are any.
SHARE, SURGE = 0.15, 60
# So many short lines in a row at the end of a region are a list, not its text.
LIST = 3
# A quote opens a value only behind an equals sign; any other belongs to a name or an unquoted value.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
COPYRIGHT = re.compile(r"\s*(?:©|\(c\)\s|copyright\b)", re.I)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")
# HTML elements by what they mean for the text.
RAW = frozenset("script style noscript template textarea title iframe object svg math".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog select button head".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent"
    " disqus footer header masthead menu modal nav navbar navigation newsletter notice pagination popup promo related"
    " share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)


# Never hidden, whatever their class names say of the page.
WHOLE = frozenset("html body main article".split())
WITHOUT = frozenset("no not non has have with without".split())
CONTENT = frozenset("article content entry main post story".split())


def _names(attributes: str) -> Iterator[list[str]]:
    """The parts of each class name, id and role."""
    for found in NAMED.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").lower().split():
            yield [part for part in re.split(r"[^a-z0-9]+", name) if part and not part.isdigit()]


def _outside(name: str, attributes: str) -> bool:
    if name in WHOLE:
        return False
    if name in OUTSIDE:
        return True
    return any(parts and parts[-1] in MARKS and not WITHOUT.intersection(parts[:-1]) for parts in _names(attributes))


def _content(name: str, attributes: str) -> bool:
    """Whether an element holds an article: by its name, or the last part of a class name."""
    if name in ("article", "main"):
        return True
    return name in ("div", "section", "td") and any(parts and parts[-1] in CONTENT for parts in _names(attributes))


class Line(NamedTuple):
    text: str
    #: The number of its outermost article, main or content element (0: none).
    element: int
    #: Characters outside links.
    own: int
    heading: bool


EMPTY = Line("", 0, 0, False)


def _clean(pieces: list[str]) -> str:
    return SPACE.sub(" ", html.unescape("".join(pieces))).strip()


def lines_of(page: str) -> list[Line]:
    """Text lines in page order; a hidden element between two texts is an empty line."""
    lines: list[Line] = []
    run: list[str] = []
    plain: list[str] = []  # of the run, what is in no link
    link = heading = False
    hidden: list[str] = []  # open elements from the outermost hidden one on
    inside: list[str] = []  # open elements from the outermost content element on
    element = 0
    gap = 0  # hidden elements since the last text
    raw, at = "", 0

    def add(text: str) -> None:
        run.append(text)
        if not link:
            plain.append(text)

    def close() -> None:
        nonlocal gap, link
        line = _clean(run)
        if line:
            own = len(line) if heading or len(plain) == len(run) else len(_clean(plain))
            lines.extend([EMPTY] * gap if lines else [])
            lines.append(Line(line, element if inside else 0, own, heading))
            gap = 0
        run.clear()
        plain.clear()
        link = False

    for tag in TOKEN.finditer(page):
        if tag.start() < at:
            continue
        if not raw and not hidden:
            add(page[at : tag.start()])
        at = tag.end()
        name, ends = (tag[2] or "").lower(), bool(tag[1])
        if raw:
            if ends and name == raw:
                raw = ""
            continue
        if not name:
            continue
        if name in RAW:
            # The content is no markup: go straight to the end tag.
            if not ends and not tag[3].endswith("/"):
                stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        if hidden:
            if ends and name in hidden:
                while hidden.pop() != name:
                    pass
            elif ends and name in WHOLE:
                hidden.clear()
                close()
                if name in inside:
                    while inside.pop() != name:
                        pass
            elif not ends and name not in VOID and not tag[3].endswith("/"):
                hidden.append(name)
            continue
        if not ends and name not in VOID and _outside(name, tag[3]):
            close()
            gap += 1
            if not tag[3].endswith("/"):
                hidden.append(name)
        elif name in BLOCK:
            close()
            heading = name in HEADING and not ends
            if ends:
                if name in inside:
                    while inside.pop() != name:
                        pass
            elif name not in VOID and not tag[3].endswith("/"):
                if inside:
                    inside.append(name)
                elif _content(name, tag[3]):
                    inside.append(name)
                    element += 1
        elif name == "br":
            add(" ")
        elif name == "a":
            link = not ends
    if not hidden and not raw:
        add(page[at:])
    close()
    return lines


def regions_of(lines: list[Line]) -> list[tuple[int, int, int]]:
    """Runs of lines between a surge and a dive of the window sums: first line, last line and highest sum."""
    ends = list(accumulate((x.own for x in lines), initial=0))
    n = len(lines)
    sums = [ends[min(i + WINDOW, n)] - ends[i] for i in range(max(1, n - WINDOW + 1))]
    peak = max(sums, default=0)
    if not peak:
        return []
    level = min(peak, max(SURGE, SHARE * peak))
    regions: list[tuple[int, int, int]] = []
    reached = -1
    for i, total in enumerate(sums):
        if total < level:
            continue
        a, b = i, min(i + WINDOW, n) - 1
        while not lines[a].own:
            a += 1
        while not lines[b].own:
            b -= 1
        if regions and i <= reached + 1:
            # No dive since the last window: one region.
            first, last, most = regions.pop()
            a, b, total = first, max(b, last), max(total, most)
        reached = min(i + WINDOW, n) - 1
        regions.append((a, b, total))
    return [(*_trimmed(lines, a, b, level / WINDOW), total) for a, b, total in regions]


def _trimmed(lines: list[Line], a: int, b: int, short: float) -> tuple[int, int]:
    """A region without the lists and copyright lines at its ends; a few short lines and headings stay."""

    def reach(places: range) -> int:
        """How many lines from an end on are a list."""
        run = 0
        for i in places:
            if lines[i].heading or lines[i].own >= short:
                break
            run += 1
        texts = sum(bool(lines[i].text) for i in list(places)[:run])
        return run if texts >= LIST else 0

    while b > a and (not lines[b].own or COPYRIGHT.match(lines[b].text)):
        b -= 1
    a += reach(range(a, b))
    b -= reach(range(b, a, -1))
    while a < b and not lines[a].own:
        a += 1
    while a < b and not lines[b].own:
        b -= 1
    return a, b


def main_text(page: str | None) -> str:
    """The lines between surge and dive points, and the others of the highest peak's element, joined by newlines."""
    if not page:
        return ""
    lines = lines_of(page)
    if not any(x.own for x in lines):
        # A page of links: they are its text.
        lines = [x._replace(own=len(x.text)) for x in lines]
    regions = regions_of(lines)
    if not regions:
        return ""
    first, last, _ = max(regions, key=lambda r: r[2])
    article = {x.element for x in lines[first : last + 1]} - {0}
    within = {i for a, b, _ in regions for i in range(a, b + 1)}
    return "\n".join(x.text for i, x in enumerate(lines) if x.text and (i in within or x.element in article))


def extract(df: DataFrame, html_column: str, keep: list[str]) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` (code points) for every row."""

    def run(pages: list[str | None]) -> tuple[list[str], list[int]]:
        text = [main_text(x) for x in pages]
        return text, [len(x) for x in text]

    return beside(df, keep, [F.col(html_column)], "text string, n_chars long", lambda: run)
