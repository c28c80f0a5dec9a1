"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. The text lengths of the lines are summed over
sliding windows; where the sum rises from nothing is a surge point, where it falls back to nothing a
dive point, and the text between the two is a candidate region. Elements that never hold an article
(menus, forms, adverts, comments, ...) count as empty lines, so a region never reaches across them.
Regions of one container that only such beside-elements, or lines of links, part are judged together, and so are those of
one article or main element. The regions of all lines compete by the text between their surge and dive points; an article
or main around a region adds to its weight. Regions with a greatest sum near the winner's stay if they stand like it
inside or outside of such elements.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator
from itertools import accumulate, groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
PEAK_SHARE = 0.2
# What an article or main element adds to the text of its regions: so many times the text, and so many characters.
TAG_TIMES = 2
TAG_CHARACTERS = 80

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
                    re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
# Names of elements, and words of class, id and role values, that mark parts beside the article.
_RAW = frozenset("script style noscript template svg math iframe textarea title head object canvas".split())
_BESIDE = frozenset("nav footer aside form header menu dialog button select fieldset".split())
_BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice "
    "notices alert popup modal newsletter subscribe signup login search share sharing social related "
    "recommended comment comments disqus respond reply replies pagination pager widget toolbar "
    "contentinfo complementary form skip copyright legal".split())
_BESIDE_STEMS = ("advert", "breadcrumb", "comment", "cookie", "disqus", "footer", "navbar", "newsletter", "sidebar",
                 "sponsor", "subscri")
_BLOCK = frozenset(
    "address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul caption".split()) | _BESIDE
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_MAIN = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An open p ends where one of these starts, through open elements of these names only.
_ENDS_P = _BLOCK - {"html", "body"}
_INLINE = frozenset("b i em strong span a u font".split())
_LABELS = frozenset(("label", "legend"))


def _beside(name: str, attributes: str) -> bool:
    if name in _BESIDE:
        return True
    if name in ("html", "body", "article", "main") or name in _HEADINGS or not attributes:
        return False
    for _, value in _ATTRIBUTE.findall(attributes):
        for one in value.strip("\"'").lower().split():
            # "has-sidebar" and the like describe the page around the article, not a part beside it.
            if not re.match(r"(?:has|with|no|without)[-_]", one) and any(
                    word in _BESIDE_WORDS or word.startswith(_BESIDE_STEMS) for word in re.split(r"[^a-z]+", one)):
                return True
    return False


class Line(NamedTuple):
    """A stripped line: characters inside links, number of the outermost article or main around it or 0, and the block
    elements it stands in, innermost last but one and last. A line without text is a gap; ``holder`` then is the
    container of the beside-element that made it."""
    text: str
    links: int
    article: int
    outer: int
    holder: int


# Lines from the first to before the last that stand in a block element, by its number; 0 is the page.
Spans = dict[int, tuple[int, int]]


def lines_of(page: str, by_class: str = "everywhere", wrappers: set[int] | None = None,
             open_forms: frozenset[int] = frozenset(), forms: dict[int, int] | None = None) -> tuple[list[Line], Spans]:
    """The lines of a page and the spans of its block elements.

    ``by_class`` says where class, id and role values tell what stands beside the article: everywhere, everywhere but
    on elements around an article or main ("unwrapped"), or nowhere. ``wrappers`` has the places of those elements:
    "everywhere" adds them, "unwrapped" reads them. Forms at the places ``open_forms`` are no beside-elements, only
    their controls and labels are. With ``forms`` no form is one, and it gets the place and block number of each.
    """
    wrappers = set() if wrappers is None else wrappers
    lines: list[Line] = []
    spans: Spans = {0: (0, sys.maxsize)}
    # Numbers of the open block elements; html and body count as the page.
    blocks = [0, 0]
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, bool]] = []
    # Places in the stack of the open elements by name, of the open articles, and of those that are not inline.
    opened: dict[str, list[int]] = {}
    mains_at: list[int] = []
    solid: list[int] = []
    # The next end tag of raw elements, by name; None behind the last one.
    stops: dict[str, re.Match[str] | None] = {}
    # Places of the open elements that are beside by their class.
    classed: dict[int, int] = {}
    beside = main = anchors = mains = 0
    heading = 0

    def end_line() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                lines.append(Line(text, linked, mains if main else 0, blocks[-2], blocks[-1]))
            parts.clear()
        linked = 0

    def gap() -> None:
        end_line()
        lines.extend([Line("", 0, 0, blocks[-2], blocks[-1])] * WINDOW)

    def close(at: int) -> None:
        nonlocal beside, main, anchors, heading
        while len(stack) > at:
            name, out = stack.pop()
            classed.pop(len(stack), None)
            opened[name].pop()
            if name not in _INLINE:
                solid.pop()
            if name in _MAIN:
                mains_at.pop()
            if name in _BLOCK:
                number = blocks.pop()
                if number:
                    spans[number] = (spans[number][0], len(lines))
            beside -= out
            main -= name in _MAIN
            anchors -= name == "a"
            heading -= name in _HEADINGS

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        end = found.start() if found else size
        # In a header of the article itself the headings belong to the article.
        if end > at and (not beside or heading and main and all(n == "header" for n, out in stack if out)):
            chunk = page[at:end]
            parts.append(chunk)
            if anchors:
                linked += len(chunk.strip())
        if not found:
            break
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        if found.group(1):
            if name in _BLOCK:
                end_line()
            own = opened.get(name)
            # An end tag reaches out of an article only for the page, or for another article.
            if own and (name in ("body", "html", "main", "article") or not mains_at or own[-1] > mains_at[-1]):
                was = beside
                close(own[-1])
                if was and not beside:
                    gap()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in _RAW:
            parts.append(" ")
            if name not in stops or stops[name] and stops[name].start() < at:
                stops[name] = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            stop = stops[name]
            if stop:
                at = stop.end()
            elif name != "head":
                at = size
            continue
        if name in _VOID or found.group(3).rstrip().endswith("/"):
            if name in _BLOCK:
                end_line()
            continue
        if name in _BLOCK:
            end_line()
        if name in _ENDS_P and solid and stack[solid[-1]][0] == "p":
            close(solid[-1])
        heeded = by_class == "everywhere" or by_class == "unwrapped" and (main or found.start() not in wrappers)
        if name == "form" and (forms is not None or found.start() in open_forms):
            out = False
        else:
            out = _beside(name, found.group(3) if heeded else "") or bool(open_forms or forms is not None) and name in _LABELS
        if out and not beside:
            gap()
        if out and name not in _BESIDE and not main:
            classed[len(stack)] = found.start()
        opened.setdefault(name, []).append(len(stack))
        if name not in _INLINE:
            solid.append(len(stack))
        if name in _MAIN:
            mains_at.append(len(stack))
        stack.append((name, out))
        if name in _BLOCK:
            number = 0 if name in ("html", "body") else len(spans)
            blocks.append(number)
            spans.setdefault(number, (len(lines), sys.maxsize))
            if forms is not None and name == "form":
                forms[found.start()] = number
        beside += out
        if name in _MAIN:
            wrappers.update(classed.values())
            mains += not main
            main += 1
        anchors += name == "a"
        heading += name in _HEADINGS
    end_line()
    return lines, spans


def regions_of(lengths: list[int]) -> list[tuple[int, int, int]]:
    """(surge, dive, greatest window sum) of every run of lines whose window sums stay above nothing."""
    out = []
    n, i = len(lengths), 0
    while i < n:
        if lengths[i] == 0:
            i += 1
            continue
        surge, peak = i, 0
        window = sum(lengths[i:i + WINDOW])
        while i < n and window > 0:
            peak = max(peak, window)
            window += (lengths[i + WINDOW] if i + WINDOW < n else 0) - lengths[i]
            i += 1
        out.append((surge, i, peak))
    return out


class Group(NamedTuple):
    """Regions that are judged together: the first line, the one behind the last, the greatest window sum, the text's
    length, and the number of the article or main around them or 0."""
    surge: int
    dive: int
    peak: int
    mass: int
    article: int


def groups_of(lines: list[Line], spans: Spans) -> list[Group]:
    """The groups of regions of all lines, in order; no region reaches across the border of an article or main.

    Link text weighs in an article or main only: elsewhere, a run of lines that are nothing but links is a menu.
    Regions belong together in one article or main, or if all elements between them stand in blocks that hold lines of
    both, and a line next to the gap stands in that block itself or in one of its own blocks; for the page as the block,
    the lines on both sides.
    """
    def holds(holder: int, before: int, after: int) -> bool:
        start, end = spans[holder]
        own = [holder in (lines[k].outer, lines[k].holder) for k in (before, after)]
        return start <= before and after < end and (any(own) if holder else all(own))

    def together(before: int, after: int) -> bool:
        holders = {line.holder for line in lines[before + 1:after] if not line.text}
        if holders:
            return all(holds(holder, before, after) for holder in holders)
        # Only lines of links are between.
        return any(holds(holder, before, after) for k in (before, after) for holder in (lines[k].outer, lines[k].holder))

    # Gaps belong to what comes before them.
    owners = list(accumulate((line.article if line.text else None for line in lines),
                             lambda last, own: last if own is None else own, initial=0))[1:]
    weights = [len(line.text) if owner else max(0, len(line.text) - line.links) for line, owner in zip(lines, owners)]
    out: list[Group] = []
    first = 0
    for owner, run in groupby(owners):
        behind = first + sum(1 for _ in run)
        for surge, dive, peak in regions_of(weights[first:behind]):
            new = Group(first + surge, first + dive, peak, sum(weights[first + surge:first + dive]), owner)
            last = out[-1] if out else None
            if last and last.article == owner and (owner or together(last.dive - 1, new.surge)):
                out[-1] = Group(last.surge, new.dive, max(last.peak, peak), last.mass + new.mass, owner)
            else:
                out.append(new)
        first = behind
    return out


def page_forms(page: str) -> frozenset[int]:
    """The places of forms that stand around the page: those with more than half of its text, without controls and
    labels. Some servers put every page into one."""
    if not re.search("<form", page, re.I):
        return frozenset()
    forms: dict[int, int] = {}
    lines, spans = lines_of(page, "nowhere", forms=forms)
    sums = [0]
    for line in lines:
        sums.append(sums[-1] + max(0, len(line.text) - line.links))
    held = {place: sums[min(spans[number][1], len(lines))] - sums[spans[number][0]] for place, number in forms.items()}
    return frozenset(place for place, weight in held.items() if 2 * weight > sums[-1])


def main_text(page: str | None) -> str:
    """The blocks of the main text joined by an empty line; empty for null, empty or article-free pages.

    Where the classes leave nothing, as when the whole page stands in an element that is named for its
    sidebar, they are heeded on elements that hold no article only, and then not at all. A form around the page is
    read like any other element.
    """
    if not page:
        return ""
    wrappers: set[int] = set()
    open_forms = page_forms(page)
    for by_class in ("everywhere", "unwrapped", "nowhere"):
        lines, spans = lines_of(page, by_class, wrappers, open_forms)
        if by_class != "unwrapped" or any(line.article and line.text for line in lines):
            text = _selected(lines, spans)
            if text:
                return text
    return ""


def _selected(lines: list[Line], spans: Spans) -> str:
    groups = groups_of(lines, spans)
    if not groups:
        return ""
    best = max(groups, key=lambda g: g.mass * TAG_TIMES + TAG_CHARACTERS if g.article else g.mass)
    # Between surge and dive every line belongs to the text, links or not.
    return "\n\n".join(
        line.text for group in groups if bool(group.article) == bool(best.article) and group.peak >= PEAK_SHARE * best.peak
        for line in lines[group.surge:group.dive] if line.text)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row (page_id, url, text, n_chars) for every page, in the pages' own partitions.

    A null or empty page gives an empty text; repeated rows give repeated results, null ids stay null;
    other columns of the input are not read, so their names cannot clash.
    """
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [main_text(page.as_py()) for page in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                          F.col(html_col).cast("string").alias("html"))
    return source.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
