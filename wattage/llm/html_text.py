"""Main text of web pages by text-to-tag ratio.

Parser events of the standard library cut a page into lines (what stands between block
tags). Each line has a text-to-tag ratio; the ratios are smoothed with a Gaussian and
lines above a threshold (the deviation of the smoothed ratios) are seeds of content.
Seeds are clustered by the tree: an article that holds most of their text is the content
region, or else the deepest container that holds them all, widened to where the heading
over it stands. The region's lines make the text, short ones and headings too, but without
an article for runs of short lines that are all link, as menus are. Lines in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are never seeds and never part of the text. An article inside a form, or inside a container marked
as a box (newsletter, cookies, sharing), is content; where there is no article and forms or boxes hold most of
the text, they are the page, and only their controls and labels go.

White space inside a line becomes one space, lines are joined by one space in page order.
A null or empty page, or one without content, gives an empty text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

PAGES_AT_ONCE = 500
SMOOTH_RADIUS = 2
#: Share of the seeds' text that an article holds if it is the content region.
REGION_SHARE = 0.8
#: Lines in a row that are all link make a menu.
MENU_RUN = 3

# Elements whose text is never content (fixed by what HTML means by them).
DROP = frozenset(
    "head title script style template noscript iframe object embed canvas svg audio video map nav footer aside select "
    "textarea button datalist dialog menu fieldset".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
# What may stand in a head; anything else ends one whose end tag is left out.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
REGION = frozenset("article main".split())
HEADINGS = {f"h{i}": i for i in range(1, 7)}
ROLES = frozenset("navigation contentinfo complementary search menu menubar toolbar".split())
BOX_ROLES = frozenset("form alert alertdialog dialog".split())
# What a form is operated by and named with.
CONTROLS = frozenset("label legend optgroup option output progress meter".split())
# Words of class and id values that mark boilerplate; those of the first two lists hold inside an article too,
# those of the first also over one (a comment, a teaser).
FINAL = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo comment comments commentlist reply replies "
    "respond disqus related recommended".split()
)
BOXES = frozenset(
    "cookie cookies consent gdpr newsletter subscribe subscription signup share sharing social popup modal overlay paywall "
    "banner notice notices".split()
)
OUTSIDE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar side aside widget widgets "
    "pagination pager toolbar login search copyright legal disclaimer skip".split()
)
LAYOUT = frozenset("no has with without layout".split())
_MARK = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


class _Lines(HTMLParser):
    """Collects lines: [text parts, tags, boilerplate, containers, linked characters]."""

    def __init__(self, wide: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.wide = wide  # forms and boxes hold the page: only their controls are dropped
        self.boxes = False  # whether there is a form or a box
        self.stack: list[tuple[str, int, bool, bool]] = []  # tag, container, dropped, dropped for good
        self.lines: list[tuple[str, int, bool, tuple[int, ...], int]] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.link_depth = 0
        self.containers = 0
        self.open: tuple[int, ...] = ()
        self.dropped = self.for_good = False
        self.muted: int | None = None  # place on the stack of a hidden inline element: its text is no part of the line around it
        self.region: set[int] = set()
        self.headings: dict[int, int] = {}  # container: level

    def _break(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                dropped, place = (self.dropped, self.open) if self.muted is None else (self.stack[self.muted][2], self.open[: self.muted])
                self.lines.append((text, self.tags, dropped, place, self.linked))
                self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        self._leave_head(tag)
        if tag in INLINE:
            self.tags += 1
            self.link_depth += tag == "a"
            if tag in VOID:
                return
            if self.muted is None and (attrs and self._hidden(attrs) or self.wide and tag in CONTROLS):
                self.muted = len(self.stack)
            if self.muted is not None:  # also what it holds, to find its end
                self._push(tag, True, True)
            return
        self._break()
        self.tags += 1
        if tag in VOID:
            return
        drop, good = self.dropped, self.for_good
        if tag in DROP and not (self.wide and tag == "fieldset") or self.wide and tag in CONTROLS:
            drop = good = True
        elif tag == "form":  # an article may stand in it all the same
            self.boxes = True
            drop = drop or not self.wide
        elif tag == "header":
            drop = drop or not self._in_region()
        elif tag in REGION and not good:
            drop = False
        if attrs and tag not in ("html", "body"):
            final, box, outside = self._marks(attrs, whole=tag in REGION)
            self.boxes |= box
            if final or self._hidden(attrs):
                drop = good = True
            elif box and not self.wide:
                drop = True
                good = good or tag in REGION  # an article marked so is none
            elif outside and not self._in_region() and tag not in REGION:
                drop = True
        self._push(tag, drop, good)

    def _push(self, tag: str, drop: bool, good: bool) -> None:
        if tag == "p":  # a new paragraph ends the open one
            for i in range(len(self.stack) - 1, max(-1, len(self.stack) - 3), -1):
                if self.stack[i][0] == "p":
                    self._pop_to(i)
                    break
        self.containers += 1
        if tag in REGION:
            self.region.add(self.containers)
        elif tag in HEADINGS:
            self.headings[self.containers] = HEADINGS[tag]
        self.stack.append((tag, self.containers, self.dropped, self.for_good))
        self.open = (*self.open, self.containers)
        self.dropped, self.for_good = drop, good

    def _pop_to(self, i: int) -> None:
        self.dropped, self.for_good = self.stack[i][2], self.stack[i][3]
        del self.stack[i:]
        self.open = self.open[:i]
        if self.muted is not None and i <= self.muted:
            self.muted = None

    def _leave_head(self, tag: str) -> None:
        """End a head (or a title) that has no end tag where ``tag`` cannot stand in it."""
        if self.stack and (tag == "body" or self.stack[-1][0] == "head" and tag not in IN_HEAD):
            for i, x in enumerate(self.stack):
                if x[0] in ("head", "title"):
                    self._break()
                    self._pop_to(i)
                    break

    def handle_endtag(self, tag):
        if tag in INLINE:
            self.tags += 1
            self.link_depth = max(0, self.link_depth - (tag == "a"))
            if self.muted is not None:
                for i in range(len(self.stack) - 1, self.muted - 1, -1):
                    if self.stack[i][0] == tag:
                        self._pop_to(i)
                        break
                    if self.stack[i][0] not in INLINE:  # the end of something outside a block
                        break
            return
        self._break()
        self.tags += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop_to(i)
                break

    def handle_startendtag(self, tag, attrs):
        # "<div/>" opens a div in HTML; void elements have no end.
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] == "head" and not data.isspace():
            self._leave_head("")
        if self.muted is not None:
            return
        self.parts.append(data)
        if self.link_depth:
            self.linked += sum(map(len, data.split()))

    def _in_region(self) -> bool:
        return any(c in self.region for c in self.open)

    @staticmethod
    def _marks(attrs, whole: bool) -> tuple[bool, bool, bool]:
        """Whether class, id or role mark boilerplate (anywhere, a box, outside articles). ``whole``: by a full name only,
        so that an article with class "share-enabled" is no share box; "no-sidebar" and the like mark nothing."""
        final = box = outside = False
        for name, value in attrs:
            if value and name in ("class", "id"):
                for token in value.split():
                    words = _MARK.findall(_CAMEL.sub("-", token).lower())
                    if len(words) > 1 and (whole or not LAYOUT.isdisjoint(words)):
                        continue
                    final |= not FINAL.isdisjoint(words)
                    box |= not BOXES.isdisjoint(words)
                    outside |= not OUTSIDE.isdisjoint(words)
            elif value and name == "role":
                role = value.strip().lower()
                final |= role in ROLES
                box |= role in BOX_ROLES
                outside |= role == "banner"
        return final, box, outside

    @staticmethod
    def _hidden(attrs) -> bool:
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False


def _parse(html: str, wide: bool = False) -> _Lines:
    lines = _Lines(wide)
    try:
        lines.feed(html)
        lines.close()
    except AssertionError:  # a marked section the parser does not know: take its opening as text
        lines = _Lines(wide)
        lines.feed(html.replace("<![", "&lt;!["))
        lines.close()
    lines._break()
    return lines


def smoothed(ratio: np.ndarray, radius: int = SMOOTH_RADIUS) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the kernel is normalised at the ends."""
    x = np.arange(-radius, radius + 1)
    kernel = np.exp(-(x**2) / (2 * max(radius / 2, 0.5) ** 2))
    wide = np.convolve(ratio, kernel)[radius : radius + len(ratio)]
    return wide / np.convolve(np.ones(len(ratio)), kernel)[radius : radius + len(ratio)]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _parse(html)
    if page.boxes and not page.region:
        # A form or a box around the page, not one on it, holds most of its text.
        wide, size = _parse(html, wide=True), lambda p: sum(len(x[0]) for x in p.lines if not x[2])
        page = wide if size(wide) > 2 * size(page) else page
    lines = page.lines
    usable = [i for i, x in enumerate(lines) if not x[2]]
    if not usable:
        return ""
    ratio = np.array([len(x[0]) / max(1, x[1]) for x in lines])
    smooth = smoothed(ratio)
    seeds = [i for i in usable if smooth[i] >= smooth.std()] or [max(usable, key=lambda i: smooth[i])]
    mass = _mass(lines, seeds)
    named = [c for c in page.region if mass.get(c, 0) >= REGION_SHARE * sum(len(lines[i][0]) for i in seeds)]
    if named:
        region = min(named)  # an article is content from its start to its end
        return " ".join(lines[i][0] for i in usable if region in lines[i][3])
    menus = _menus(lines, [i for i in usable if ratio[i] < smooth.std()])
    seeds = [i for i in seeds if i not in menus] or seeds  # a menu's end next to a story is smoothed into it
    mass, total = _mass(lines, seeds), sum(len(lines[i][0]) for i in seeds)
    # Paragraphs and the like are no regions: only containers with more than one line, or the whole page.
    width: dict[int, int] = {}
    for i in usable:
        for c in lines[i][3]:
            width[c] = width.get(c, 0) + 1
    holding = [c for c, m in mass.items() if m == total and (width[c] > 1 or c in page.region)]
    region = max(holding, default=0)  # numbered in page order: of nested containers the deepest is the last
    inside = _with_heading(page, usable, [i for i in usable if not region or region in lines[i][3]])
    return " ".join(lines[i][0] for i in inside if i not in menus)


def _with_heading(page: _Lines, usable: list[int], inside: list[int]) -> list[int]:
    """The lines of a region, widened to the next container where a heading of higher rank than
    its own stands before it: all lines there from this heading on."""
    level = [min((page.headings[c] for c in x[3] if c in page.headings), default=7) for x in page.lines] if page.headings else []
    own = min((level[i] for i in inside), default=7) if level else 0
    over = [i for i in usable if i < inside[0] and level[i] < own] if own else []
    if not over:
        return inside
    around = page.lines[inside[0]][3]
    shared = lambda i: sum(1 for a, b in zip(page.lines[i][3], around) if a == b)
    depth = max(map(shared, over))
    near = [i for i in over if shared(i) == depth]
    top = min(near, key=lambda i: (level[i], -i))  # the highest, of equal ones the last
    return [i for i in usable if i >= top and page.lines[i][3][:depth] == around[:depth]]


def _mass(lines: list, seeds: list[int]) -> dict[int, int]:
    """Characters of the seeds in each container."""
    mass: dict[int, int] = {}
    for i in seeds:
        for c in lines[i][3]:
            mass[c] = mass.get(c, 0) + len(lines[i][0])
    return mass


def _menus(lines: list, short: list[int]) -> set[int]:
    """Of the short lines those that are all link and stand in a row of ``MENU_RUN`` such lines or more."""
    out: set[int] = set()
    run: list[int] = []
    linked = [i for i in short if lines[i][4] >= len(lines[i][0]) - lines[i][0].count(" ")]
    for i in [*linked, len(lines) + 1]:
        if run and i != run[-1] + 1:
            if len(run) >= MENU_RUN:
                out.update(run)
            run = []
        run.append(i)
    return out


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for every page row; other columns are not read."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, PAGES_AT_ONCE):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
