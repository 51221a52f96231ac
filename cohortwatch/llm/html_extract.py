"""Main text of raw HTML: parser events, text-to-tag ratio per line, smoothing, clustering.

The standard library's HTMLParser streams a page's events. Block-level tags end a
line; inline tags do not. Each line keeps its text, the tags met in it and the open
containers around it. The text-to-tag ratio of the lines, smoothed with a Gaussian
kernel, is split by a threshold (two clusters in one dimension) into content and the
rest, and runs of content lines form regions. Lines inside boilerplate containers
(menus, page headers and footers, sidebars, notices, adverts, forms, comments,
scripts, styles) never count. Words of class and id (``NOISE``) mark a container only where
that leaves the page its text: not one that holds the page's only articles, or most of
the text and no content-named element stands elsewhere (see ``excuse``).

Regions choose the content's container and nothing else: all ``article`` and ``main``
elements, if they hold most of the regions' text; else the innermost content-named element
that does, with other content-named ones that have regions or the same name; else the innermost element
around all regions that has more than one line. Every line of the container that is no
boilerplate belongs to the article, short paragraphs too. Where no ``article`` or ``main`` says what
the article is, menus may stand in it that no tag or name marks: runs of two and more lines below the
threshold whose text is links (``LINKED``) are dropped. Nothing else is dropped and nothing is cut.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import map_arrow, table

# Element names of the HTML standard.
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html",
    "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "title", "tr", "ul"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
HIDDEN = frozenset(("head", "script", "style", "noscript", "template", "title", "iframe", "object", "svg", "canvas", "math", "audio", "video", "textarea", "select", "button", "datalist"))
FURNITURE = frozenset(("nav", "footer", "aside", "form", "menu", "dialog"))
# ``header`` is furniture outside an article; inside, it holds the article's heading
ROOTS = frozenset(("article", "main"))
# Elements that may hold a whole article; the others are its paragraphs, headings, lists.
FRAMES = frozenset(("article", "body", "center", "div", "html", "main", "section", "table", "td"))
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"))
# Whole words of class and id values.
NOISE = frozenset((
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "commentlist", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "hidden", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promoted", "recommended", "related",
    "replies", "respond", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"))
APART = frozenset(("has", "no", "with", "without"))
WHOLE = frozenset(("html", "body", "article", "main"))
CONTENT = frozenset(("article", "content", "entry", "main", "post", "story"))
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# An opening tag of the key closes an open element of the value, up to the list's container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset(("ul", "ol", "dl", "table", "select", "menu"))
SIGMA = 1.0
# Share of a line's text in links from which it may be an entry of a menu.
LINKED = 0.8
TIGHT = 1e-9


@dataclass
class Line:
    """Text between two block boundaries."""

    text: str
    tags: int
    root: int
    noise: bool
    frame: int
    mark: int
    linked: int = 0


@dataclass
class Open:
    """An open element: its container number (0: none), whether it is boilerplate by tag or role, the numbers of the frame and of the marked element it is in, whether it is in a link."""

    tag: str
    root: int
    noise: bool
    frame: int
    mark: int
    link: bool = False


@dataclass
class Mark:
    """An element that is boilerplate by its class or id words, and the one around it."""

    parent: int
    named: bool
    text: int = 0
    rooted: int = 0
    noise: bool = True


@dataclass
class Root:
    """A possible container of the article and the one around it."""

    parent: int
    strong: bool
    names: frozenset = frozenset()
    mark: int = 0
    lines: list[int] = field(default_factory=list)


class LineParser(HTMLParser):
    """Lines of a page from parser events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.roots = [Root(-1, False)]
        self.frames = [(-1, 0)]  # parent and depth
        self.marks = [Mark(-1, False, noise=False)]
        self.stack: list[Open] = [Open("", 0, False, 0, 0)]
        self.pieces: list[str] = []
        self.tags = 0
        self.linked = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.pieces).split()) if self.pieces else ""
        if text:
            top = self.stack[-1]
            self.roots[top.root].lines.append(len(self.lines))
            self.lines.append(Line(text, self.tags, top.root, top.noise, top.frame, top.mark, self.linked))
        self.pieces, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in CLOSES:
            self._close_open(CLOSES[tag])
        if tag == "body" and len(self.stack) > 1 and self.stack[-1].tag == "head":
            self._close("head")
        top = self.stack[-1]
        names = self._names(attrs) if attrs else ()
        noise = top.noise or tag in HIDDEN or tag in FURNITURE or (tag == "header" and not self._in_strong(top.root)) or self._noisy(tag, attrs)
        root, mark = top.root, top.mark
        if not noise and tag not in WHOLE and not NOISE.isdisjoint(names):
            self.marks.append(Mark(mark, not CONTENT.isdisjoint(names)))
            mark = len(self.marks) - 1
        if not noise and (tag in ROOTS or tag in ("div", "section", "td") and not CONTENT.isdisjoint(names)):
            self.roots.append(Root(root, tag in ROOTS, CONTENT.intersection(names), mark))
            root = len(self.roots) - 1
        frame = top.frame
        if tag in FRAMES:
            self.frames.append((frame, self.frames[frame][1] + 1))
            frame = len(self.frames) - 1
        self.stack.append(Open(tag, root, noise, frame, mark, tag == "a" or top.link and tag not in BLOCKS))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag not in ("script", "style"):
            self.pieces.append(data)
            if self.stack[-1].link:
                self.linked += len(" ".join(data.split()))

    def _close(self, tag: str) -> None:
        """Pop to the innermost open ``tag``; a stray end tag closes nothing."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            # an inline end tag does not reach over a container
            if tag not in BLOCKS and self.stack[i].tag in BLOCKS and self.stack[i].tag != "p":
                return

    def _close_open(self, tags: tuple[str, ...]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return
            if self.stack[i].tag in SCOPES:
                return

    def _in_strong(self, root: int) -> bool:
        while root > 0:
            if self.roots[root].strong:
                return True
            root = self.roots[root].parent
        return False

    @staticmethod
    def _names(attrs: list[tuple[str, str | None]]) -> set[str]:
        """Words of class and id values; those behind has-, no-, with- or without- say nothing of the element."""
        found = set()
        for k, v in attrs:
            if k in ("class", "id") and v:
                for name in v.split():
                    for w in NAME_WORDS.findall(name):
                        w = w.lower()
                        if w in APART:
                            break
                        found.add(w)
        return found

    @staticmethod
    def _noisy(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in WHOLE:
            return False
        return any(k == "role" and (v or "").lower() in ROLES or k == "hidden" or k == "aria-hidden" and v == "true"
                   or k == "style" and v and re.search(r"display\s*:\s*none", v) for k, v in attrs)

    def excuse(self) -> None:
        """Settle which marked elements are boilerplate, and pass it on to their lines.

        Where all articles with text are in marked elements, those that hold them are
        excused. So is one with more than half of the page's text, if it has a content name
        or holds most of that text in content-named elements, or if no line of an article or
        content-named element is outside of marked ones.
        """
        marks, roots = self.marks, self.roots
        if len(marks) == 1:
            return
        whole = 0
        for x in self.lines:
            if not x.noise:
                whole += len(x.text)
                marks[x.mark].text += len(x.text)
                # in a root that is inside of the marked element
                if x.root and roots[x.root].mark == x.mark and x.mark:
                    marks[x.mark].rooted += len(x.text)
        strong, other = [False] * len(marks), [False] * len(marks)
        for x in self.lines:
            if not x.noise and x.root:
                other[x.mark] = True
                strong[x.mark] = strong[x.mark] or self._in_strong(x.root)
        depth, least = [0] * len(marks), 0
        for n, m in enumerate(marks[1:], 1):
            depth[n] = depth[m.parent] + 1
        if any(strong):
            least = min(d for d, held in zip(depth, strong) if held)
        for n in range(len(marks) - 1, 0, -1):
            m, up = marks[n], marks[n].parent
            marks[up].text += m.text
            marks[up].rooted += m.rooted
            strong[up] = strong[up] or strong[n]
            m.noise = not (strong[n] and depth[n] <= least)
        # a line is free if all marked elements around it are excused
        free = any(other[n] for n, m in enumerate(marks) if not m.noise)
        for n, m in enumerate(marks):
            if m.noise and 2 * m.text > whole and not marks[m.parent].noise and (m.named or 2 * m.rooted > whole or not free):
                m.noise = False
                free = free or other[n]
        for m in marks[1:]:
            m.noise = m.noise or marks[m.parent].noise
        for x in self.lines:
            x.noise = x.noise or marks[x.mark].noise


def parse(html: str) -> LineParser:
    parser = LineParser()
    parser.feed(html)
    parser.close()
    parser.end_line()
    parser.excuse()
    return parser


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the kernel is scaled at the ends, where it has fewer lines."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return (np.convolve(ratio, kernel, "full") / np.convolve(np.ones(len(ratio)), kernel, "full"))[reach:reach + len(ratio)]


def threshold(values: np.ndarray) -> float:
    """Half-way between the means of two clusters; below all values if they are alike."""
    low, high = float(values.min()), float(values.max())
    if high - low < TIGHT:
        return low
    cut = (low + high) / 2
    for _ in range(50):
        above = values[values >= cut]
        below = values[values < cut]
        moved = (above.mean() + below.mean()) / 2 if len(above) and len(below) else cut
        if abs(moved - cut) < TIGHT:
            break
        cut = moved
    return float(cut)


def extract(html: str | None) -> str:
    """The article's text, blocks in page order joined by one space; empty if there is none."""
    if not html:
        return ""
    parser = parse(html)
    lines = parser.lines
    kept = [i for i, x in enumerate(lines) if not x.noise]
    if not kept:
        return ""
    ratio = np.array([0.0 if x.noise else len(x.text) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratio)
    cut = threshold(smooth[kept])
    content = [i for i in kept if smooth[i] >= cut]
    menus = unmarked_menus(lines, kept, smooth, cut)
    # text of the content regions inside each possible container, counted to the outer ones
    weight = [0] * len(parser.roots)
    for i in content:
        root = lines[i].root
        while root >= 0:
            weight[root] += len(lines[i].text)
            root = parser.roots[root].parent
    whole = weight[0]
    strong = {r for r in range(1, len(weight)) if parser.roots[r].strong}
    named = [r for r in range(1, len(weight)) if 2 * weight[r] > whole]
    outer = (r for r in strong if weight[r] and not _inside(parser, parser.roots[r].parent, strong))
    if 2 * sum(weight[r] for r in outer) > whole:
        chosen = strong
    elif named:
        best = max(named)
        alike = (r for r in range(1, len(weight)) if weight[r] or parser.roots[r].names == parser.roots[best].names)
        chosen = {best} | {r for r in alike if not _inside(parser, best, {r})}
    else:
        return " ".join(lines[i].text for i in _around(parser, content, kept) if i not in menus)
    if chosen is strong:
        menus = set()
    return " ".join(lines[i].text for i in kept if i not in menus and _inside(parser, lines[i].root, chosen))


def unmarked_menus(lines: list[Line], kept: list[int], smooth: np.ndarray, cut: float) -> set[int]:
    """Lines of runs of at least two links below the threshold, and the links beside them if most of their run is below it."""
    found: set[int] = set()
    for link, run in groupby(kept, lambda i: lines[i].linked >= LINKED * len(lines[i].text)):
        if not link:
            continue
        menu = list(run)
        low = [bool(smooth[i] < cut) for i in menu]
        below = {i for n, i in enumerate(menu) if low[n] and (n and low[n - 1] or n + 1 < len(low) and low[n + 1])}
        found |= set(menu) if below and 2 * sum(low) > len(menu) else below
    return found


def _inside(parser: LineParser, root: int, chosen: set[int]) -> bool:
    while root >= 0:
        if root in chosen:
            return True
        root = parser.roots[root].parent
    return False


def _around(parser: LineParser, content: list[int], kept: list[int]) -> list[int]:
    """The ``kept`` lines of the innermost frame around all ``content`` lines; a frame of one line alone is a paragraph, not a container."""
    frames, lines = parser.frames, parser.lines
    common = lines[content[0]].frame
    for at in {lines[i].frame for i in content}:
        while at != common:
            if frames[at][1] >= frames[common][1]:
                at = frames[at][0]
            else:
                common = frames[common][0]
    count = [0] * len(frames)
    for i in kept:
        count[lines[i].frame] += 1
    for n in range(len(frames) - 1, 0, -1):
        count[frames[n][0]] += count[n]
    while common > 0 and count[common] < 2:
        common = frames[common][0]
    held = [n == common for n in range(len(frames))]
    for n in range(common + 1, len(frames)):
        held[n] = held[frames[n][0]]
    return [i for i in kept if held[lines[i].frame]]


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    One pass without a shuffle. Null and empty html, and pages without content, give
    an empty text; a null id or url is passed on; repeated rows give equal rows; a page of any
    length is read whole; an empty table gives an empty one; other columns are ignored, whatever
    their names.
    """
    def extracted(batch: pa.RecordBatch) -> dict:
        texts = [extract(h) for h in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), extracted,
                     "page_id long, url string, text string, n_chars long")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
