"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events once.  They become lines,
one per block (paragraph, heading, list item, cell), each with its characters,
its linked characters and the number of tags since the line before.  A line's
ratio is its unlinked characters per tag; the ratios are smoothed by a Gaussian
and the lines above a threshold, the standard deviation of the smoothed ratios,
form clusters.  Lines of parts that are no article by their tag, role or class
(menus, footers, adverts, forms, comments, ...) have ratio 0 and are in no
cluster.

Clusters select regions, not single lines, so that a short paragraph of the
article stays: the ``article`` (else ``main``, else an element named as content)
that holds the clusters' text, and of it all lines outside the excluded parts.
A page without such an element gives the lowest element that holds nearly all
of the clusters' text, without its link lists.

White space in a block (``br`` included) becomes one space; blocks are joined by
a new line.  Pages are parsed one by one in the scan's tasks, without a shuffle;
a task holds one page and the Arrow batch that it came in.

Defined results: null or empty html gives an empty text; every row gives one row,
so repeated rows and null ids stay; other columns are not read; unclosed or stray
tags end where the next block or their parent does; an unfinished tag at the end
of a page is dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, steps

# Gaussian of the ratios: standard deviation and radius, in lines.
SIGMA, RADIUS = 1.0, 2
# Of several articles, those with this share of the largest one's clustered text.
SHARE = 0.25
# A page without a marked article: share of the clustered text that its region
# holds, and share of linked characters from which a line is a list of links.
REGION_SHARE, LINKED = 0.9, 0.5

# HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul hr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose text is never shown as text of the page.
UNSEEN = frozenset(
    "head title script style noscript noframes template svg math iframe object applet audio video canvas map select option "
    "optgroup datalist textarea button legend label progress meter".split()
)
NOT_ARTICLE = frozenset("nav aside footer form menu dialog search fieldset".split())
NOT_ARTICLE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist status".split()
)
# Start tags that end an open element of these kinds (up to the next boundary).
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
IN_HEAD = frozenset("title meta link base script style noscript template head".split())
# Words of class names and ids.
NOT_ARTICLE_WORDS = frozenset(
    "ad ads adv adbox adslot adunit adwrap adwrapper adcontainer adspace adzone "
    "advert adverts advertisement advertisements advertising adsense adsbygoogle sponsor sponsors sponsored promo promos "
    "promoted promotion promotions banner banners cookie cookies consent gdpr notice notices notification notifications alert alerts "
    "popup popups popover modal overlay nav navs navbar navigation menu menus submenu breadcrumb breadcrumbs masthead footer footers "
    "sidebar sidebars sidenav aside widget widgets related recommended recommendations teaser teasers share shares sharing social "
    "comment comments commentlist commentform disqus respond replies form forms search newsletter subscribe subscription signup login "
    "pagination pager paging toolbar copyright disclaimer skip".split()
)
HEADER_WORDS = frozenset("header headers topbar".split())
ARTICLE_WORDS = frozenset("article content main story post entry".split())
# A class name that starts so says what an element has or is about, not what it is.
HAS = frozenset("has no with without is not category cat tag tags topic format type status author".split())

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# Kinds of elements.
PLAIN, EXCLUDED, HEADER, HIDDEN, ARTICLE, MAIN, CONTENT = range(7)


def _kind(tag: str, attrs: dict[str, str]) -> int:
    """What an element is, by its tag, role, class and id."""
    style = attrs.get("style", "").replace(" ", "").lower()
    if tag in UNSEEN or "hidden" in attrs or "display:none" in style or "visibility:hidden" in style:
        return HIDDEN
    role = attrs.get("role", "").strip().lower()
    if tag in NOT_ARTICLE or role in NOT_ARTICLE_ROLES:
        return EXCLUDED
    content = False
    header = tag == "header"
    if tag not in ("html", "body"):
        for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
            words = [w.lower() for w in _WORDS.findall(name)]
            if not words or words[0] in HAS:
                continue
            if not NOT_ARTICLE_WORDS.isdisjoint(words):
                return EXCLUDED
            header = header or not HEADER_WORDS.isdisjoint(words)
            content = content or not ARTICLE_WORDS.isdisjoint(words)
    if header:
        return HEADER
    if tag == "article" or role == "article" or "articleBody" in attrs.get("itemprop", ""):
        return ARTICLE
    if tag == "main" or role == "main":
        return MAIN
    return CONTENT if content else PLAIN


@lru_cache(1000)
def _kind_of_tag(tag: str) -> int:
    return _kind(tag, {})


class PageEvents(HTMLParser):
    """The lines and elements of one page.

    ``lines``: text, tags before and in it, linked characters, block element.
    ``parents``, ``tags``, ``kinds``: the elements in order of their start tags.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.parents, self.tags, self.kinds = [-1], ["#page"], [PLAIN]
        self._stack = [0]  # open elements
        self._open: dict[str, int] = {}
        self._unseen = 0
        self._links = 0
        self._text: list[str] = []
        self._linked = 0
        self._count = 0

    # A comment that never ends takes the rest of the page.
    def parse_comment(self, i: int, report: bool = True) -> int:
        if self.rawdata.find("-->", i + 4) < 0:
            return len(self.rawdata)
        return super().parse_comment(i, report)

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers of the source are not needed."""
        return j

    def _end_line(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                block = next((e for e in reversed(self._stack) if self.tags[e] in BLOCKS), 0)
                self.lines.append((text, max(self._count, 1), min(self._linked, len(text)), block))
                self._count = 0
            self._text, self._linked = [], 0

    def _pop(self) -> str:
        e = self._stack.pop()
        tag = self.tags[e]
        self._open[tag] -= 1
        if tag in BLOCKS:
            self._end_line_of(e)
        if self.kinds[e] == HIDDEN:
            self._unseen -= 1
        if tag == "a":
            self._links -= 1
        return tag

    def _end_line_of(self, element: int) -> None:
        self._stack.append(element)
        self._end_line()
        self._stack.pop()

    def _close_to(self, tags: frozenset[str], boundary: frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` inside ``boundary``."""
        if not any(self._open.get(t) for t in tags):
            return
        depth = None
        for k in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[k]]
            if tag in tags:
                depth = k
            elif tag in boundary:
                break
        if depth is not None:
            while len(self._stack) > depth:
                self._pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._count += 1
        if tag == "br":
            self._text.append(" ")
            return
        if tag in ("html", "body") and self._open.get(tag):
            return
        if self._open.get("head") and tag not in IN_HEAD:
            self._close_to(frozenset({"head"}), frozenset())
        if tag in BLOCKS:
            self._end_line()
            if self._open.get("p"):
                self._close_to(frozenset({"p"}), P_BOUNDARY)
        if tag in ENDS:
            self._close_to(*ENDS[tag])
        if tag in VOID:
            return
        e = len(self.tags)
        self.parents.append(self._stack[-1])
        self.tags.append(tag)
        kind = _kind(tag, {k: v or "" for k, v in attrs}) if attrs else _kind_of_tag(tag)
        self.kinds.append(kind)
        self._stack.append(e)
        self._open[tag] = self._open.get(tag, 0) + 1
        self._unseen += kind == HIDDEN
        self._links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # ``<div/>`` opens a div; scripts and the like are taken as closed.
        if tag not in UNSEEN:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self._count += 1
        if tag in BLOCKS and not self._open.get(tag):
            self._end_line()
            return
        if not self._open.get(tag) or tag in ("html", "body"):
            return
        if tag not in BLOCKS:
            # An inline end tag closes nothing across a block.
            for k in range(len(self._stack) - 1, 0, -1):
                name = self.tags[self._stack[k]]
                if name == tag:
                    break
                if name in BLOCKS:
                    return
        while self._pop() != tag:
            pass

    def handle_data(self, data: str) -> None:
        if not self._unseen:
            self._text.append(data)
            if self._links:
                self._linked += len("".join(data.split()))

    def finish(self) -> None:
        self.close()
        while len(self._stack) > 1:
            self._pop()
        self._end_line()


P_BOUNDARY = frozenset("table td th caption button".split())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """The ratios weighed by a Gaussian of the neighbouring lines (none beyond
    the ends)."""
    at = np.arange(-radius, radius + 1)
    kernel = np.exp(-(at**2) / (2 * sigma**2))
    padded = np.pad(ratios, radius)
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def _excluded(page: PageEvents) -> list[bool]:
    """Elements that belong to no article.  An excluded element that holds the
    only article of the page (a wrapper with such a class) is none."""

    def spread(lifted: frozenset[int] = frozenset()) -> list[bool]:
        out = []
        for e, (parent, kind) in enumerate(zip(page.parents, page.kinds)):
            out.append((parent >= 0 and out[parent]) or (kind in (EXCLUDED, HEADER, HIDDEN) and e not in lifted))
        return out

    excluded = spread()
    articles = [e for e, kind in enumerate(page.kinds) if kind in (ARTICLE, MAIN)]
    if articles and all(excluded[e] for e in articles):
        above = set()
        for e in articles:
            while e >= 0 and e not in above:
                above.add(e)
                e = page.parents[e]
        excluded = spread(frozenset(e for e in above if page.kinds[e] in (EXCLUDED, HEADER)))
    # The headings in an article's own header are its title.
    inside = [False] * len(excluded)
    for e, parent in enumerate(page.parents):
        if parent < 0:
            continue
        own = page.kinds[parent] == HEADER and any(page.kinds[a] in (ARTICLE, MAIN, CONTENT) for a in _above(page, parent))
        inside[e] = (inside[parent] or (own and not excluded[page.parents[parent]])) and page.kinds[e] not in (EXCLUDED, HIDDEN)
        if inside[e] and page.tags[e] in HEADINGS:
            excluded[e] = False
    return excluded


def _above(page: PageEvents, e: int) -> Iterator[int]:
    e = page.parents[e]
    while e >= 0:
        yield e
        e = page.parents[e]


def _inside(page: PageEvents, regions: set[int]) -> list[bool]:
    out = []
    for e, parent in enumerate(page.parents):
        out.append(e in regions or (parent >= 0 and out[parent]))
    return out


def _regions(page: PageEvents, excluded: list[bool], weight: np.ndarray) -> set[int]:
    """The elements that hold the article; ``weight`` is the clustered text in
    each element."""
    marked: set[int] = set()
    for kind in (ARTICLE, MAIN):
        found = [e for e, k in enumerate(page.kinds) if k == kind and not excluded[e]]
        within = _inside(page, set(found))
        outer = [e for e in found if not within[page.parents[e]]]
        most = max((weight[e] for e in outer), default=0)
        chosen = {e for e in outer if weight[e] >= SHARE * most > 0}
        if 2 * sum(weight[e] for e in chosen) >= weight[0] > 0:
            return chosen
        marked = marked or chosen
    if marked:
        return marked
    found = [e for e, k in enumerate(page.kinds) if k == CONTENT and not excluded[e]]
    most = max((weight[e] for e in found), default=0)
    if most * 2 >= weight[0] > 0:
        return {max(e for e in found if weight[e] >= REGION_SHARE * most)}
    return set()


def _complete(html: str) -> int:
    """Where an unfinished tag at the end starts, or the end."""
    at = html.rfind("<")
    return at if at >= 0 and html.find(">", at) < 0 and re.match(r"<[A-Za-z/!?]", html[at : at + 2]) else len(html)


def main_text(html: str | None) -> str:
    """The article of one page, a line per block."""
    if not html:
        return ""
    page = PageEvents()
    page.feed(html[: _complete(html)])
    page.finish()
    if not page.lines:
        return ""
    excluded = _excluded(page)
    out = np.array([excluded[block] for _, _, _, block in page.lines])
    ratio = np.array([0 if out[i] else (len(t) - linked) / tags for i, (t, tags, linked, _) in enumerate(page.lines)], float)
    smooth = np.where(out, 0.0, smoothed(ratio))
    if not smooth.any():
        # Nothing but links or excluded parts: the links of an article are text.
        smooth = np.where(out, 0.0, 1.0)
        if not smooth.any():
            return ""
    clustered = ~out & (smooth >= min(smooth.std(), smooth.max()))
    weight = np.zeros(len(page.tags))
    for i in np.flatnonzero(clustered):
        weight[page.lines[i][3]] += len(page.lines[i][0])
    for e in range(len(page.tags) - 1, 0, -1):
        weight[page.parents[e]] += weight[e]
    regions = _regions(page, excluded, weight)
    if regions:
        inside = _inside(page, regions)
        return "\n".join(t for i, (t, _, _, block) in enumerate(page.lines) if inside[block] and not out[i])
    return "\n".join(_unmarked(page, out, clustered, weight))


def _unmarked(page: PageEvents, out: np.ndarray, clustered: np.ndarray, weight: np.ndarray) -> list[str]:
    """Lines of the lowest element with nearly all clustered text: those in a
    cluster or between two, and the paragraphs and headings next to them."""
    region = max(e for e in range(len(page.tags)) if weight[e] >= REGION_SHARE * weight[0])
    inside = _inside(page, {region})
    text = [len(t) > 0 and linked < LINKED * len(t) for t, _, linked, _ in page.lines]
    own = [inside[block] and not out[i] and text[i] for i, (_, _, _, block) in enumerate(page.lines)]
    at = [i for i in np.flatnonzero(clustered) if inside[page.lines[i][3]]]
    first, last = at[0], at[-1]
    proper = lambda i: own[i] and (page.tags[page.lines[i][3]] == "p" or page.tags[page.lines[i][3]] in HEADINGS)
    while first > 0 and proper(first - 1):
        first -= 1
    while last + 1 < len(page.lines) and proper(last + 1):
        last += 1
    return [page.lines[i][0] for i in range(first, last + 1) if own[i] or clustered[i] and inside[page.lines[i][3]]]


def extract(pages: DataFrame, *, html: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every row of ``pages``."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(*keep, F.col(html).alias("_html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text="_html"):
            texts = [main_text(h) for h in step.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[step.column(c) for c in keep], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
