"""Main text of web pages by text-to-tag ratios.

A streaming parser turns a page into lines, one for each run of text between block
boundaries, with its characters, its tags and whether they stand in links.  The ratio of
characters to tags is smoothed along the page by a Gaussian; lines above a threshold of one
standard deviation are content, and runs of them are clusters.  The region of the article
is the element that most of the clusters' text is in: an ``article`` or ``main`` if one
holds a fair share of it, else an element that is called so, else the deepest one with
nearly all.  Of such a region every line stays, however short; of a nameless one what lies
from the first to the last cluster, and beside them paragraphs and headings, but for links.
Parts of the page that say what they are (menus, page headers, footers, sidebars, notices,
adverts, forms, scripts, comments of readers) take no part in any of this.

Each page is parsed in its own row: no shuffle, and memory of one page.

Defined results: a null or empty page, or one without such text, gives ''; broken markup is
read as browsers do where an end tag is left out, and an end tag without a start is passed
over; text in no element at all counts as in the page's body; repeated rows and equal or
null ids give a result each; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows

#: Standard deviation of the smoothing in lines, and of how many deviations of the smoothed ratios the threshold is made.
SIGMA, THRESHOLD = 1.0, 1.0
#: Shares of the clusters' text that a region must hold: a marked one, one called so, a nameless one; links in a line that is no text.
MARKED_SHARE, CALLED_SHARE, NAMELESS_SHARE, LINK_SHARE = 0.25, 0.5, 0.9, 0.5

# Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base link meta noscript script style template title".split())
BLOCKS = frozenset(
    """address article aside blockquote body button caption center canvas datalist dd details dialog dir div dl dt fieldset figcaption figure footer form frameset
    h1 h2 h3 h4 h5 h6 head header hgroup html iframe legend li main menu nav noscript object ol optgroup option p pre script search section select style summary svg
    table tbody td template textarea tfoot th thead title tr ul video audio""".split()
)
LEFT_OUT = frozenset("aside audio button canvas datalist dialog fieldset footer form head iframe legend menu nav noscript object optgroup option script search select style svg template textarea title video".split())
REGIONS = frozenset("html body div section article main td center".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption".split())
#: A start tag of the second kind ends an open element of the first.
ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option", "optgroup"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}}
# Words in names and roles of parts that are not the article, and of parts that are.
OTHER_WORDS = frozenset(
    """ad ads adbox adsense adslot advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs colophon comment comments complementary consent
    contentinfo cookie cookies copyright dialog disclaimer discussion disqus feedback footer gdpr legal login masthead menu menus modal nav navbar navigation newsletter
    notice notices notification overlay pager pagination paywall popup promo promoted promotion rail recommended register related replies reply respond search share
    sharing sidebar signup social sponsor sponsored submenu subscribe subscription toolbar topbar widget widgets""".split()
)
HEADER_WORDS = frozenset({"header"})
ARTICLE_WORDS = frozenset("article content entry main post story".split())
#: A name with one of these in it tells of something else than its element.
FOREIGN_WORDS = frozenset("category format has is no status tag type with without".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Node:
    tag: str
    parent: int
    out: str  # why the element is no part of the article, or ''
    called: bool
    inside: bool  # of an article or main element


@dataclass
class Line:
    node: int
    text: str
    tags: int
    linked: int  # characters in links
    content: bool = False


@dataclass
class Page(HTMLParser):
    """Lines and elements of a page."""

    nodes: list[Node] = field(default_factory=list)
    lines: list[Line] = field(default_factory=list)

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes.append(Node("html", -1, "", False, False))
        self.stack, self.open = [0], Counter({"html": 1})
        self.pieces: list[str] = []
        self.tags = self.linked = 0
        self.link = False

    def _end_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.lines.append(Line(self.stack[-1], text, self.tags, self.linked))
            self.tags = 0
        self.pieces, self.linked = [], 0

    def _pop(self) -> None:
        self.open[self.nodes[self.stack.pop()].tag] -= 1

    def _top(self) -> str:
        return self.nodes[self.stack[-1]].tag

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open["head"] and tag not in HEAD and tag != "head":
            self._end_line()
            while self.open["head"]:
                self._pop()
        self.tags += 1
        if tag == "a":
            self.link = True
        if tag == "br":
            self.pieces.append(" ")
        elif tag == "hr":
            self._end_line()
        if tag in VOID or tag in ("html", "body") and self.open[tag]:
            return
        known = dict(attrs)
        out, called = told(tag, known, self.nodes[self.stack[-1]].inside)
        block = tag in BLOCKS
        if not block and not out and not self.open[tag]:
            return
        self._end_line()
        if block:
            if self._top() == "p":
                self._pop()
            while self._top() in ENDS.get(tag, ()):
                self._pop()
        up = self.nodes[self.stack[-1]]
        # a form, or a menu whose end is left out, is about the article when that begins in it
        held = up.out if not (tag in ("article", "main") and up.out in ("form", "nav")) else ""
        self.nodes.append(Node(tag, self.stack[-1], out or held, called, up.inside or tag in ("article", "main")))
        self.stack.append(len(self.nodes) - 1)
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "iframe"):  # foreign elements can end in their start tag, others can't
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.link = False
        if not self.open[tag]:
            return
        if tag in ("html", "body"):  # what follows counts as in the body
            self._end_line()
            return
        self._end_line()
        self.link = False
        while self._top() != tag:
            self._pop()
        self._pop()

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)
        if self.link:
            self.linked += len(data) - data.count(" ")

    # the page is fed whole, so a tag or comment that doesn't end there is passed over to the page's end, as browsers do
    def _to_end(self, k: int) -> int:
        return k if k >= 0 else len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        return self._to_end(super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self._to_end(super().parse_endtag(i))

    def parse_pi(self, i: int) -> int:
        return self._to_end(super().parse_pi(i))

    def parse_comment(self, i: int, report: int = 1) -> int:
        return self._to_end(super().parse_comment(i, report))

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<![", i):
            return self._to_end(self.parse_bogus_comment(i))
        return self._to_end(super().parse_html_declaration(i))

    def whole(self, text: str) -> Page:
        self.feed(text)
        self.close()
        self._end_line()
        return self


def told(tag: str, attrs: dict[str, str | None], inside: bool) -> tuple[str, bool]:
    """Why an element is no part of the article ('' if it may be), and whether it is called one."""
    if tag in LEFT_OUT or tag == "header" and not inside:
        return tag, False
    if tag in ("html", "body", "main"):
        return "", False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style") or ""):
        return "hidden", False
    called = False
    for name in (f"{attrs.get('class') or ''} {attrs.get('id') or ''} {attrs.get('role') or ''}").split():
        words = {w.lower() for w in _WORD.findall(name)}
        if not words & FOREIGN_WORDS:
            if words & OTHER_WORDS or not inside and words & HEADER_WORDS:
                return "called", False
            called |= bool(words & ARTICLE_WORDS)
    return "", called


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Each ratio as the Gaussian mean of those around it; at the ends of those there are."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    whole = lambda x: np.convolve(x, kernel)[reach : reach + len(x)]
    return whole(ratios) / whole(np.ones(len(ratios)))


def mark_clusters(lines: list[Line]) -> None:
    """Content are the runs of lines whose smoothed ratio is above the threshold, from the first to the last line that is so by itself; all lines, if there is none."""
    if not lines:
        return
    ratios = np.array([len(x.text) / max(1, x.tags) for x in lines], float)
    smooth = smoothed(ratios)
    limit = THRESHOLD * smooth.std()
    above, own = smooth > limit, ratios > limit
    number = np.cumsum(np.diff(above, prepend=False))  # of the run
    kept = np.zeros(len(lines), bool)
    core = np.flatnonzero(above & own)
    for run in np.unique(number[core]):
        inside = core[number[core] == run]
        kept[inside[0] : inside[-1] + 1] = True
    for x, a in zip(lines, kept if kept.any() else ~kept):
        x.content = bool(a)


def region(nodes: list[Node], lines: list[Line]) -> int:
    """The element of the article."""
    held = np.zeros(len(nodes), np.int64)
    for x in lines:
        if x.content:
            held[x.node] += len(x.text)
    for i in range(len(nodes) - 1, 0, -1):
        held[nodes[i].parent] += held[i]
    fits = lambda share, kind: [i for i, n in enumerate(nodes) if held[i] and held[i] >= share * held[0] and kind(n)]
    marked = fits(MARKED_SHARE, lambda n: n.tag in ("article", "main"))
    if marked:
        # articles that hold it, else all of them by the main element; the outermost of those within each other
        best = max(marked, key=lambda i: (held[i], nodes[i].tag == "article", -i))
        return best if held[best] >= CALLED_SHARE * held[0] or len(marked) == 1 else _common(nodes, marked)
    if called := fits(CALLED_SHARE, lambda n: n.called and n.tag in REGIONS):
        return called[-1]
    return fits(NAMELESS_SHARE, lambda n: n.tag in REGIONS)[-1]


def _common(nodes: list[Node], some: list[int]) -> int:
    """The deepest element around all of them."""
    line = lambda i: [*(line(nodes[i].parent) if i else ()), i]
    paths = [line(i) for i in some]
    return [a for a, *rest in zip(*paths) if all(a == b for b in rest)][-1]


def main_lines(html: str) -> list[Line]:
    """The lines of the article in page order."""
    page = Page().whole(html)
    nodes, lines = page.nodes, [x for x in page.lines if not page.nodes[x.node].out]
    if not lines:
        return []
    mark_clusters(lines)
    top = region(nodes, lines)
    within = [False] * len(nodes)
    for i, n in enumerate(nodes):
        within[i] = i == top or n.parent >= 0 and within[n.parent]
    own = [x for x in lines if within[x.node]]
    if nodes[top].tag in ("article", "main") or nodes[top].called:
        return own
    marks = [i for i, x in enumerate(own) if x.content]
    first, last = marks[0], marks[-1]
    return [x for i, x in enumerate(own) if x.linked < LINK_SHARE * len(x.text) and (first <= i <= last or nodes[x.node].tag in TEXT)]


def main_text(html: str | None) -> str:
    return " ".join(x.text for x in main_lines(html or ""))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, text, n_chars."""
    kinds = dict(df.dtypes)
    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{url_col}`").alias("u"), F.col(f"`{html_col}`").cast("string").alias("h"))

    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(x.as_py()) for x in batch.column("h")]
        return {"i": batch.column("i"), "u": batch.column("u"), "text": texts, "n_chars": [len(x) for x in texts]}

    return map_rows(rows, run, f"i {kinds[id_col]}, u {kinds[url_col]}, text string, n_chars long").toDF(id_col, url_col, "text", "n_chars")


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
