"""Main-text extraction from HTML by parser events and the text-to-tag ratio of lines.

The standard library's streaming parser turns a page into lines (block elements, in page order). Elements that are never
content (menus, headers, footers, sidebars, forms, scripts, styles) give no lines. Of each line the ratio of unlinked
characters to tags is taken (its logarithm, beyond `FULL` characters a tag no more, so that one long paragraph doesn't
outweigh the others), smoothed with a Gaussian over the neighbouring lines, and split by a two-means threshold into
content and the rest; lines that lie close together are all content.

Two kinds of evidence stand beside the ratios. Marks (a form; class, id or role name an advert, a notice, comments, ...; an
article within an article is a comment too) take lines out, but only where unmarked lines are left, and only if they
can be what they say: a mark around a page's containers counts for nothing, nor does one, other than of comments, that
holds more than half of the text (of the containers' text where it stands in one). Short lines outside containers that
begin as a copyright line go too, if others are left. Inside containers the id of another
element than a div is an anchor and marks comments at most. Containers (`main`, else `article`) are a prior: lines outside
count as fewer characters. A region is a whole container that has a content line or mostly unlinked text; elsewhere it
runs from the first to the last content line of a cluster, with short lines between two content lines and the headings
before it kept.

Nothing is dropped or capped inside a region. Defined cases: a null, empty or markup-free html works like any other
(plain text is one line); unclosed elements end with their parent or the page; a page without text gives ""; null ids,
repeated rows and further columns change nothing, and an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_batches, whole_id

#: Fixed word lists: elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset("aside button canvas dialog fieldset footer head header iframe input menu nav noscript object option script search select style svg template textarea title".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A name of several words is a mark by its last one ("site-footer"), or by its first if the last only names a box
#: ("sidebar-left"), but not after a word of state ("no-ads", "with-sidebar").
MARKS = frozenset("ad ads advert adverts advertisement advertising aside banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disqus disclaimer footer header masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination paywall popup promo promoted promotion recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe teaser toolbar widget alert alertdialog complementary contentinfo discussion".split())
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
BOX = frozenset("area bar block bottom box button buttons center column container content footer form group holder inner item items left link links list module outer panel right row section slot thread top unit wrap wrapper".split())
STATE = frozenset("no not non without with has have hide hidden show is are was enable enabled disable disabled allow open closed".split())
#: Start tags that end an open p, as in the HTML standard's list.
ENDS_P = BLOCK - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "body", "html", "legend"}
#: Start tags that end open elements of some names, unless one of the others stands between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)), "thead": (("thead", "tbody", "tfoot"), ("table",)),
}

FULL = 100  # unlinked characters a tag of a line that is surely text
PRIOR = math.log(4)  # so many times fewer characters a line outside of a page's containers counts for
APART = math.log(3)  # content and the rest differ by this factor at least

LEGAL = re.compile(r"\s*(?:©|\(c\)|copyright\b|all rights reserved)", re.I)  # how a short line of a page's frame begins

_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def names_mark(name: str) -> str | None:
    """The word by which a name is a mark."""
    words = [w for w in _SPLIT.split(_CAMEL.sub(" ", name).lower()) if w]
    if not words or words[0] in STATE:
        return None
    return words[-1] if words[-1] in MARKS else words[0] if words[0] in MARKS and words[-1] in BOX else None


def marked(tag: str, attrs: list[tuple[str, str | None]], contained: bool = False) -> str | None:
    """The word that marks an element as hidden or as something else than content; containers are never marked by name."""
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "hidden"
        if value and name in ("class", "id", "role") and tag not in ("article", "main", "html", "body"):
            for word in filter(None, map(names_mark, value.split())):
                if name != "id" or not contained or tag == "div" or word in COMMENTS:
                    return word
    return None


class Line(NamedTuple):
    text: str
    plain: int  # characters outside links
    tags: int
    container: int  # its number, or -1
    heading: bool
    paragraph: bool
    marks: tuple[int, ...]  # the marked elements around it


class _Lines(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[str] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)  # the depths at which elements of a name are open
        self.blocks: list[int] = []  # the depths of open blocks
        self.headings = 0  # how many are open
        self.left_out: int | None = None  # depth at which a part that isn't content began
        self.links: list[int] = []  # depths of open links
        self.comments: set[int] = set()  # marked elements of readers' comments
        self.marks: list[tuple[int, int]] = []  # depth and number of the marked elements that are open
        self.n_marks = 0
        self.around: set[int] = set()  # marked elements with a container in them
        self.containers: list[tuple[int, int]] = []  # depth and number of those that are open
        self.kinds: list[tuple[str, tuple[int, ...]]] = []  # of each container, and the marks around it
        self.start()

    def start(self) -> None:
        self.text: list[str] = []
        self.plain, self.tags = 0, 0

    def flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                block = self.open[self.blocks[-1]] if self.blocks else ""
                self.lines.append(Line(text, self.plain, self.tags, self.containers[-1][1] if self.containers else -1, self.headings > 0, block == "p", tuple(n for _, n in self.marks)))
                self.start()
            else:
                self.text = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.tags += 1
            if self.left_out is None and tag == "hr":
                self.flush()
            elif self.left_out is None and tag == "br":
                self.text.append(" ")
            return
        if tag in ENDS:
            ended, between = ENDS[tag]
            depth = max((self.places[t][-1] for t in ended if self.places[t]), default=-1)
            if depth > max((self.places[t][-1] for t in between if self.places[t]), default=-1):
                self.cut(depth)
        elif tag in ENDS_P and self.places["p"] and self.places["p"][-1] >= self.blocks[-1]:
            self.cut(self.places["p"][-1])
        if self.left_out is None:
            if tag in BLOCK:
                self.flush()
            self.tags += 1
            container = tag in ("article", "main") or any(k == "role" and v in ("main", "article") for k, v in attrs)
            reply = tag == "article" and self.places["article"]
            word = "reply" if reply else attrs and marked(tag, attrs, bool(self.containers)) or (tag == "form" and "form")
            if tag in NEVER or tag not in BLOCK and word:
                self.left_out = len(self.open)
            elif word:
                if word in COMMENTS:
                    self.comments.add(self.n_marks)
                self.marks.append((len(self.open), self.n_marks))
                self.n_marks += 1
            elif container:
                main = tag == "main" or ("role", "main") in attrs
                if not self.containers or main and self.kinds[self.containers[-1][1]][0] != "main":
                    self.around.update(n for _, n in self.marks)
                    self.containers.append((len(self.open), len(self.kinds)))
                    self.kinds.append(("main" if main else "article", tuple(n for _, n in self.marks)))
            elif tag == "a":
                self.links.append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
            self.headings += tag in HEADING
        self.places[tag].append(len(self.open))
        self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "span", "a", "b", "i"):  # a slash counts in foreign elements only
            self.handle_endtag(tag)

    def cut(self, depth: int) -> None:
        """Ends all elements from this depth on."""
        if self.left_out is None and self.blocks and self.blocks[-1] >= depth:
            self.flush()
        for tag in self.open[depth:]:
            self.places[tag].pop()
            self.headings -= tag in HEADING
        del self.open[depth:]
        if self.left_out is not None and depth <= self.left_out:
            self.left_out = None
        for stack in (self.blocks, self.links):
            while stack and depth <= stack[-1]:
                stack.pop()
        for stack in (self.marks, self.containers):
            while stack and depth <= stack[-1][0]:
                stack.pop()

    def handle_endtag(self, tag: str) -> None:
        if self.left_out is None:
            self.tags += 1
        depth = self.places[tag][-1] if self.places[tag] else -1
        if depth >= 0 and (tag in BLOCK or tag in NEVER or not self.blocks or depth >= self.blocks[-1]):
            self.cut(depth)

    def handle_data(self, data: str) -> None:
        if self.left_out is None:
            self.text.append(data)
            if not self.links:
                self.plain += len(data)

    def finish(self, html: str) -> list[Line]:
        """The lines, with the page's own containers alone and with the marks that count."""
        self.feed(html)
        self.close_input()
        self.flush()
        own = {n for n, (_, marks) in enumerate(self.kinds) if not marks}
        void = set() if own else self.around  # every container stands in a marked element: so does the content
        own = own or set(range(len(self.kinds)))
        if any(self.kinds[n][0] == "main" for n in own):
            own = {n for n in own if self.kinds[n][0] == "main"}
        lines = [x._replace(container=x.container if x.container in own else -1) for x in self.lines]
        void = void | self.too_large(lines)
        return [x._replace(marks=tuple(m for m in x.marks if m not in void)) for x in lines]

    def too_large(self, lines: list[Line]) -> set[int]:
        """Marked elements, other than comments, that hold more than half of the text around them."""
        inside = [x for x in lines if x.container >= 0]
        if sum(x.plain for x in inside):
            lines = inside
        lines = [x for x in lines if self.comments.isdisjoint(x.marks)]
        held: Counter[int] = Counter()
        for x in lines:
            for m in x.marks:
                held[m] += x.plain
        whole = sum(x.plain for x in lines)
        return {m for m, n in held.items() if 2 * n > whole}

    def close_input(self) -> None:
        super().close()


def smoothed(ratios: list[float], sigma: float) -> list[float]:
    reach = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratios)):
        low, high = max(0, i - reach), min(len(ratios), i + reach + 1)
        part = kernel[low - i + reach : high - i + reach]
        out.append(sum(a * b for a, b in zip(ratios[low:high], part)) / sum(part))
    return out


def threshold(values: list[float], apart: float = 0.0) -> float:
    """Where two-means splits the values; content is at or above it. Means no more than `apart` apart: all content."""
    least = min(values)
    low, high = min(values), max(values)
    if high <= low:
        return low
    for _ in range(32):
        middle = (low + high) / 2
        under, over = [x for x in values if x < middle], [x for x in values if x >= middle]
        if not under or not over:
            break
        now = sum(under) / len(under), sum(over) / len(over)
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2 if high - low > apart else least


def main_text(html: str | None, sigma: float = 1.0, gap: int = 3) -> str:
    """The content regions of a page, its blocks joined by an empty line.

    gap: so many short lines between two content lines still belong to one region, outside containers.
    """
    if not html:
        return ""
    lines = _Lines().finish(html)
    lines = [x for x in lines if not x.marks] or lines
    lines = [x for x in lines if x.container >= 0 or len(x.text) > FULL or not LEGAL.match(x.text)] or lines
    if not lines:
        return ""
    contained = any(x.container >= 0 for x in lines)
    ratios = [math.log1p(min(FULL, x.plain / max(1, x.tags))) for x in lines]
    scores = [max(0.0, x - PRIOR) if contained and line.container < 0 else x for x, line in zip(smoothed(ratios, sigma), lines)]
    least = threshold(scores, APART)
    content = [i for i, x in enumerate(scores) if x >= least]
    whole = {lines[i].container for i in content}
    unlinked: Counter[int] = Counter()
    for x in lines:
        unlinked[x.container] += 2 * x.plain - len(x.text)
    whole = (whole | {n for n, more in unlinked.items() if more > 0}) - {-1}
    kept = {i for i, line in enumerate(lines) if line.container in whole}
    loose = [i for i in content if lines[i].container < 0]
    for i in loose:
        kept.add(i)
        while i and lines[i - 1].heading and lines[i - 1].container < 0:
            i -= 1
            kept.add(i)
    for a, b in zip(loose, loose[1:]):
        if b - a <= gap + 1:
            kept.update(range(a, b))
    # outside containers, what is all links is a menu, unless it is a paragraph or all there is
    return "\n\n".join(lines[i].text for i in sorted(kept) if lines[i].plain or lines[i].container >= 0 or lines[i].paragraph or len(lines) == 1)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of `pages`."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 16 << 20):
            texts = [main_text(html) for html in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(whole_id("page_id").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
