"""Main text of web pages by text-to-tag ratios.

Events of the standard library's parser are turned into lines, one for each block,
without building a tree. A line's ratio of text to tags, smoothed over its neighbours
by a Gaussian, is compared with a threshold; the lines above it are the core of the
content, and the regions of the page that hold core lines are the content.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.names import quoted
from postlens.llm.common import map_texts

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
REGIONS = frozenset("article main section div td body".split())
CONTENT = frozenset("article main".split())
LEFT_OUT = frozenset(
    "aside button canvas dialog footer iframe menu nav noscript object option script select style svg "
    "template textarea title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# End tags that may be left out: where an element begins, the innermost open one of the named ones ends,
# unless one of the second names lies between.
ENDS_P = BLOCKS - frozenset("br body caption head html legend option summary tbody td tfoot th thead title tr".split())
ENDED_BY = {tag: [(("p",), CONTENT | {"table"})] for tag in ENDS_P}
ENDED_BY["li"].append((("li",), frozenset("ul ol menu".split())))
for _tag in ("dd", "dt"):
    ENDED_BY[_tag].append((("dd", "dt"), frozenset(["dl"])))
for _tag in ("td", "th"):
    ENDED_BY[_tag] = [(("td", "th"), frozenset(["tr", "table"]))]
ENDED_BY["tr"] = [(("tr",), frozenset(["table"]))]
ENDED_BY["option"] = [(("option",), frozenset(["select"]))]
# Names in a class, id or role that mark a part as none of the article's text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe sidebar aside complementary widget menu nav "
    "navbar navigation breadcrumb breadcrumbs masthead topbar footer contentinfo copyright comment comments disqus "
    "replies share sharing social related recommended pager pagination login signup search form dialog".split()
)
PAGE_HEADER = frozenset(["header"])  # left out unless it is the article's own
# Words that turn a name like has-sidebar or comments-open into a remark on something else.
REMARKS = frozenset(
    "has no not with without is hide hides hidden show shows open opened closed enabled disabled allowed on off "
    "count layout template".split()
)
NOT_A_WORD = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
SIGMA = 1.0
MOST = 0.75
PARAGRAPHS = 3
_marks_of: dict[str, tuple[int, int]] = {}


def mark_strength(value: str) -> tuple[int, int]:
    """How far a class, id or role marks its element: 2 by a whole name, 1 by a part of one, 0 not at all;
    and the same for page headers."""
    found = _marks_of.get(value)
    if found is None:
        strength = [0, 0]
        for name in value.split():
            words = set(NOT_A_WORD.split(CAMEL.sub("-", name).lower())) - {""}
            for i, marks in enumerate((MARKS, PAGE_HEADER)):
                if name.lower() in marks:
                    strength[i] = 2
                elif not marks.isdisjoint(words) and REMARKS.isdisjoint(words):
                    strength[i] = max(strength[i], 1)
        if len(_marks_of) >= 10_000:
            _marks_of.clear()
        found = _marks_of[value] = (strength[0], strength[1])
    return found


@dataclass
class Mark:
    """An element that looks like none of the article's text."""

    parent: int  # the mark around it, -1 for none
    strong: bool
    declares: bool = False  # holds an article that is not marked itself
    chars: int = 0
    paragraphs: int = 0
    applies: bool = True


@dataclass
class Line:
    pieces: list[tuple[str, int, int]]  # text, mark, characters if inside a link
    tags: int
    region: int
    declared: bool
    paragraph: bool
    text: str = ""
    links: int = 0


class LineParser(HTMLParser):
    """Collects the lines of a page and its marks; parts that are left out by their tag give no line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.marks: list[Mark] = []
        self.open: list[tuple[str, bool, int, bool, int]] = []  # tag, left out, region, in content, mark
        self.pieces: list[tuple[str, int, int]] = []
        self.tags = self.regions = self.link_depth = 0
        self.counts = dict.fromkeys(("p", "li", "dd", "dt", "option", "tr", "td", "th"), 0)  # open elements

    def end_line(self) -> None:
        if self.pieces:
            if any(text and not text.isspace() for text, _, _ in self.pieces):
                tag, _, region, content, _ = self.open[-1] if self.open else ("", False, 0, False, -1)
                self.lines.append(Line(self.pieces, self.tags, region, content, tag == "p" or self.counts["p"] > 0))
                self.tags = 0
            self.pieces = []

    def close_to(self, at: int) -> None:
        """Close the element at that place, with what it holds and was not closed."""
        for entry in self.open[at:]:
            if entry[0] in self.counts:
                self.counts[entry[0]] -= 1
        del self.open[at:]

    def imply_ends(self, tag: str) -> None:
        for names, within in ENDED_BY[tag]:
            if not any(self.counts[name] for name in names):
                continue
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i][0]
                if name in names:
                    self.close_to(i)
                    break
                if name in within:
                    break

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
            if tag in ENDED_BY:
                self.imply_ends(tag)
        self.tags += 1
        if tag in VOID:
            return
        if tag == "a":
            self.link_depth = 1
        out, region, content, mark = self.open[-1][1:] if self.open else (False, 0, False, -1)
        strength, header, declared = 0, 2 * (tag == "header"), tag in CONTENT
        if tag == "form":
            strength = 1
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                own = mark_strength(value)
                strength, header = max(strength, own[0]), max(header, own[1])
                declared = declared or value.lower() == "main"
        if not content:
            strength = max(strength, header)
        if strength and tag not in ("html", "body", "main"):
            self.marks.append(Mark(mark, strength == 2))
            mark = len(self.marks) - 1
        elif declared:
            at = mark
            while at >= 0:
                self.marks[at].declares = True
                at = self.marks[at].parent
        declared = declared and (mark < 0 or mark == (self.open[-1][4] if self.open else -1))
        if not content and (declared or tag in REGIONS):  # one region for all of an article
            self.regions += 1
            region = self.regions
        if tag in self.counts:
            self.counts[tag] += 1
        self.open.append((tag, out or tag in LEFT_OUT, region, content or declared, mark))

    def handle_endtag(self, tag):
        block = tag in BLOCKS
        if block:
            self.end_line()
        self.tags += 1
        if tag == "a":
            self.link_depth = 0
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                self.close_to(i)
                break
            if not block and name in BLOCKS:
                break  # an inline element ends within its block

    def handle_data(self, data):
        if not self.open:
            self.pieces.append((data, -1, self.link_depth * len(data)))
        elif not self.open[-1][1]:
            self.pieces.append((data, self.open[-1][4], self.link_depth * len(data)))

    def close(self):
        super().close()
        self.end_line()

    def settle_marks(self) -> None:
        """Decide which marks hold.

        None does on an element with an article in it. One by a part of a name, or a form, holds unless
        it has several paragraphs and most of the page's text, and no article stands elsewhere.
        """
        total, declared = 0, False
        for line in self.lines:
            for text, mark, _ in line.pieces:
                size = len(text.strip())
                total += size
                declared = declared or (line.declared and size > 0 and mark < 0)
                while mark >= 0:
                    self.marks[mark].chars += size
                    mark = self.marks[mark].parent
            mark = line.pieces[0][1]
            while line.paragraph and mark >= 0:
                self.marks[mark].paragraphs += 1
                mark = self.marks[mark].parent
        for mark in self.marks:
            whole = not mark.strong and not declared and mark.chars > MOST * total and mark.paragraphs >= PARAGRAPHS
            mark.applies = not (mark.declares or whole)

    def apply_marks(self) -> None:
        """Set the lines' texts to what marks that hold leave of them."""
        hidden = []
        for mark in self.marks:  # a mark comes after the one around it
            hidden.append(mark.applies or (mark.parent >= 0 and hidden[mark.parent]))
        for line in self.lines:
            left = [piece for piece in line.pieces if piece[1] < 0 or not hidden[piece[1]]]
            line.text = " ".join("".join(text for text, _, _ in left).split())
            line.links = min(sum(n for _, _, n in left), len(line.text))

    def kept_lines(self) -> list[Line]:
        """The lines with their texts. Where marks leave nothing but links, the outermost ones do not hold."""
        self.settle_marks()
        while True:
            self.apply_marks()
            outer = [m for m in self.marks if m.applies and m.chars]
            if not outer or any(len(line.text) > line.links for line in self.lines):
                return self.lines
            tops = [m for m in outer if m.parent < 0 or not self.marks[m.parent].applies]
            for mark in tops or outer:
                mark.applies = False


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; beyond the ends there are no lines, and weights are as those of what is there."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / weight


def main_blocks(html: str | None, sigma: float = SIGMA) -> list[str]:
    """The blocks of the main text in page order.

    The core lines are those whose smoothed ratio reaches one standard deviation of
    all ratios, and the highest line in any case; marked lines have the ratio zero. Short lines stay with
    the region of a core line. Articles that hold half of the text or more of the regions found are all of
    it. A page without text outside menus and the like has no block.
    """
    parser = LineParser()
    parser.feed(html or "")
    parser.close()
    lines = parser.kept_lines()
    if not any(x.text for x in lines):
        return []
    chars = np.array([len(x.text) - x.links for x in lines], float)
    ratios = chars / np.array([max(1, x.tags) for x in lines])
    even = smoothed(ratios, sigma)
    core = (even >= min(ratios.std(), even.max())) & (ratios > 0)
    if not core.any():
        core = (even == even.max()) & np.array([bool(x.text) for x in lines])
    regions = {x.region for x, kept in zip(lines, core) if kept}
    found = [x for x in lines if x.text and x.region in regions]
    articles = [x for x in found if x.declared]
    if 2 * sum(len(x.text) for x in articles) >= sum(len(x.text) for x in found):
        found = articles
    return [x.text for x in found]


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Replace the markup by the main text, blocks joined by one space.

    A NULL or empty page has the empty text. Other columns stay.
    """

    def make():
        return lambda texts: [pa.array([" ".join(main_blocks(t)) for t in texts], pa.string())]

    return map_texts(pages, html, make, f"`{out}` string")


def page_texts(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: id, url, ``text`` and ``n_chars``. Repeated rows come back as often as they
    occur, an empty table gives an empty result, and other columns are ignored."""
    found = extract_text(pages.select(*(F.col(quoted(c)) for c in (id, url, html))), html, "text")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
