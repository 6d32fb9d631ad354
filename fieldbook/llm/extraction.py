"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, clustering by a threshold.

A line is a block of the page. Lines whose smoothed ratio reaches the threshold are content; they vote for the element that
holds the article, and every line of that element is kept but those inside menus, adverts, forms and the like.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea input dialog menu"
    " iframe object svg canvas audio video map".split()
)
#: Elements that stand inside a line and whose own text is not read.
SILENT = frozenset("script style template noscript svg canvas button select option textarea iframe object audio video map".split())
HOLDERS = frozenset(("article", "main"))
#: Classes, ids and roles, each as a whole, that mark what is not the article.
SIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs"
    " header masthead footer sidebar aside widget related recommended comment comments reply replies respond disqus notice cookie"
    " cookies consent gdpr popup modal newsletter subscribe signup login share sharing social toolbar pagination pager legal"
    " copyright complementary contentinfo search alert".split()
)
SIGMA = 1.0


class Lines(HTMLParser):
    """Blocks of a page: text, number of tags, whether they lie in a dropped part, and the elements around them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # tag, number of the element, inside a dropped part, numbers of the elements around it that a class or id marks
        self.stack: list[tuple[str, int, bool, tuple]] = []
        self.found: list[tuple[str, int, bool, tuple, tuple]] = []
        self.wraps: set[int] = set()  # marked elements that hold an article
        self.words: list[str] = []
        self.tags = self.count = self.silent = 0

    def updatepos(self, i, j):  # line numbers are not needed
        return j

    def cut(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            around = tuple(x for x in self.stack if x[0] in HOLDERS)
            self.found.append((text, self.tags, *(self.stack[-1][2:] if self.stack else (False, ())), around))
            self.tags = 0
        self.words = []

    @property
    def lines(self) -> list[tuple[str, int, bool, tuple]]:
        return [(text, tags, dropped or not self.wraps.issuperset(marks), around) for text, tags, dropped, marks, around in self.found]

    def aside(self, at: int = -1) -> bool:
        """Whether an open element lies in what is dropped, as far as is known."""
        return bool(self.stack) and (self.stack[at][2] or not self.wraps.issuperset(self.stack[at][3]))

    def dropped(self, tag: str, attrs: list) -> bool:
        """Whether the element goes whatever it holds."""
        if tag in DROPPED:
            return tag != "header" or not any(x[0] in HOLDERS for x in self.stack)
        plain = tag not in HOLDERS and tag not in ("body", "html")
        return any(
            name == "hidden" or name == "aria-hidden" and value == "true"
            or name == "role" and plain and not SIDE_WORDS.isdisjoint((value or "").lower().split())
            for name, value in attrs
        )

    def marked(self, tag: str, attrs: list) -> bool:
        """Whether a class or id says that the element is not the article; it stays if it holds, or is, the article itself."""
        inside = any(x[0] in HOLDERS for x in self.stack)
        if tag in ("body", "html") or tag in HOLDERS and not inside:
            return False
        words = {w for name, value in attrs if name in ("class", "id") for w in (value or "").lower().split()} & SIDE_WORDS
        return bool(words - {"header"} if inside else words)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.words.append(" ")
        if tag in VOID:
            return
        if tag in SILENT:
            self.silent += 1
            self.stack.append((tag, 0, True, ()))
            return
        if tag not in INLINE:
            self.cut()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):
                self.leave(tag, stop=("ul", "ol", "table", "dl", "article", "main", "div", "section", "body", "nav", "aside", "footer"))
        dropped, marks = self.stack[-1][2:] if self.stack else (False, ())
        own, mark = self.dropped(tag, attrs), self.marked(tag, attrs)
        if (own or mark) and not self.aside() and tag in INLINE and tag != "a":
            self.cut()
        if tag in HOLDERS and not (own or dropped or any(x[0] in HOLDERS for x in self.stack)):
            self.wraps.update(marks)  # an article inside another one, such as a comment, does not count
        self.count += 1
        self.stack.append((tag, self.count, dropped or own, (*marks, self.count) if mark else marks))

    def leave(self, tag: str, stop: tuple = ()) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self.silent -= sum(x[0] in SILENT for x in self.stack[at:])
                del self.stack[at:]
                return
            if self.stack[at][0] in stop:
                return

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.words.append(" ")
        elif tag not in INLINE and tag not in VOID and tag not in SILENT:
            self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.words.append(" ")
            return
        if tag in SILENT:
            self.leave(tag)
            return
        side = self.aside()
        if tag not in INLINE:
            self.cut()
        elif side and any(x[0] == tag for x in self.stack):
            at = max(i for i, x in enumerate(self.stack) if x[0] == tag)
            if at == 0 or not self.aside(at - 1):
                self.cut()  # an inline advert ends inside a line
        self.leave(tag, stop=("article", "main", "body", "nav", "footer", "aside") if tag in INLINE or tag == "p" else ())

    def handle_data(self, data):
        if not self.silent:
            self.words.append(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the weights at the ends are scaled to one."""
    reach = max(1, int(np.ceil(3 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = lambda x: np.convolve(x, weights)[reach : reach + len(x)]
    return full(ratios) / full(np.ones(len(ratios)))


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """Blocks of the article joined by an empty line; an empty text where there is none."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.cut()
    lines = parser.lines
    if not lines:
        return ""
    dropped = np.array([x[2] for x in lines])
    ratios = np.array([0.0 if x[2] else len(x[0]) / max(1, x[1]) for x in lines])
    level = smoothed(ratios, sigma)
    content = (level >= min(level.mean(), level.std() or 0.0)) & ~dropped
    if not content.any():
        content = ~dropped
    held = {x[3][0][1] for x, c in zip(lines, content, strict=True) if c and x[3]}
    if held:  # the outermost article or main elements that hold content
        kept = [not x[2] and bool(x[3]) and x[3][0][1] in held for x in lines]
    else:
        at = np.flatnonzero(content)
        first, last = (at[0], at[-1]) if len(at) else (0, -1)
        kept = [not x[2] and first - 1 <= i <= last + 1 for i, x in enumerate(lines)]
    return "\n\n".join(x[0] for x, k in zip(lines, kept, strict=True) if k)


def extract_pages(df: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id", "url"), out: str = "main_text") -> DataFrame:
    """The columns ``keep`` of every row and, as ``out``, the main text of its whole page.

    Null or empty pages, and pages without visible text, give an empty text. Unclosed elements end with their parent.
    Repeated rows and null ids stay; columns not named are not carried, so theirs may have any names.
    """
    kinds = dict(df.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h) for h in batch.column(0).to_pylist()]
        return {**{name: batch.column(i) for i, name in enumerate(keep, 1)}, out: texts}

    schema = ", ".join([*(f"`{name}` {kinds[name]}" for name in keep), f"`{out}` string"])
    return map_batches(df.select(F.col(html_col).alias("_text"), *keep), schema, run)
