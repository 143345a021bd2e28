"""Main text of web pages from streamed parser events.

The standard library's parser streams a page; block elements cut its text into
lines, each with its text-to-tag ratio.  The ratios are smoothed by a Gaussian
kernel over neighbouring lines and split into two clusters by a threshold (two
means).  Lines belong to content regions (an ``article`` or ``main`` element,
else an outermost division of the body, else the body); regions that hold a line above the
threshold are content, the best region always is, and where a page marks
articles only those compete.  A content region keeps all its lines, short ones
too; menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are left out wherever they stand.

Text: character references decoded, white space inside a block one space,
trimmed, blocks joined by a newline in page order, nothing else dropped.  A tag
or comment cut off by the end of the page is markup, not text.  Time is linear in
the page's length, whatever its markup: elements are counted by tag, so that an
end tag without its start is skipped without a search.

Edge cases: a null or empty page, or one without text, gives an empty text;
null ids and URLs and repeated rows are kept; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import text_slices

SIGMA = 1.5
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
LEFT_OUT = frozenset("aside audio button canvas dialog fieldset footer form head header iframe input menu nav noscript "
                     "object script select style svg template textarea title video".split())
LEFT_OUT_NAMES = frozenset("ad ads advert adverts advertisement banner banners breadcrumb breadcrumbs comment comments "
                           "complementary contentinfo cookie cookies disqus footer form header menu modal nav navbar "
                           "navigation newsletter notice notices popup promo promoted related replies respond search "
                           "share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
CONTAINERS = frozenset("center div section table".split())
MAIN = frozenset(("article", "main"))
_TAG_START = re.compile(r"<[a-zA-Z/!?]")
_SPACE = re.compile(r"\s+")


def whole_markup(html: str) -> str:
    """``html`` without the tag or comment that its end cuts off: from the first
    comment that nothing closes, or the first tag start behind the last ``>``."""
    closed = html.rfind("-->")
    comment = html.find("<!--", max(closed - 3, 0))
    if comment >= 0:
        html = html[:comment]
    tag = _TAG_START.search(html, html.rfind(">") + 1)
    return html[:tag.start()] if tag else html


def _named_out(attrs) -> bool:
    """The element's class, id or role names a part that is no article text."""
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for word in value.lower().split():
                parts = re.findall("[a-z0-9]+", word)
                if parts and parts[0] not in ("has", "with", "no") and (parts[0] in LEFT_OUT_NAMES or parts[-1] in LEFT_OUT_NAMES):
                    return True
    return False


class Lines(HTMLParser):
    """Lines of a page: [text pieces, tags, region, left out]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []   # (tag, left out, region)
        self.opened: Counter[str] = Counter()         # open elements by tag
        self.lines: list[list] = []
        self.marked: set[int] = set()                 # regions that are an article or main
        self.regions = 0
        self.fresh = True

    def _state(self) -> tuple[bool, int]:
        return self.open[-1][1:] if self.open else (False, 0)

    def _line(self) -> list:
        out, region = self._state()
        if self.fresh or self.lines[-1][2:] != [region, out]:
            self.lines.append([[], 1, region, out])
            self.fresh = False
        return self.lines[-1]

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.fresh = True
            while self.open and (self.open[-1][0] in INLINE or self.open[-1][0] == "p"):
                self.opened[self.open.pop()[0]] -= 1
        elif not self.fresh:
            self.lines[-1][1] += 1
            if tag == "br":
                self.lines[-1][0].append(" ")
        if tag in VOID:
            return
        out, region = self._state()
        if tag not in ("html", "body"):
            if tag in MAIN and region not in self.marked:
                self.regions += 1
                region = self.regions
                self.marked.add(region)
            elif not region and tag in CONTAINERS:
                self.regions += 1
                region = self.regions
        out = out or tag in LEFT_OUT or (tag not in MAIN and tag not in ("html", "body") and _named_out(attrs))
        self.open.append((tag, out, region))
        self.opened[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.fresh = True
        elif not self.fresh:
            self.lines[-1][1] += 1
        closed = "" if self.opened[tag] else tag      # an end tag without its start closes nothing
        while closed != tag:
            closed = self.open.pop()[0]
            self.opened[closed] -= 1

    def handle_data(self, data):
        if self.fresh and not data.strip():
            return
        self._line()[0].append(data)

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach:reach + len(ratios)] / weight


def threshold(values: np.ndarray) -> float:
    """The middle between the centres of two clusters (two means)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        above = values >= cut
        new = (float(values[~above].mean()) if (~above).any() else low, float(values[above].mean()))
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(whole_markup(html))
    parser.close()
    lines = [(_SPACE.sub(" ", "".join(parts)).strip(), tags, region, out) for parts, tags, region, out in parser.lines]
    lines = [x for x in lines if x[0]]
    if not lines:
        return ""
    ratio = smooth(np.array([len(t) / tags for t, tags, _, _ in lines]))
    best: dict[int, float] = {}
    for (_, _, region, out), r in zip(lines, ratio.tolist()):
        if not out:
            best[region] = max(best.get(region, 0.0), r)
    if any(r in parser.marked for r in best):
        best = {r: x for r, x in best.items() if r in parser.marked}
    if not best:
        return ""
    cut = min(threshold(ratio), max(best.values()))
    content = {r for r, x in best.items() if x >= cut}
    return "\n".join(t for t, _, region, out in lines if region in content and not out)


def _extract(batches):
    for b in text_slices(batches):
        texts = [main_text(h) for h in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())],
                                         names=["page_id", "url", "text"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key, url, text`` of every page."""
    rows = pages.select(pages[key].cast("long").alias("page_id"), pages[url].cast("string").alias("url"),
                        F.coalesce(pages[html].cast("string"), F.lit("")).alias("text"))
    out = rows.mapInArrow(_extract, "page_id long, url string, text string")
    return out.withColumnsRenamed({"page_id": key, "url": url})
