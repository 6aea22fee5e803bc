"""Main text of web pages by text-to-tag ratios.

The standard library's parser turns a page into events; block tags cut its text into
lines. A line's ratio is its characters over the tags it holds. Ratios are smoothed with
a Gaussian and cut in two clusters by a threshold; a region (the lines of one container)
is content when its highest smoothed ratio is in the upper cluster. Menus, adverts and
the like are named by their elements and never content; what a page marks as its article
is always content.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sftprep.llm.store import byte_slices

SIGMA = 1.0

# Element names and the words of class, id and role that mark what is
# around an article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_SILENT = frozenset(
    "audio button canvas datalist dialog footer form head iframe math menu nav noscript object script select "
    "style svg template textarea title video aside".split()
)
_CONTENT = frozenset(("article", "main"))
_OPAQUE = frozenset(("script", "style"))
_CONTAINERS = frozenset("article body center div html main section table tbody td th tr".split())
_AROUND = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies copyright disclaimer discussion disqus footer gdpr masthead menu nav navbar "
    "navigation newsletter notice notices paywall popup promo promoted promotion related replies respond search "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar complementary".split()
)
_HEADERS = frozenset(("header", "site-header", "page-header"))
_MARKUP = re.compile(r"<[a-zA-Z/!?]")
_NAME = re.compile(r"[a-z]+")
# Elements that end at the next of their kind when nothing else is open between.
_ENDS_ITSELF = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_KEEPS_PARAGRAPH = _INLINE | frozenset(("p",))


def _around(tag: str, attrs: list[tuple[str, str | None]], in_content: bool) -> bool:
    """Whether an element holds what stands around an article."""
    if tag in _SILENT:
        return True
    if tag in ("body", "html", "main"):
        return False
    if tag == "article":
        # A comment may be marked up as an article of its own.
        return any(k == "class" and v and not _AROUND.isdisjoint(v.lower().split()) for k, v in attrs)
    if tag == "header" and not in_content:
        return True
    for key, value in attrs:
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key in ("class", "id", "role") and value:
            low = value.lower()
            if not in_content and any(word in _HEADERS for word in low.split()):
                return True
            if any(word in _AROUND for word in _NAME.findall(low)):
                return True
    return False


class _Lines(HTMLParser):
    """Lines of a page: ``texts``, ``tags``, ``regions`` and whether each is ``silent``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.regions: list[int] = []
        self.silent: list[bool] = []
        self.named: set[int] = set()
        # Open elements other than inline ones: (tag, silent, in content, region).
        self._open: list[tuple[str, bool, bool, int]] = [("", False, False, 0)]
        self._next_region = 0
        self._parts: list[str] = []
        self._count = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text or self._count:
            _, silent, _, region = self._open[-1]
            self.texts.append(text)
            self.tags.append(self._count)
            self.regions.append(region)
            self.silent.append(silent)
        self._parts, self._count = [], 0

    def _close_to(self, place: int) -> None:
        del self._open[place:]

    def handle_starttag(self, tag, attrs):
        if tag == "br" or tag == "wbr":
            self._count += 1
            if tag == "br":
                self._parts.append(" ")
            return
        if tag in _INLINE:
            # An inline element counts, and is opened only when it hides what it holds.
            self._count += 1
            if _around(tag, attrs, self._open[-1][2]) and tag not in _VOID:
                self._end_line()
                self._open.append((tag, True, self._open[-1][2], self._open[-1][3]))
            return
        self._end_line()
        self._count += 1
        if tag in _VOID:
            return
        if tag not in _KEEPS_PARAGRAPH and self._open[-1][0] == "p":
            self._close_to(len(self._open) - 1)
        if self._open[-1][0] in _ENDS_ITSELF.get(tag, ()):
            self._close_to(len(self._open) - 1)
        _, silent, content, region = self._open[-1]
        if tag in _CONTAINERS:
            inner = content
            content = content or tag in _CONTENT or any(k == "role" and v == "main" for k, v in attrs)
            # What lies within a marked article is one region with it.
            if not inner:
                self._next_region += 1
                region = self._next_region
                if content:
                    self.named.add(region)
        self._open.append((tag, silent or _around(tag, attrs, content), content, region))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self._open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("br", "p") and all(e[0] != tag for e in self._open):
            self._end_line()
            return
        for place in range(len(self._open) - 1, 0, -1):
            name = self._open[place][0]
            if name == tag:
                self._end_line()
                self._count += 1
                self._close_to(place)
                return
            # A closing tag never reaches beyond the container it stands in, unless it
            # closes a container itself.
            if name in _CONTAINERS and tag not in _CONTAINERS and tag not in _SILENT:
                break
        self._count += 1

    def handle_data(self, data):
        if self._open[-1][0] not in _OPAQUE:
            self._parts.append(data)

    def close(self):
        # A page that ends within a tag or comment ends with markup, not with text.
        if _MARKUP.match(self.rawdata):
            self.rawdata = ""
        super().close()
        self._end_line()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; at the ends the weights that fall
    outside are left out."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    pad = np.zeros(reach)
    both = np.convolve(np.r_[pad, ratios, pad], kernel, "valid")
    return both / np.convolve(np.r_[pad, np.ones(len(ratios)), pad], kernel, "valid")


def threshold(values: np.ndarray) -> float:
    """The border between two clusters of values: two means, moved until they stay."""
    low, high = float(values.min()), float(values.max())
    while True:
        border = (low + high) / 2
        upper = values > border
        if not upper.any() or upper.all():
            return low
        moved = float(values[~upper].mean()), float(values[upper].mean())
        if moved == (low, high):
            return border
        low, high = moved


def blocks_of(html: str | None, sigma: float = SIGMA) -> list[str]:
    """The blocks of a page's main text, in page order."""
    if not html:
        return []
    page = _Lines()
    page.feed(html)
    page.close()
    texts, silent = page.texts, np.array(page.silent, bool)
    if not texts:
        return []
    ratios = np.array([len(t) for t in texts], float) / np.maximum(np.array(page.tags), 1)
    # Lines around the article count as empty: a long notice must not lift its neighbours.
    heights = smoothed(np.where(silent, 0.0, ratios), sigma)
    regions = np.array(page.regions)
    spoken = np.array([bool(t) for t in texts]) & ~silent
    if not spoken.any():
        return []
    peak = np.zeros(int(regions.max()) + 1)
    np.maximum.at(peak, regions[spoken], heights[spoken])
    if any(r in page.named for r in regions[spoken].tolist()):
        content = np.isin(np.arange(len(peak)), list(page.named))
    else:
        content = peak >= min(threshold(heights), peak.max())
    return [t for t, s, r in zip(texts, spoken.tolist(), regions.tolist()) if s and content[r]]


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    return "\n\n".join(blocks_of(html, sigma))


def _extract(sigma: float):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "html"):
                texts = [main_text(h, sigma) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    return run


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sigma: float = SIGMA
) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per page; other columns are left out.

    Blocks are joined by an empty line, white space inside a block is one space, and
    character references are decoded. A null or empty page, and one with nothing but
    menus and the like, has empty text. Ids and addresses may be null or repeat. No page
    is shortened; a page is held whole by one task, pages about a megabyte at a time.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).alias("html"),
    )
    return rows.mapInArrow(_extract(sigma), "page_id long, url string, text string, n_chars long")
