"""Main text of HTML pages: parser events, text-to-tag ratio per line, smoothing, clustering.

The standard library's parser streams events. A *line* is the text of one block element; what
stands in elements that are no content by their kind (scripts, navigation, forms, adverts,
comments and so on) is marked as such. Each line has a ratio of its text's length to the tags
met since the line before. The ratios are smoothed by a Gaussian along the page, and lines above
a threshold form clusters (Weninger and Hsu, 2008). The content regions are the page's article
and main elements that hold text of a cluster, or, where clusters outside of them hold more, the
part of the body between the first and the last cluster; all of their unmarked lines are
returned, so short paragraphs between long ones stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.tables import map_arrow, text_or_empty

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s",
          "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "wbr"}
NO_CONTENT = {"head", "title", "script", "style", "noscript", "template", "nav", "menu", "footer",
              "aside", "form", "button", "select", "textarea", "iframe", "object", "svg", "canvas",
              "dialog", "audio", "video", "datalist", "fieldset"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
         "alertdialog", "alert", "menu", "menubar", "status", "toolbar", "tooltip"}
#: Words in a class or id that mark what is not the article.
MARKS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense",
         "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation",
         "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "masthead", "topbar",
         "toolbar", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay",
         "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing",
         "social", "related", "recommended", "recommendations", "comment", "comments",
         "commentlist", "disqus", "replies", "respond", "pagination", "pager", "widget", "legal",
         "copyright", "skip", "search", "tags", "hidden"}
#: Marks whose element stays shut even if an article element begins inside it.
SHUT = {"comment", "comments", "commentlist", "replies", "respond", "disqus", "related",
        "recommended", "recommendations"}
#: Before a mark these say that a wrapper has (or lacks) such a part, not that it is one.
ABOUT = {"has", "no", "not", "with", "without", "is"}
REGIONS = {"article", "main"}
#: A line's ratio counts up to this: one very long paragraph must not outweigh all others.
RATIO_MOST = 100.0
_NAME = re.compile(r"[^a-z0-9]+")


class _Lines(HTMLParser):
    """Collects (text, tags, region, content?) per block of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, tuple[int, ...]]] = []
        self.parts: list[str] = []
        self.tags = 0
        self.stack: list[str] = []        # open non-void elements
        #: Open no-content elements: depth, tag, shut, number (0: by its kind, not by a word).
        self.off: list[tuple[int, str, bool, int]] = []
        self.n_marks = 0
        self.regions: list[tuple[int, int]] = []  # depth and number of the open region
        self.n_regions = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.lines.append((text, self.tags, self.regions[-1][1] if self.regions else 0,
                               not self.off, tuple(n for *_, n in self.off)))
            self.tags = 0

    def _no_content(self, tag: str, attrs: list) -> str:
        """'' for content, 'shut' where not even an article inside is content, else 'open', or
        'named' where only a word in a class or id says so."""
        if tag in NO_CONTENT:
            return "shut"
        if tag in ("html", "body"):
            return ""
        if tag == "header" and "article" not in self.stack:
            return "open"  # a page's header; an article's own holds its headline
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return "shut"
            if name == "role" and value in ROLES:
                return "open"
            if name == "style" and "display:none" in value.replace(" ", ""):
                return "shut"
            if name in ("class", "id"):
                for one in value.split():
                    names = _NAME.split(one)
                    if ABOUT.intersection(names):
                        continue
                    if SHUT.intersection(names):
                        return "shut"
                    if MARKS.intersection(names) and tag not in REGIONS:
                        return "named"
        return ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag not in INLINE:
            self._flush()
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        if self.off and self.off[-1][1] == "p" and tag not in INLINE:
            self._close(self.off[-1][0])  # a paragraph ends where the next block begins
        skip = self._no_content(tag, attrs)
        if tag in REGIONS and not skip and self.off and not any(shut for _, _, shut, _ in self.off):
            self._close(self.off[0][0])  # no article sits inside an advert: it was left open
        depth = len(self.stack)
        self.stack.append(tag)
        if skip:
            self._flush()
            self.n_marks += skip == "named"
            self.off.append((depth, tag, skip == "shut",
                             self.n_marks if skip == "named" else 0))
        elif tag in REGIONS and not self.off and not self.regions:
            self.n_regions += 1
            self.regions.append((depth, self.n_regions))

    def _close(self, depth: int) -> None:
        """Close all elements from ``depth`` on."""
        if (self.off and depth <= self.off[-1][0]) or (
                self.regions and depth <= self.regions[-1][0]):
            self._flush()
        del self.stack[depth:]
        while self.off and self.off[-1][0] >= depth:
            self.off.pop()
        while self.regions and self.regions[-1][0] >= depth:
            self.regions.pop()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "br":  # browsers read </br> as <br>
            self._flush()
            return
        if tag not in INLINE:
            self._flush()
        if tag in VOID or tag not in self.stack:
            return
        depth = len(self.stack) - 1 - self.stack[::-1].index(tag)
        if self.off and depth < self.off[-1][0] and (tag in INLINE or tag == "p"):
            return  # a stray end tag inside a skipped element does not close it
        self._close(depth)

    def handle_data(self, data: str) -> None:
        self.parts.append(data)

    def page_lines(self, html: str) -> list[tuple[str, int, int, bool]]:
        """(text, tags, region, content?) of every line.

        On a page without text in an article or main element, a word in a class or id says
        nothing where the element holds most of the page's text.
        """
        self.feed(html)
        self.close()
        self._flush()
        inside = [0] * (self.n_marks + 1)
        whole = 0
        for text, _, _, _, marks in self.lines:
            if 0 not in marks:
                whole += len(text)
                for n in set(marks):
                    inside[n] += len(text)
        plain = not any(region and content for _, _, region, content, _ in self.lines)
        wrappers = {n for n, size in enumerate(inside) if n and plain and 2 * size > whole}
        return [(text, tags, region, wrappers.issuperset(marks))
                for text, tags, region, _, marks in self.lines]


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing with the kernel renormalised at both ends of the page."""
    radius = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[radius:radius + len(ratios)]
    return np.convolve(ratios, kernel, "full")[radius:radius + len(ratios)] / weight


def main_text(html: str) -> str:
    """The main text of a page: its content lines, each with single spaces, joined by a space."""
    lines = _Lines().page_lines(html)
    if not any(content for *_, content in lines):
        return ""
    ratio = np.array([min(RATIO_MOST, len(text) / max(1, tags)) if content else 0.0
                      for text, tags, _, content in lines])
    smooth = smoothed(ratio)
    inside = smooth >= min(smooth.std(), smooth.max())
    weight: dict[int, int] = {}
    for (text, _, region, content), core in zip(lines, inside):
        if content:
            weight[region] = weight.get(region, 0) + (len(text) if core else 0)
    best = max(weight, key=lambda r: (weight[r], -r))
    if best:  # article or main elements with text in a cluster (one nested in another is it)
        chosen = [t for t, _, region, content in lines if content and region and
                  (weight[region] or not weight[best])]
    else:
        own = [i for i, (_, _, region, content) in enumerate(lines) if content and not region]
        core = [i for i in own if inside[i]]
        chosen = [lines[i][0] for i in own if core and core[0] <= i <= core[-1]]
    return " ".join(chosen)


def extract(pages: DataFrame, columns: list[str], html_col: str = "html",
            text_col: str = "text") -> DataFrame:
    """``columns`` of every page and its main ``text`` (empty if there is none).

    Null pages count as empty; damaged markup is read as far as the parser understands it.
    Working columns are kept apart from ``columns``, so names are free except ``text_col``.
    """
    if text_col in columns:
        raise ValueError(f"{text_col} names an input column; give another text_col")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
                        text_or_empty(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())],
                                             ["row", "text"])

    kind = rows.schema["row"].dataType.simpleString()
    out = map_arrow(rows, run, f"row {kind}, text string")
    return out.select(*[F.col("row").getField(c).alias(c) for c in columns],
                      F.col("text").alias(text_col))
