"""Text of pages: a chain of built-in replacements, and main content by text density."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.arrow import map_rows

#: Seconds a page may take, as in the reference's settings; slower ones are dropped like pages without content.
TIMEOUT_SECONDS = 10.0
_SLICE = 1 << 16
_DROPPED = ("script", "style", "head", "nav", "footer", "aside", "form", "noscript")
_BLOCKS = "p|div|h[1-6]|li|tr|ul|ol|table|article|section|main|blockquote"
#: (pattern, replacement) in order. Each dropped element ends at its own closing tag, and a tag's name ends where it does.
CHAIN = [
    ("(?is)<!--.*?-->", " "),
    *[(f"(?is)<{t}(?:\\s[^>]*)?>.*?</{t}\\s*>", " ") for t in _DROPPED],
    (f"(?is)</?(?:{_BLOCKS}|br)(?:[\\s/][^>]*)?>", "\n"),
    ("(?s)<[^>]*>", ""),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", "\""),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("[ \t\r\f]+", " "),
    (" ?\n[ \n]*", "\n"),
]


def plain_text(html: Column) -> Column:
    """Text without markup, block elements on own lines; null for null, empty where nothing is left."""
    for pattern, to in CHAIN:
        html = F.regexp_replace(html, pattern, to)
    return F.trim(F.regexp_replace(html, "^\n+|\n+$", ""))


class _Blocks(HTMLParser):
    SKIP = frozenset("script style head nav footer aside form noscript button select".split())
    BLOCK = frozenset("p div br h1 h2 h3 h4 h5 h6 li tr td ul ol table article section main blockquote pre body html".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[list[Any]] = [["", 0]]
        self.skip: list[str] = []
        self.link = 0

    def handle_starttag(self, tag: str, attrs: Any) -> None:
        if tag in self.SKIP:
            self.skip.append(tag)
        elif tag == "a":
            self.link += 1
        elif tag in self.BLOCK:
            self.blocks.append(["", 0])
            self.link = 0

    def handle_endtag(self, tag: str) -> None:
        if tag in self.skip:
            del self.skip[self.skip.index(tag) :]
        elif tag == "a":
            self.link = max(0, self.link - 1)
        elif tag in self.BLOCK:
            self.blocks.append(["", 0])
            self.link = 0

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.blocks[-1][0] += data
            if self.link:
                self.blocks[-1][1] += len(data.strip())


def main_text(html: str | None, most_links: float = 0.33, least_words: int = 4, timeout: float = TIMEOUT_SECONDS) -> str | None:
    """Blocks with few linked characters and some words, one a line; None if nothing is left or the time is over (the page is dropped).

    The page is read in slices, whatever its length, and the clock is looked at between them."""
    if not html:
        return None
    parser, end = _Blocks(), time.monotonic() + timeout
    for i in range(0, len(html), _SLICE):
        parser.feed(html[i : i + _SLICE])
        if time.monotonic() > end:
            return None
    parser.close()
    out = []
    for text, linked in parser.blocks:
        t = re.sub(r"\s+", " ", text).strip()
        if t and linked <= most_links * len(t) and len(t.split()) >= least_words:
            out.append(t)
    return "\n".join(out) or None


def density(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, text) of pages with main content."""

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], htmls: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, html in zip(ids, htmls, strict=True):
                text = main_text(html)
                if text:
                    yield i, text

        return f

    return map_rows(pages, [key, "html"], f"{key} bigint, text string", make)
