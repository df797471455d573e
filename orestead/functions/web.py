"""HTML to text, links and items, for mapInPandas and Arrow UDFs; the rest of a page's operators are Columns."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCKS = frozenset("p div br li ul ol tr table section article header footer h1 h2 h3 h4 h5 h6 td th dt dd nav main aside".split())
SILENT = frozenset(("script", "style", "noscript", "template"))


class _Text(HTMLParser):
    """Visible text by line; cells of a row are joined by a bar, inline elements don't break lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.silent = 0
        self.links: list[tuple[str, str]] = []
        self.href: str | None = None
        self.label: list[str] = []
        self.rows: list[list[str]] = []
        self.in_cell = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            self.silent += 1
        elif tag == "tr":
            self.rows.append([])
            self.out.append("\n")
        elif tag in ("td", "th"):
            if self.rows:
                if self.rows[-1]:
                    self.out.append(" | ")
                self.rows[-1].append("")
                self.in_cell = True
        elif tag in BLOCKS:
            self.out.append("\n")
        if tag == "a":
            self.href, self.label = dict(attrs).get("href"), []

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in ("td", "th"):
            self.in_cell = False
        elif tag in BLOCKS:
            self.out.append("\n")
        if tag == "a" and self.href is not None:
            self.links.append((" ".join("".join(self.label).split()), self.href))
            self.href = None

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        self.out.append(data)
        if self.href is not None:
            self.label.append(data)
        if self.in_cell and self.rows and self.rows[-1]:
            self.rows[-1][-1] += data


def _parsed(html: str | None) -> _Text:
    p = _Text()
    p.feed(html or "")
    p.close()
    return p


def html_to_text(html: str | None) -> str:
    lines = (re.sub(r"[ \t\xa0 ]+", " ", x).strip() for x in "".join(_parsed(html).out).split("\n"))
    return "\n".join(x for x in lines if x)


def page_links(html: str | None) -> list[tuple[str, str]]:
    """(label, href) of each link; links without an href are left out."""
    return [(label, href) for label, href in _parsed(html).links if href]


def table_rows(html: str | None) -> list[list[str]]:
    return [[" ".join(c.split()) for c in row] for row in _parsed(html).rows if row]


def robots_regex(pattern: Column) -> Column:
    """A robots.txt pattern as a regular expression: * is anything, a final $ is the end, the rest is literal."""
    literal = F.regexp_replace(pattern, r"([.+?^(){}|\[\]\\])", r"\\$1")
    anything = F.replace(literal, F.lit("*"), F.lit(".*"))
    return F.concat(F.lit("^"), F.when(anything.endswith("$"), anything).otherwise(F.replace(anything, F.lit("$"), F.lit("\\$"))))


def title(html: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def looks_like_html(c: Column) -> Column:
    """A tag in the first 2000 characters."""
    return F.coalesce(F.substring(F.lower(c), 1, 2000).rlike("<html|<!doctype|<body|<div"), F.lit(False))
