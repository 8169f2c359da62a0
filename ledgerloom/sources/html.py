"""Links, tables and texts of HTML pages, with the standard library's parser, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import DataFrame

from .. import constants as C


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links: list[list[str]] = []
        self._open: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            href = dict(attrs).get("href")
            self._open = [href, ""] if href is not None else None
            if self._open is not None:
                self.links.append(self._open)

    def handle_endtag(self, tag):
        if tag == "a":
            self._open = None

    def handle_data(self, data):
        if self._open is not None:
            self._open[1] += data


def contact_urls(html: str | None, base_url: str, words=tuple(C.CONTACT_WORDS), stopwords=tuple(C.CONTACT_STOPWORDS), most: int = C.MAX_CONTACT_LINKS) -> list[str]:
    """Absolute links of a page to contact pages on the same host, in order, without repeats, at most ``most``."""
    parser = _Links()
    parser.feed(html or "")
    host, out = urlparse(base_url).netloc, []
    for href, text in parser.links:
        low, label = href.lower(), text.lower()
        if any(s in low for s in stopwords) or not any(w in low or w in label for w in words):
            continue
        try:
            full = urljoin(base_url, href)
            if urlparse(full).netloc == host and full not in out:
                out.append(full)
        except ValueError:
            continue
        if len(out) >= most:
            break
    return out


def contact_links(pages: DataFrame, words=tuple(C.CONTACT_WORDS), stopwords=tuple(C.CONTACT_STOPWORDS), most: int = C.MAX_CONTACT_LINKS) -> DataFrame:
    """(url, position, link) of the contact links of each page; NULL pages have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(u, k, link) for u, h in zip(pdf["url"], pdf["html"], strict=True) if u for k, link in enumerate(contact_urls(h, u, words, stopwords, most), 1)]
            yield pd.DataFrame(rows, columns=["url", "position", "link"])

    return pages.select("url", "html").mapInPandas(run, "url string, position int, link string")


class _Table(HTMLParser):
    def __init__(self, wanted: str):
        super().__init__(convert_charrefs=True)
        self.wanted, self.depth, self.body, self.rows, self.cell = wanted, 0, False, [], None
        self.found = False

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            inside = self.wanted in (dict(attrs).get("class") or "").split()
            self.found |= inside
            self.depth += 1 if inside or self.depth else 0
        elif self.depth and tag == "tbody":
            self.body = True
        elif self.depth and self.body and tag == "tr":
            self.rows.append([])
        elif self.depth and self.body and tag == "td" and self.rows:
            self.cell = ""

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
            self.body = self.body and self.depth > 0
        elif tag == "td" and self.cell is not None:
            self.rows[-1].append(self.cell.strip())
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell += data


def table_rows(pages: DataFrame, columns: list[str], css_class: str = "table_list", first_cell: int = 1, least_cells: int = 4) -> DataFrame:
    """The rows of a listing crawled page by page: page, row_no and the cells from ``first_cell`` on as ``columns``.

    Input: page INT, html. Rows with fewer cells than ``least_cells`` are
    headings. A first page without the table raises: the site has changed.
    """
    fields = ["page", "row_no", *columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, html in zip(pdf["page"], pdf["html"], strict=True):
                parser = _Table(css_class)
                parser.feed(html or "")
                if page == 1 and not parser.found:
                    raise ValueError(f"page 1 has no table of class {css_class!r}")
                for k, cells in enumerate((r for r in parser.rows if len(r) >= least_cells), 1):
                    part = cells[first_cell : first_cell + len(columns)]
                    rows.append((page, k, *part, *[""] * (len(columns) - len(part))))
            yield pd.DataFrame(rows, columns=fields)

    return pages.select("page", "html").mapInPandas(run, "page int, row_no int, " + ", ".join(f"`{c}` string" for c in columns))
