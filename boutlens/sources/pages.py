"""Stored HTML pages as typed rows: cells of tables, labelled metadata, links. A small parser runs inside the tasks."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = "{key}, kind string, position int, header string, cell string, href string"


class _Cells(HTMLParser):
    """Collects (kind, position, header, text, href): list items, table cells under their header, headings, links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, int, str | None, str, str | None]] = []
        self.headers: list[str] = []
        self.open: list[tuple[str, list[str]]] = []
        self.href: str | None = None
        self.column = self.line = 0
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "table":
            self.headers = []
        elif tag == "tr":
            self.column, self.line = 0, self.line + 1
        if tag in ("td", "th", "li", "h1", "h2"):
            self.open.append((tag, []))
        if tag == "a":
            self.href = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        if self.open and self.open[-1][0] == tag:
            _, parts = self.open.pop()
            text = " ".join("".join(parts).split())
            if tag == "th":
                self.headers.append(text)
            elif tag == "td":
                header = self.headers[self.column] if self.column < len(self.headers) else None
                self.rows.append(("cell", self.line, header, text, self.href))
                self.column += 1
            else:
                self.rows.append(("item" if tag == "li" else "heading", len(self.rows), None, text, self.href))
            self.href = None

    def handle_data(self, data):
        if self.open and not self.skip:
            self.open[-1][1].append(data)


def extract_pages(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per heading, list item and table cell of every page; a null page has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, text in zip(batch[key], batch["html"]):
                parser = _Cells()
                parser.feed(text or "")
                parser.close()
                out += [(page, *row) for row in parser.rows]
            yield pd.DataFrame(out, columns=[key, "kind", "position", "header", "cell", "href"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, F.col(html).alias("html")).mapInPandas(run, ROWS.format(key=f"{key} {kind}"))
