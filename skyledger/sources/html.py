"""HTML reports: the first table of each page, the page's time zone, links in cells."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CELLS_SCHEMA

_TABLE_ROWS = "key STRING, tz STRING, line LONG, header ARRAY<STRING>, cells ARRAY<STRING>, links ARRAY<STRING>"


_BATCH = 10_000


class _FirstTable(HTMLParser):
    """Rows of the first table with the section each belongs to, and the report-tz meta."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tz: str | None = None
        self.rows: list[tuple[str, list[str], list[str | None]]] = []
        self.seen = False
        self._depth = 0
        self._section = ""
        self._row: tuple[list[str], list[str | None]] | None = None
        self._text: list[str] | None = None
        self._href: str | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta" and a.get("name") == "report-tz" and a.get("content") and self.tz is None:
            self.tz = a["content"].strip()
        elif tag == "table" and (self._depth or not self.seen):
            self.seen = True
            self._depth += 1
        elif not self._depth:
            return
        elif tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            self._section = tag
        elif tag == "tr":
            self._end_row()
            self._row = ([], [])
        elif tag in ("td", "th") and self._row is not None:
            self._end_cell()
            self._text, self._href = [], None
        elif tag == "a" and self._text is not None and self._href is None:
            self._href = a.get("href")

    def handle_data(self, data):
        if self._text is not None and data.strip():
            self._text.append(data.strip())

    def handle_endtag(self, tag):
        if not self._depth:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            self._section = ""
        elif tag == "table":
            self._end_row()
            self._depth -= 1

    def _end_cell(self):
        if self._text is not None and self._row is not None:
            self._row[0].append("".join(self._text))
            self._row[1].append(self._href)
        self._text = None

    def _end_row(self):
        self._end_cell()
        if self._row is not None and self._row[0]:
            self.rows.append((self._section, *self._row))
        self._row = None


_SPACE = r"[ \t\n]"
_NAME = r"[A-Za-z_][\w:.-]*"
_VALUE = rf"""(?:"[^"]*"|'[^']*'|[^\s"'<>=`/&]+(?={_SPACE}|>))"""
#: Well-formed tags, declarations and comments, on which the parser has nothing to decide.
_TAG = re.compile(
    rf"<(?:(/?)([A-Za-z][A-Za-z0-9]*)((?:{_SPACE}+{_NAME}(?:={_VALUE})?)*){_SPACE}*(/?)>|!(?:(?i:doctype) [\w ]+|--[\w :.,]*--)>)", re.ASCII
)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:=({_VALUE}))?", re.ASCII)
#: Elements whose content is not markup.
_RAW = frozenset("script style textarea title iframe noembed noframes noscript plaintext xmp svg math".split())
#: Elements that the handlers look at.
_HANDLED = frozenset("meta table thead tbody tfoot tr td th a".split())


def _simple_tags(html: str) -> list[re.Match] | None:
    """All tags of a page, None if the parser has to look at some of them."""
    tags = list(_TAG.finditer(html))
    if len(tags) != html.count("<") or (tags and "&" in html[tags[-1].end() :]):
        return None
    for tag in tags:
        closing, name, attributes, ended = tag.groups()
        if name and (name.lower() in _RAW or (attributes and (closing or "&" in attributes)) or (closing and ended)):
            return None
    return tags


def _attributes(text: str) -> list[tuple[str, str | None]]:
    pairs = ((m.group(1).lower(), m.group(2)) for m in _ATTRIBUTE.finditer(f"{text}>"))
    return [(k, v[1:-1] if v and v[0] in "\"'" else v) for k, v in pairs]


def _feed(page: _FirstTable, html: str) -> None:
    """Hands a page to the handlers; pages of simple tags are cut by one pattern, several times faster than parsed."""
    tags = _simple_tags(html)
    if tags is None:
        page.feed(html)
        page.close()
        return
    at = 0
    for tag in tags:
        if page._text is not None and tag.start() > at:
            page.handle_data(unescape(html[at : tag.start()]))
        at = tag.end()
        closing, name, attributes, ended = tag.groups()
        name = name and name.lower()
        if name not in _HANDLED:
            continue
        if not closing:
            page.handle_starttag(name, _attributes(attributes) if attributes and name in ("meta", "a") else [])
        if closing or ended:
            page.handle_endtag(name)
    if page._text is not None and at < len(html):
        page.handle_data(html[at:])


def first_table(html: str) -> tuple[str | None, bool, list[str], list[tuple[list[str], list[str | None]]]]:
    """(time zone, table found, header cells, data rows with links) of one page.

    With a thead its last row is the header and only tbody rows are data; without one
    the first row that has cells is the header.
    """
    page = _FirstTable()
    _feed(page, html)
    page._end_row()
    head = [cells for section, cells, _ in page.rows if section == "thead"]
    if head:
        return page.tz, page.seen, head[-1], [(c, l) for s, c, l in page.rows if s == "tbody"]
    rows = [(c, l) for _, c, l in page.rows]
    return page.tz, page.seen, rows[0][0] if rows else [], rows[1:]


_ROWS = pa.schema(
    [("key", pa.string()), ("tz", pa.string()), ("line", pa.int64()), *((n, pa.list_(pa.string())) for n in ("header", "cells", "links"))]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROWS, strict=True)], schema=_ROWS)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for batch in batches:
        for key, html in zip(batch.column("key").to_pylist(), batch.column("html").to_pylist(), strict=True):
            tz, _, header, data = first_table(html or "")
            for line, (cells, links) in enumerate(data):
                rows.append((key, tz, line, header, cells, links))
                if len(rows) == _BATCH:
                    yield _batch(rows)
                    rows = []
    if rows:
        yield _batch(rows)


def table_rows(pages: DataFrame) -> DataFrame:
    """Table rows of pages (key, html) in the cell shape.

    A page without a table gives no row, which `quality.source_review` fails.
    """
    parsed = pages.select(F.col("key").cast("string").alias("key"), "html").mapInArrow(_parse, _TABLE_ROWS)
    return parsed.select(
        F.col("key").alias("_src_path"),
        F.col("tz").alias("_src_tz"),
        F.lit(False).alias("_src_degraded"),
        F.struct(F.col("key").alias("path"), F.lit(0).cast("long").alias("block"), "line").alias("_row_ord"),
        "header",
        "cells",
        "links",
    ).to(CELLS_SCHEMA)


def scan_html(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Table rows of HTML files."""
    pages = spark.read.text(paths, wholetext=True)
    return table_rows(pages.select(F.col("_metadata.file_path").alias("key"), F.col("value").alias("html")))


def page_meta(pages: DataFrame, name: str = "report-tz") -> DataFrame:
    """Content of the named meta tag per page (key, html), null if the page has none."""
    tag = F.regexp_extract("html", rf"""(?is)<meta\b[^>]*\bname\s*=\s*["']?{name}["'\s/>][^>]*>""", 0)
    content = F.regexp_extract(tag, r"""(?is)\bcontent\s*=\s*["']([^"']*)["']""", 1)
    return pages.select("key", F.nullif(F.trim(content), F.lit("")).alias("content"))


def cell_links(cells: DataFrame) -> DataFrame:
    """Hyperlinks kept as rows: source, row, header of the column, target."""
    pairs = cells.select("_src_path", "_row_ord", "header", F.posexplode("links").alias("pos", "href"))
    return pairs.where("href IS NOT NULL").select(
        "_src_path", "_row_ord", F.get("header", F.col("pos")).alias("column_name"), "href"
    )
