"""Workbooks (.xlsx, .xlsm): the first sheet, every cell as text, dates as ISO text."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CELLS_SCHEMA

# XML name spaces of the workbook format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"

_ROWS = "key STRING, line LONG, header ARRAY<STRING>, cells ARRAY<STRING>"
_BATCH = 10_000


def _column_number(reference: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", reference).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _texts(element) -> str:
    """Text of an item and its runs; phonetic runs are no part of it."""
    parts = [element] + [r for r in element if r.tag == f"{_MAIN}r"]
    return "".join(t.text or "" for p in parts for t in p if t.tag == f"{_MAIN}t")


# Numbers of the built-in formats that show a date or a time.
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles that show a date or a time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.parse(book.open("xl/styles.xml")).getroot()
    dates = set(_DATE_FORMATS)
    for f in root.iter(f"{_MAIN}numFmt"):
        # Quoted text, colours and escaped letters say nothing about the kind.
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")).lower()
        if re.search("[ymdhs]", code) and "general" not in code:
            dates.add(int(f.get("numFmtId")))
    styles = root.find(f"{_MAIN}cellXfs")
    return {i for i, xf in enumerate(styles if styles is not None else []) if int(xf.get("numFmtId", "0")) in dates}


def serial_text(value: str, from_1904: bool) -> str:
    """A date serial as ISO text, a mere time of day as a time."""
    serial = float(value)
    if serial < 1 and not from_1904:
        return (datetime(1900, 1, 1) + timedelta(milliseconds=round(serial * 86_400_000))).isoformat(" ")[11:19]
    # Serial 60 is a day that never was; earlier ones count from a day later.
    start = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30 if serial >= 60 else 31)
    return (start + timedelta(milliseconds=round(serial * 86_400_000))).isoformat(" ", "milliseconds").removesuffix(".000")


def _cell_text(cell, shared: list[str], dates: set[int], from_1904: bool) -> str | None:
    value, kind = cell.find(f"{_MAIN}v"), cell.get("t", "n")
    if kind == "inlineStr":
        item = cell.find(f"{_MAIN}is")
        return _texts(item) if item is not None else None
    if value is None or value.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "true" if value.text == "1" else "false"
    if kind == "n" and int(cell.get("s", "0")) in dates:
        return serial_text(value.text, from_1904)
    return value.text


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = ElementTree.parse(book.open("xl/workbook.xml")).getroot().find(f"{_MAIN}sheets/{_MAIN}sheet")
    rels = ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()
    target = next(r.get("Target") for r in rels if r.get("Id") == sheet.get(f"{_REL}id"))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as text cells, read as a stream."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_texts(si) for si in ElementTree.parse(book.open("xl/sharedStrings.xml")).getroot()]
        dates = _date_styles(book)
        props = ElementTree.parse(book.open("xl/workbook.xml")).getroot().find(f"{_MAIN}workbookPr")
        from_1904 = props is not None and props.get("date1904") in ("1", "true")
        with book.open(_first_sheet(book)) as sheet:
            for _, element in ElementTree.iterparse(sheet):
                if element.tag != f"{_MAIN}row":
                    continue
                row: list[str | None] = []
                for cell in element:
                    at = _column_number(cell.get("r")) if cell.get("r") else len(row)
                    row += [None] * (at + 1 - len(row))
                    row[at] = _cell_text(cell, shared, dates, from_1904)
                yield row
                element.clear()


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for key, content in zip(batch["key"], batch["content"]):
            rows = sheet_rows(bytes(content))
            try:
                header = [c or "" for c in next(rows, [])]
            except (zipfile.BadZipFile, KeyError):
                continue  # no workbook of this kind: no row, which the source review fails
            line = 0
            while True:
                chunk = [r for _, r in zip(range(_BATCH), rows)]
                if not chunk:
                    break
                yield pd.DataFrame(
                    {
                        "key": key,
                        "line": range(line, line + len(chunk)),
                        "header": [header] * len(chunk),
                        "cells": chunk,
                    }
                )
                line += len(chunk)


def scan_workbooks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows of the first sheet of each workbook in the cell shape; a file that is none gives no row."""
    files = spark.read.format("binaryFile").load(paths)
    return workbook_rows(files.select(F.col("path").alias("key"), "content"))


def workbook_rows(books: DataFrame) -> DataFrame:
    """The same for workbooks as (key, content)."""
    parsed = books.select("key", "content").mapInPandas(_parse, _ROWS)
    none = F.lit(None).cast("string")
    return parsed.select(
        F.col("key").alias("_src_path"),
        none.alias("_src_tz"),
        F.lit(False).alias("_src_degraded"),
        F.struct(F.col("key").alias("path"), F.lit(0).cast("long").alias("block"), "line").alias("_row_ord"),
        "header",
        "cells",
        F.transform("cells", lambda _: none).alias("links"),
    ).to(CELLS_SCHEMA)
