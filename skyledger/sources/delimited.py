"""Delimited files with a header line."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import apart, blank_to_null
from ..schema import RAW_COLUMNS, header_name, target_of, unique_names
from .quoted import read_records


#: Different header lines that one load may mix.
MAX_HEADERS = 1000


def _looks(spark: SparkSession, paths: list[str]) -> dict[tuple[str, bool], list[str]]:
    """Files by header line and by whether a quoted cell holds a line break.

    One text scan; per file one row leaves the tasks: its first line, and whether some line
    has an odd number of quotes, which only a cell that goes on in the next line makes.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    )
    odd = F.length("value") - F.length(F.replace("value", F.lit('"')))
    files = lines.groupBy("path").agg(F.min_by("value", "at").alias("header"), F.bool_or(odd % 2 == 1).alias("broken"))
    out: dict[tuple[str, bool], list[str]] = {}
    # File names, as Spark's own file index holds them; one at a time.
    for r in files.orderBy("header", "broken", "path").toLocalIterator():
        out.setdefault((r.header, r.broken), []).append(r.path)
        if len(out) > MAX_HEADERS:
            raise ValueError(f"more than {MAX_HEADERS} different header lines")
    return out


def _cells(header_line: str) -> list[str]:
    return next(csv.reader([header_line.removeprefix("\ufeff")]), [])


def _read(spark: SparkSession, paths: list[str], header: list[str], verify: bool) -> DataFrame:
    """Rows of files with this header; `verify` makes Spark compare it with every file."""
    names = header if verify else [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    rows = reader.option("enforceSchema", not verify).schema(schema).csv(paths)
    place = F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    return _named(rows, rows.columns, header, *place)


def _read_broken(spark: SparkSession, paths: list[str], header: list[str]) -> DataFrame:
    """Rows of files with line breaks in cells: their blocks are joined to records, which are parsed like lines."""
    names = [f"c{i}" for i in range(len(header))]
    records = read_records(spark, paths).where((F.col("block") > 0) | (F.col("line") > 0))
    record = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    schema = ", ".join(f"{n} string" for n in names)
    cells = F.from_csv(record, schema, {"quote": '"', "escape": '"', "multiLine": "true"})
    rows = records.where(F.trim(record) != "").select("path", "block", "line", cells.alias("cells")).select("*", "cells.*")
    return _named(rows, names, header, F.col("path"), F.col("block"), F.col("line"))


def scan_delimited(
    spark: SparkSession, paths: str | list[str], mixed_headers: bool = False, line_breaks: bool = True
) -> DataFrame:
    """Rows of CSV files: all columns as text under snake_case names, plus source columns.

    A first text scan looks at headers and quotes. Files are then read in groups of equal
    header, in blocks; where quoted cells hold line breaks, blocks are joined to records first.
    With `mixed_headers` and `line_breaks` off that scan is left out: every file must have
    the header of the first one, which Spark verifies while it reads. The null tokens become null.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    first = spark.read.text(paths[0]).first()
    if first is None:
        raise ValueError(f"no lines in {paths[0]}")
    header = _cells(first.value)
    if not mixed_headers and not line_breaks and len({h.lower() for h in header}) == len(header):
        return _read(spark, paths, header, verify=True)
    looks = _looks(spark, paths)
    if not mixed_headers and len({h for h, _ in looks}) > 1:
        raise ValueError(f"files with different headers: {sorted(h for h, _ in looks)[:2]}")
    out = None
    for (line, broken), files in looks.items():
        part = _read_broken(spark, files, _cells(line)) if broken else _read(spark, files, _cells(line), verify=False)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _named(df: DataFrame, columns: list[str], header: list[str], path: Column, block: Column, line: Column) -> DataFrame:
    names = unique_names([header_name(h) for h in header])
    order = F.struct(path.alias("path"), block.alias("block"), line.alias("line"))
    cells = [blank_to_null(F.col(f"`{c.replace('`', '``')}`")).alias(n) for c, n in zip(columns, names)]
    return df.select(
        *cells,
        apart(path).alias("_src_path"),
        F.lit(None).cast("string").alias("_src_tz"),
        F.lit(False).alias("_src_degraded"),
        order.alias("_row_ord"),
    )


def to_raw_columns(df: DataFrame) -> DataFrame:
    """Rename known headers to the raw columns; the first filled of several sources counts.

    Unknown columns and the source columns (leading underscore) follow as they are.
    """
    sources: dict[str, list[str]] = {c: [] for c in RAW_COLUMNS}
    others = []
    for name in df.columns:
        target = None if name.startswith("_") else target_of(name)
        (sources[target] if target else others).append(name)
    cols = [
        (F.coalesce(*[F.col(f"`{n}`") for n in names]) if names else F.lit(None)).cast("string").alias(target)
        for target, names in sources.items()
    ]
    return df.select(*cols, *[F.col(f"`{n}`") for n in others])
