"""Tables salvaged from text lines, as they are left in damaged documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import header_target, strip
from ..plans.staging import staged
from ..schema import ALIAS_TO_TARGET

# Delimiters in order of preference.
_DELIMITERS = (";", "\t", ",")


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text files with their source and order; files split."""
    order = F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("_src_path"), order.alias("_row_ord"), "value"
    )


def _fields(line: Column, delimiter: Column) -> Column:
    return F.transform(F.split(line, F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E"))), strip)


def _may_be_header(line: Column) -> Column:
    """Cheap first test: a known column name is somewhere in the letters of the line."""
    letters = F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", "")
    return letters.rlike("|".join(sorted(ALIAS_TO_TARGET)))


def _header_delimiter(line: Column) -> Column:
    """Delimiter under which the line is a header: two fields or more, one of them known."""
    choice = None
    for d in _DELIMITERS:
        fields = _fields(line, F.lit(d))
        fits = (F.size(fields) >= 2) & F.exists(fields, lambda f: header_target(f).isNotNull())
        fits = F.contains(line, F.lit(d)) & fits
        choice = F.when(fits, d) if choice is None else choice.when(fits, d)
    some = F.lit(False)
    for d in _DELIMITERS:
        some = some | F.contains(line, F.lit(d))
    return F.when(some & _may_be_header(line), choice)


def _decoded(value: Column, utf8: Column) -> Column:
    return F.when(utf8, value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))


def _headers(lines: DataFrame) -> DataFrame:
    """One row per source: its first line's place and, null without a header, place, delimiter and cells of the header.

    A pre-aggregated minimum, written once: behind it all readers know how small it is.
    """
    rows = lines.select("_src_path", "_row_ord", F.is_valid_utf8("value").alias("_utf8"), strip(F.col("value")).alias("_line"))
    first = F.struct("_row_ord", F.col("_line").alias("line"), _header_delimiter(F.col("_line")).alias("d"))
    found = rows.groupBy("_src_path").agg(
        F.min("_row_ord").alias("_first"),
        F.min(F.when(first["d"].isNotNull(), first)).alias("h"),
        F.bool_and("_utf8").alias("_all_utf8"),
    )
    headers = found.select(
        "_src_path",
        "_first",
        F.col("h._row_ord").alias("_at"),
        F.col("h.d").alias("_delimiter"),
        _fields(F.col("h.line"), F.col("h.d")).alias("header"),
        "_all_utf8",
    )
    return staged(headers.withColumn("_targets", F.transform("header", header_target)), "headers")


def _table_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines behind the header of their source that hold its delimiter, cut into cells.

    The written headers, a row per source, are broadcast by their size, so lines of few large
    sources stay where they are read; only headers beyond that size shuffle both sides.
    """
    known = headers.where("_delimiter IS NOT NULL").drop("_first")
    joined = lines.join(known, "_src_path").where(F.col("_row_ord") > F.col("_at"))
    text = strip(_decoded(F.col("value"), F.col("_all_utf8")))
    # The delimiter is a cheap first test on lines that are no table rows.
    kept = joined.where(F.contains(F.col("value"), F.col("_delimiter")))
    return kept.withColumn("cells", _fields(text, F.col("_delimiter")))


def salvage(lines: DataFrame) -> DataFrame:
    """Table rows of each source (`_src_path`, `_row_ord`, `value`) in the cell shape.

    The header is the first line with a known column name; later lines with as many
    fields are data, the others are in `salvage_rejects`. Text that is not UTF-8 is read
    as Latin-1, per source. All rows are marked degraded; `_targets` are the raw columns
    of the header.
    """
    kept = _table_lines(lines, _headers(lines)).where(F.size("cells") == F.size("header"))
    none = F.lit(None).cast("string")
    return kept.select(
        "_src_path",
        none.alias("_src_tz"),
        F.lit(True).alias("_src_degraded"),
        "_row_ord",
        "header",
        "cells",
        F.transform("cells", lambda _: none).alias("links"),
        "_targets",
    )


def salvage_rejects(lines: DataFrame) -> DataFrame:
    """Table lines that the salvage leaves out, and sources without a header, with the reason."""
    headers = _headers(lines)
    odd = _table_lines(lines, headers).where(F.size("cells") != F.size("header"))
    counts = F.format_string("%d fields, header has %d", F.size("cells"), F.size("header"))
    headless = headers.where("_delimiter IS NULL").select("_src_path", F.col("_first").alias("_row_ord"), F.lit("no header").alias("reason"))
    return odd.select("_src_path", "_row_ord", counts.alias("reason")).unionByName(headless)


def scan_text_tables(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return salvage(text_lines(spark, paths))


def drop_noise(cells: DataFrame, pattern: str) -> DataFrame:
    """Remove page headers and footers: rows with a cell that matches, and repeated header rows."""
    noisy = F.exists("cells", lambda c: F.coalesce(c.rlike(pattern), F.lit(False)))
    return cells.where(~noisy & (F.col("cells") != F.col("header")))
