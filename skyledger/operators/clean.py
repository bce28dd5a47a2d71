"""Cleaning of scanned rows before normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import apart, decimal_point, header_target, strip, strip_cell
from ..plans.staging import staged
from ..schema import RAW_COLUMNS, RAW_NUMERIC, SERVICE_ROW_PREFIXES


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every text column."""
    texts = [c for c, t in df.dtypes if t == "string"]
    trimmed = {c: strip_cell(F.col(c)) for c in texts} | {c: apart(strip_cell(F.col(c))) for c in texts[:1]}
    return df.withColumns(trimmed) if texts else df


def decimal_points(df: DataFrame, all_strings: bool = False) -> DataFrame:
    """Decimal comma to point in the numeric raw columns, or in every text column."""
    texts = [c for c, t in df.dtypes if t == "string" and not c.startswith("_")]
    chosen = texts if all_strings else [c for c in RAW_NUMERIC if c in texts]
    return df.withColumns({c: decimal_point(F.col(c)) for c in chosen}) if chosen else df


def is_service_row(cells: Column) -> Column:
    """All cells blank, or a cell that starts like a page mark or a source note."""
    values = F.transform(F.array_compact(cells), lambda v: F.lower(strip(v)))

    def marked(v: Column) -> Column:
        hit = F.lit(False)
        for prefix in SERVICE_ROW_PREFIXES:
            hit = hit | F.startswith(v, F.lit(prefix))
        return hit

    # Cells are looked at one by one only where a prefix occurs somewhere in the row.
    row = F.array_join(cells, " ")
    some = F.lit(False)
    for prefix in SERVICE_ROW_PREFIXES:
        some = some | F.contains(F.lower(row), F.lit(prefix))
    return (strip(row) == "") | (some & F.exists(values, marked))


def _ranked(rows: DataFrame, limit: int) -> DataFrame:
    """The first `limit` rows of each source, with their `_rank`."""
    order = Window.partitionBy("_src_path").orderBy("_row_ord")
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit)


def drop_service_rows(df: DataFrame, cells: Column | None, limit: int = 10) -> DataFrame:
    """Drop the leading service rows of each source, at most `limit` of them.

    `cells` is the row as an array of text. Each task passes on `limit` rows per source,
    so the first rows are found without moving the rest, and only these are judged. The rows
    to drop are written before they are joined back: few, they are broadcast by their known
    size, so the others are not shuffled.

    Without `cells`, `df` is written and says in `_service` which rows are service rows. Then
    rows are ranked only up to the last service row that may be dropped, if a source has any.
    """
    if cells is None:
        places = df.select("_src_path", "_row_ord", "_service")
        ends = _ranked(places.where("_service"), limit).groupBy("_src_path").agg(F.max("_row_ord").alias("_end"))
        near = places.join(staged(ends, "service_ends"), "_src_path")
        first = _ranked(near.where(F.coalesce(F.col("_row_ord") <= F.col("_end"), F.lit(True))), limit)
        df, service = df.drop("_service"), F.col("_service").cast("int")
    else:
        first = _ranked(df.select("_src_path", "_row_ord", cells.alias("_cells")), limit)
        service = is_service_row(F.col("_cells")).cast("int")
    lead = Window.partitionBy("_src_path").orderBy("_rank")
    leading = first.withColumn("_service", service).withColumn("_all_service", F.min("_service").over(lead))
    dropped = staged(leading.where("_all_service = 1").select("_src_path", "_row_ord"), "service_rows")
    return df.join(dropped, ["_src_path", "_row_ord"], "left_anti")


def raw_cells(df: DataFrame) -> Column:
    """The columns of a named scan as one cell array."""
    return F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns if not c.startswith("_")])


def raw_from_cells(df: DataFrame) -> DataFrame:
    """Raw columns of rows in the cell shape.

    The header decides where each target column is; a short row gives null, of repeated
    headers the first filled one counts. A scan may bring the targets of its headers along
    in `_targets`. Unknown columns and links go to `extra`, a JSON list of column, value, link.
    """
    targets = F.transform("header", header_target)
    placed = df if "_targets" in df.columns else df.withColumn("_targets", targets)

    def cell(target: str) -> Column:
        at = F.transform("_targets", lambda t, i: F.when(t == target, F.get("cells", i)))
        return F.get(F.filter(at, lambda v: F.coalesce(strip(v), F.lit("")) != ""), F.lit(0))

    sources = [c for c in df.columns if c.startswith("_") and c != "_targets"]
    return placed.select(*[strip(cell(t)).alias(t) for t in RAW_COLUMNS], _others().alias("extra"), *sources)


def _others() -> Column:
    """Cells under unknown headers, and links of all cells, as JSON; null if there are none."""
    cells = F.transform(
        "cells",
        lambda value, i: F.struct(
            F.get("header", i).alias("column"),
            F.when(F.get("_targets", i).isNull(), F.nullif(strip(value), F.lit(""))).alias("value"),
            F.get("links", i).alias("link"),
        ),
    )
    some = F.filter(cells, lambda c: c["value"].isNotNull() | c["link"].isNotNull())
    return F.when(F.size(some) > 0, F.to_json(some))


def sanitize(df: DataFrame, limit: int = 10) -> DataFrame:
    """Rows of a named scan: trim, drop leading service rows, decimal points.

    Decimal points leave trimmed text trimmed and make no service row. The rows are written
    with the judgement of each, so the scan is read once.
    """
    trimmed = trim_strings(df)
    judged = decimal_points(trimmed.withColumn("_service", is_service_row(raw_cells(trimmed))))
    return drop_service_rows(staged(judged, "rows"), None, limit)


def sanitize_cells(df: DataFrame, limit: int = 10) -> DataFrame:
    """Rows in the cell shape: drop leading service rows, place cells, decimal points."""
    return decimal_points(raw_from_cells(drop_service_rows(df, F.col("cells"), limit)))


def concat_tables(*tables: DataFrame) -> DataFrame:
    """Tables of several pages below each other, columns matched by name."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out
