"""Stored tables and files.

Tables are Parquet, partitioned by year and dataset_version where both apply. Replacing a
version overwrites its partitions only. Regions, reports, issues, rejects and reviews are
replaced in one step (`snapshots`): readers see the old rows or the new ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.times import offset_text
from ..schema import CANONICAL
from . import snapshots


def write_raw_csv(rows: DataFrame, path: str) -> None:
    """Sanitised input rows with a header."""
    cols = [c for c in rows.columns if not c.startswith("_")]
    rows.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _versioned(df: DataFrame, version: str, year: int | None) -> DataFrame:
    batch_year = F.year("start_time_utc") if year is None else F.lit(year)
    return df.withColumns({"year": batch_year.cast("int"), "dataset_version": F.lit(version)})


def write_normalized(flights: DataFrame, path: str, version: str, year: int | None = None) -> None:
    """All canonical columns, superseded rows included."""
    _replace(_versioned(flights.select(*CANONICAL), version, year), path, "year", "dataset_version")


def raw_payload(flights: DataFrame) -> DataFrame:
    """Staging rows: id, event date and the whole row as JSON, times as ISO text."""
    as_text = [
        F.replace(offset_text(F.col(c)), F.lit(" "), F.lit("T")).alias(c) if c.endswith("_utc") else F.col(c)
        for c in CANONICAL
    ]
    counted = flights.where(
        ~F.col("superseded") & F.col("flight_id").isNotNull() & F.col("start_time_utc").isNotNull()
    )
    return counted.select(
        F.col("flight_id").alias("flight_external_id"),
        F.to_date("start_time_utc").alias("event_date"),
        F.to_json(F.struct(*as_text), {"ignoreNullFields": "false"}).alias("payload"),
        F.year("start_time_utc").alias("year"),
        F.month("start_time_utc").alias("month"),
    )


def norm_rows(flights: DataFrame) -> DataFrame:
    """Normalised rows: uid, departure, arrival, duration with two decimals."""
    counted = flights.where(~F.col("superseded") & F.col("start_time_utc").isNotNull())
    start = F.col("start_time_utc")
    return counted.select(
        F.lit(None).cast("bigint").alias("region_id"),
        F.col("flight_id").alias("flight_uid"),
        start.alias("departure_time"),
        F.col("end_time_utc").alias("arrival_time"),
        F.col("duration_minutes").cast("decimal(10,2)").alias("duration_minutes"),
        F.year(start).alias("year"),
        F.month(start).alias("month"),
    )


def write_version(df: DataFrame, path: str, version: str, year: int | None = None) -> None:
    """Replace the rows of a version in a table of rows that carry their year."""
    rows = df if year is None else df.withColumn("year", F.lit(year))
    _replace(rows.withColumn("dataset_version", F.lit(version)), path, "year", "dataset_version")


def replace_version(df: DataFrame, path: str, version: str) -> int:
    """Replace the rows of a version in one step, also by none; returns how many they are."""
    return snapshots.publish(df.withColumn("dataset_version", F.lit(version)), path, version)


def read_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The rows of a version, or of all."""
    return snapshots.read(spark, path, version)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def lineage(counters: DataFrame, sources: DataFrame, artifacts: dict[str, str]) -> DataFrame:
    """One lineage document per source file: path, checksum, batch counts, artifacts.

    `counters` is one row.
    """
    counts = F.struct("raw", "normalized", "valid", "invalid", "duplicates")
    batch = counters.select(F.to_json(counts)).scalar()
    schema = "raw BIGINT, normalized BIGINT, valid BIGINT, invalid BIGINT, duplicates BIGINT"
    checksum = F.coalesce(F.col("checksum"), F.lit(""))
    document = F.struct(
        F.lit("1.0").alias("schema_version"),
        F.struct(F.col("path"), checksum.alias("checksum")).alias("source"),
        F.from_json(batch, schema).alias("counts"),
        F.struct(*[F.lit(v).alias(k) for k, v in artifacts.items()]).alias("artifacts"),
        F.lit(artifacts.get("lineage", "")).alias("uri"),
        checksum.alias("checksum"),
    )
    return sources.select(F.to_json(document).alias("value"))


def quality_json(report: DataFrame, summary: DataFrame, version: str) -> DataFrame:
    """The quality report of a version as one JSON document.

    `report` has a row per check, `summary` is one row; flight issues stay a table.
    """
    check = F.struct("check_name", "status", "summary", "details", "impacted_regions", "impacted_records")
    checks = report.agg(F.to_json(F.array_sort(F.collect_list(check)))).scalar()
    head = summary.withColumn("dataset_version", F.lit(version))
    parts = F.struct("dataset_version", "status", "quality_status", "warn_count", "fail_count")
    open_head = F.regexp_replace(F.to_json(parts), r"\}$", "")
    return head.select(F.concat(open_head, F.lit(',"checks":'), checks, F.lit("}")).alias("value"))


def violations_json(summary: DataFrame) -> DataFrame:
    """warn_count, fail_count, total, quality_status as one JSON document."""
    return summary.select(
        F.to_json(F.struct("warn_count", "fail_count", "total", "quality_status")).alias("value")
    )


def write_document(document: DataFrame, path: str) -> None:
    """One JSON text per row."""
    document.write.mode("overwrite").text(path)


def export(table: DataFrame, path: str, fmt: str = "csv") -> None:
    """A table as CSV or JSON lines, in as many files as it has partitions."""
    writer = table.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown export format {fmt}")


def refresh_regions(features: DataFrame, to_table: Callable[[DataFrame], DataFrame], path: str) -> int:
    """Replace the region table in one step; returns the number of input features, counted on the way.

    If reading or shaping the features fails, the old table stays.
    """
    seen = Observation()
    snapshots.publish(to_table(features.observe(seen, F.count(F.lit(1)).alias("features"))), path)
    return seen.get["features"]


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, path)
