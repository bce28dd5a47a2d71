"""The end-to-end jobs: ingest, validate, aggregate, locate, explain, load regions."""

from __future__ import annotations

import functools
import hashlib
import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates, geo, insights, quality, sinks, versions
from ..operators.normalize import (
    infer_year,
    is_valid,
    metric_exclusions,
    metric_rows,
    normalize_typed,
    type_rows,
    typed_counters,
    typed_rejected,
    written_repeated_keys,
)
from ..sources.canonical import read_flights
from ..sources.regions import read_features, region_table
from ..sources.registry import checksums, list_files, load_flights
from .staging import staged, temporary


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _batch_checksum(sums: DataFrame) -> str:
    """The checksum of the file; of several files, of their sorted checksums."""
    digest = hashlib.sha256()
    first, n = "", 0
    # One at a time, in order.
    for n, row in enumerate(sums.select("checksum").orderBy("checksum").toLocalIterator(), 1):
        first = first or row.checksum
        digest.update(row.checksum.encode())
    return first if n == 1 else digest.hexdigest()


def _tidy(job):
    """Scratch tables of a job go when it ends; a dry run returns plans on them, so it keeps them."""

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        if kwargs.get("dry_run"):
            return job(spark, *args, **kwargs)
        with temporary(spark):
            return job(spark, *args, **kwargs)

    return run


def _event(spark: SparkSession, root: str, name: str, version: str, **payload) -> None:
    """One row of the log of finished stages."""
    row = spark.range(1).select(
        F.lit(name).alias("event"),
        F.lit(version).alias("version"),
        F.lit(json.dumps(payload, sort_keys=True)).alias("payload"),
        F.uuid().alias("trace_id"),
        F.lit(_now()).cast("timestamp_ntz").alias("emitted_at"),
    )
    sinks.append(row, f"{root}/events_log")


@_tidy
def ingest(
    spark: SparkSession,
    paths: str | list[str],
    root: str,
    version: str,
    year: int | None = None,
    hint: str | None = None,
    default_tz: str = "UTC",
    dry_run: bool = False,
    noise: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load, normalise and store a batch; returns (flights, one row of counters).

    The loaded rows are written first: their order comes from the scan, and everything
    after it reads them more than once. So are the typed rows, which are parsed once.
    """
    raw = load_flights(spark, paths, hint, noise, write=True)
    typed = staged(type_rows(raw, default_tz=default_tz), "typed")
    repeated = written_repeated_keys(typed.where(is_valid()))
    flights = normalize_typed(typed, repeated)
    counters = typed_counters(typed, repeated)
    if dry_run:
        return flights, counters
    flights = staged(flights, "flights")
    batch_year = year or infer_year(flights)
    if batch_year is None:
        raise ValueError("no year given, and none to infer from the flights")
    log = f"{root}/dataset_version"
    uri = paths if isinstance(paths, str) else ",".join(paths)
    sinks.append(versions.status_row(spark, version, _now(), "new", year=batch_year, source_uri=uri), log)
    tables = {name: f"{root}/{name}" for name in ("flights", "flights_raw", "flights_norm", "flights_rejected")}
    sinks.write_version(sinks.raw_payload(flights).drop("year"), tables["flights_raw"], version, batch_year)
    sinks.write_version(sinks.norm_rows(flights).drop("year"), tables["flights_norm"], version, batch_year)
    artifacts = {
        "raw": f"{root}/artifacts/{batch_year}/{version}/raw.csv",
        "normalized": tables["flights"],
        "lineage": f"{root}/artifacts/{batch_year}/{version}/lineage.json",
    }
    sinks.write_raw_csv(raw, artifacts["raw"])
    sinks.write_normalized(flights, tables["flights"], version, batch_year)
    sinks.replace_version(typed_rejected(typed), tables["flights_rejected"], version)
    review = quality.loaded_review(raw, list_files(spark, paths))
    sinks.replace_version(review, f"{root}/source_review", version)
    sinks.replace_version(metric_exclusions(flights), f"{root}/metric_exclusions", version)
    sums = staged(checksums(spark, paths), "checksums")
    row = counters.first()
    counted = spark.createDataFrame([row], counters.schema)
    sinks.write_document(sinks.lineage(counted, sums, artifacts), artifacts["lineage"])
    checksum = _batch_checksum(sums)
    sinks.append(
        versions.status_row(
            spark, version, _now(), "ingested", checksum=checksum, artifacts=json.dumps(artifacts)
        ),
        log,
    )
    _event(spark, root, "dataset.ingested", version, records=row.normalized, rejected=row.invalid)
    return read_flights(spark, tables["flights"], version), counted


@_tidy
def validate(
    spark: SparkSession,
    root: str,
    version: str,
    checks: list[quality.Check] | None = None,
    include_superseded: bool = False,
    dry_run: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Check a stored version; returns (report, one-row summary) and stores both with the issues."""
    flights = quality.counted_flights(read_flights(spark, f"{root}/flights", version), include_superseded)
    checks = quality.default_checks() if checks is None else list(checks)
    results = staged(quality.check_results(flights, checks), "check_results")
    found = staged(quality.violations(flights, checks), "violations")
    review = sinks.read_version(spark, f"{root}/source_review", version)
    report = quality.report_of(results, found).unionByName(quality.sources_outcome(review))
    report = staged(report, "quality_report")
    summary = quality.overall(report)
    if dry_run:
        return report, summary
    log = spark.read.parquet(f"{root}/dataset_version")
    versions.require_version(log, version)
    sinks.replace_version(report, f"{root}/quality_report", version)
    sinks.replace_version(quality.issues_of(results, found), f"{root}/flight_quality_issues", version)
    base = f"{root}/artifacts/quality/{version}"
    sinks.write_document(sinks.quality_json(report, summary, version), f"{base}/report.json")
    sinks.write_document(sinks.violations_json(summary), f"{base}/quality_violations.json")
    row = summary.first()
    done = versions.status_row(
        spark, version, _now(), row.quality_status, warn_count=row.warn_count, fail_count=row.fail_count
    )
    sinks.append(done, f"{root}/dataset_version")
    _event(spark, root, "dataset.validated", version, status=row.quality_status)
    return sinks.read_version(spark, f"{root}/quality_report", version), spark.createDataFrame([row], summary.schema)


def build_aggregates(spark: SparkSession, root: str, version: str, year: int | None = None) -> DataFrame:
    """Yearly and monthly aggregates of a stored version; returns the yearly ones."""
    metrics = metric_rows(read_flights(spark, f"{root}/flights", version), year)
    years = aggregates.aggregates_year(metrics)
    sinks.write_version(years, f"{root}/aggregates_year", version)
    sinks.write_version(aggregates.aggregates_month(metrics), f"{root}/aggregates_month", version)
    _event(spark, root, "aggregates.built", version)
    return years


@_tidy
def build_geo(spark: SparkSession, root: str, version: str, degrees: float = 1.0) -> DataFrame:
    """The geo table of a stored version, from the stored region directory."""
    flights = quality.counted_flights(read_flights(spark, f"{root}/flights", version))
    cells = staged(geo.region_cells(sinks.read_regions(spark, f"{root}/regions"), degrees), "cells")
    table = geo.flights_geo(geo.assign_regions(flights, cells, degrees), version)
    sinks.write_version(table.drop("dataset_version"), f"{root}/flights_geo", version)
    return spark.read.parquet(f"{root}/flights_geo").where(F.col("dataset_version") == version)


def build_insights(spark: SparkSession, root: str, version: str) -> DataFrame:
    """Sentences about the stored aggregates of a version."""

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}").where(F.col("dataset_version") == version).drop("dataset_version")

    months = stored("aggregates_month").drop("vehicle_category")
    facts = insights.region_facts(stored("aggregates_year"), aggregates.peak_month(months))
    table = insights.insights(facts)
    sinks.write_version(table, f"{root}/insights", version)
    _event(spark, root, "insights.ready", version)
    return table


def load_regions(spark: SparkSession, paths: str | list[str], root: str) -> int:
    """Replace the region directory by the features of GeoJSON files."""
    return sinks.refresh_regions(read_features(spark, paths), region_table, f"{root}/regions")
