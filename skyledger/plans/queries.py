"""The registered queries: every operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import header_key, header_target
from ..operators import aggregates as agg
from ..operators import clean, geo, insights, quality, sinks, versions
from ..operators.normalize import (
    batch_years,
    duration_mismatch,
    ingest_counters,
    metric_rows,
    normalize_typed,
    rejected,
    type_rows,
)
from ..sources import html, registry, textsalvage
from ..sources.regions import parse_features, region_table
from ..streaming import incremental, live
from . import adapters
from .staging import scratch_path, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CELL_DEGREES = 6.0
#: Files of a delivery, one batch of the stream.
DELIVERED_FILES = 4


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(f(spark, sf_dir))

    QUERIES[f.__name__] = run
    return f


def plain(df: DataFrame) -> DataFrame:
    """Source columns dropped, decimals as double, integers as bigint."""
    cols = []
    for name, kind in df.dtypes:
        if name.startswith("_"):
            continue
        if kind.startswith("decimal"):
            cols.append(F.col(name).cast("double").alias(name))
        elif kind in ("int", "smallint"):
            cols.append(F.col(name).cast("bigint").alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


# Shared inputs.


def flights(spark, d):
    """Normalised flights; the typed rows are written once, as two steps read them."""
    return normalize_typed(staged(type_rows(adapters.flight_reports(spark, d)), "typed"))


def stored_flights(spark, d):
    """Normalised flights as the following jobs get them: from a written table."""
    return staged(flights(spark, d), "flights")


def first_version(spark, d):
    """The reports before any re-issue."""
    return normalize_typed(staged(type_rows(adapters.flight_reports(spark, d).where("_row_ord.seq = 0")), "typed"))


def years(spark, d):
    return agg.aggregates_year(metric_rows(flights(spark, d)))


def months(spark, d, by_vehicle=False):
    return agg.aggregates_month(metric_rows(flights(spark, d)), by_vehicle)


def regions(spark, d):
    return region_table(parse_features(adapters.region_features(spark, d)))


def region_grid(spark, d):
    return staged(geo.region_cells(regions(spark, d), CELL_DEGREES), "cells")


def assigned(spark, d, cells=None):
    cells = region_grid(spark, d) if cells is None else cells
    counted = flights(spark, d).where(~F.col("superseded"))
    return geo.assign_regions(counted, cells, CELL_DEGREES)


# Ingest.


@query
def flights_by_region_year(spark, d):
    return years(spark, d)


@query
def normalize_flights(spark, d):
    return flights(spark, d)


@query
def ingest_counts(spark, d):
    return ingest_counters(adapters.flight_reports(spark, d))


@query
def rejected_rows(spark, d):
    rows = rejected(adapters.flight_reports(spark, d))
    return rows.select("flight_id", "start_time_utc", "end_time_utc", "latitude", "longitude", "reasons")


@query
def surrogate_ids(spark, d):
    rows = type_rows(adapters.flight_reports(spark, d)).where("surrogate_id IS NOT NULL")
    return rows.select("surrogate_id", "flight_id", "start_time_utc", "end_time_utc", "region_code", "region_name")


@query
def duration_differences(spark, d):
    rows = duration_mismatch(adapters.flight_reports(spark, d))
    return rows.select("flight_id", "start_time_utc", "end_time_utc", "given_minutes", "derived_minutes")


@query
def flight_years(spark, d):
    return batch_years(flights(spark, d))


@query
def header_canonical(spark, d):
    texts = adapters.header_texts(spark, d)
    return texts.select(
        "kind", "id", header_key(F.col("text")).alias("header"), header_target(F.col("text")).alias("target")
    )


@query
def service_rows_dropped(spark, d):
    kept = clean.drop_service_rows(adapters.service_cells(spark, d), F.col("cells"))
    return kept.select(F.col("_src_path").alias("source"), F.col("_row_ord").alias("row_no"))


@query
def text_table_salvage(spark, d):
    cells = textsalvage.salvage(adapters.damaged_lines(spark, d))
    return clean.raw_from_cells(cells).select(
        F.col("_src_path").alias("source"), "flight_id", "start_time", "end_time", "duration_minutes",
        F.col("_src_degraded").alias("degraded"),
    )


@query
def html_first_table(spark, d):
    rows = type_rows(clean.raw_from_cells(html.table_rows(adapters.report_pages(spark, d))))
    return rows.select("flight_id", "start_time_utc", "end_time_utc", "region_code")


@query
def html_links(spark, d):
    links = html.cell_links(html.table_rows(adapters.report_pages(spark, d)))
    return links.select(F.col("_src_path").alias("source"), "column_name", "href")


@query
def page_meta(spark, d):
    return html.page_meta(adapters.tagged_pages(spark, d))


@query
def classify_sources(spark, d):
    return registry.classify(adapters.source_files(spark, d))


@query
def flights_raw_payload(spark, d):
    return sinks.raw_payload(flights(spark, d))


@query
def flights_norm(spark, d):
    return sinks.norm_rows(flights(spark, d)).drop("region_id")


# Quality.


@query
def check_schema(spark, d):
    check = quality.SchemaCheck(required=("flight_id", "region_code"))
    return check.result(quality.counted_flights(flights(spark, d)))


@query
def check_duration_range(spark, d):
    found = quality.DurationRangeCheck().violations(quality.counted_flights(flights(spark, d)))
    return found.select("check_name", "flight_id", "start_time_utc", "duration_minutes")


@query
def check_coordinate_range(spark, d):
    found = quality.CoordinateRangeCheck().violations(type_rows(adapters.flight_reports(spark, d)))
    return found.select("check_name", "flight_id", "start_time_utc", "latitude", "longitude")


@query
def check_uniqueness(spark, d):
    found = quality.UniquenessCheck().violations(adapters.line_flights(spark, d))
    return found.select("check_name", "flight_id", "start_time_utc", "region_code", "duration_minutes")


@query
def check_monthly(spark, d):
    check = quality.MonthlyCompletenessCheck()
    return check.result(quality.counted_flights(flights(spark, d)))


@query
def check_outliers(spark, d):
    rows = quality.counted_flights(stored_flights(spark, d))
    found = quality.DurationOutlierCheck(width=0.25).violations(rows)
    return found.select("check_name", "flight_id", "start_time_utc", "duration_minutes")


@query
def quality_report(spark, d):
    report = quality.quality_report(adapters.line_flights(spark, d))
    return report.select(
        "check_name", "status", "summary", "violation_count",
        F.array_join("impacted_regions", ",").alias("impacted_regions"),
        "impacted_records",
    )


@query
def quality_status(spark, d):
    return quality.overall(quality.check_results(quality.counted_flights(stored_flights(spark, d))))


@query
def flight_issues(spark, d):
    issues = quality.flight_issues(quality.counted_flights(stored_flights(spark, d)))
    return issues.select("flight_uid", "check_name", "severity")


@query
def storage_key_audit(spark, d):
    return quality.storage_key_audit(adapters.line_flights(spark, d))


@query
def check_mixed_types(spark, d):
    return quality.mixed_type_columns(
        adapters.flight_reports(spark, d), ("duration_minutes", "latitude", "payload_type", "flight_id")
    )


@query
def source_review(spark, d):
    cells = textsalvage.salvage(adapters.damaged_lines(spark, d))
    return quality.source_review(cells)


@query
def check_region_geometry(spark, d):
    return geo.region_geometry_check(parse_features(adapters.region_features(spark, d)))


@query
def anomalies(spark, d):
    return quality.anomalies(type_rows(adapters.flight_reports(spark, d)), 1996)


@query
def flights_with_issues(spark, d):
    rows = quality.counted_flights(stored_flights(spark, d))
    found = versions.flights_with_issues(rows, quality.flight_issues(rows))
    return found.groupBy("region_code").agg(F.count("*").alias("flights"))


@query
def flights_without_issues(spark, d):
    rows = quality.counted_flights(stored_flights(spark, d))
    found = versions.flights_without_issues(rows, quality.flight_issues(rows))
    return found.groupBy("region_code").agg(F.count("*").alias("flights"))


# Regions.


@query
def region_directory(spark, d):
    return regions(spark, d).withColumn("edge_count", F.size("edges")).drop("edges")


@query
def geo_assign(spark, d):
    return assigned(spark, d).select("flight_id", "start_time_utc", "region_code", "geo_region")


@query
def geo_tiebreak(spark, d):
    rows = assigned(spark, d).where("geo_matches > 1")
    return rows.select("flight_id", "longitude", "latitude", "geo_region", "geo_matches")


@query
def flights_geo(spark, d):
    return geo.flights_geo(assigned(spark, d), "v1")


@query
def geocoded_ratio(spark, d):
    return geo.geocoded_ratio(assigned(spark, d))


@query
def location_audit(spark, d):
    cells = region_grid(spark, d)
    return geo.audit_locations(geo.flights_geo(assigned(spark, d, cells), "v1"), cells, CELL_DEGREES)


@query
def region_lookup(spark, d):
    named = geo.with_region_names(flights(spark, d), regions(spark, d))
    return named.groupBy("region_code", "directory_name").agg(F.count("*").alias("flights"))


# Metrics.


@query
def aggregates_month(spark, d):
    return months(spark, d, by_vehicle=True)


@query
def median_duration(spark, d):
    return agg.median_duration(metric_rows(flights(spark, d)))


@query
def breakdowns(spark, d):
    return agg.breakdowns(metric_rows(flights(spark, d)))


@query
def reporting_hours(spark, d):
    return agg.reporting_hours(years(spark, d)).select("region_code", "year", "duration_sum_h")


@query
def mom_dynamics(spark, d):
    return agg.month_over_month(months(spark, d))


@query
def yoy_dynamics(spark, d):
    return agg.year_over_year(years(spark, d))


@query
def trailing_trend(spark, d):
    return agg.trailing_trend(months(spark, d)).drop("duration_sum_min", "duration_avg_min")


@query
def top_regions(spark, d):
    return agg.top_regions(years(spark, d)).drop("duration_avg_min")


@query
def top_share(spark, d):
    return agg.top_share(years(spark, d))


@query
def peak_month(spark, d):
    return agg.peak_month(months(spark, d))


@query
def seasonality(spark, d):
    return agg.seasonality(months(spark, d))


@query
def reconcile_aggregates(spark, d):
    rows = flights(spark, d)
    counted = agg.dated(rows.where(~F.col("superseded")))
    return agg.reconcile(agg.aggregates_year(metric_rows(rows)), counted, limit=None)


@query
def stats_page(spark, d):
    return agg.stats_page(years(spark, d), after=(None, 1995), size=20)


# Versions and insights.


@query
def version_diff(spark, d):
    return versions.version_diff(first_version(spark, d), flights(spark, d))


@query
def row_difference(spark, d):
    changed = versions.row_difference(first_version(spark, d), flights(spark, d))
    return changed.select("side", "flight_id", "start_time_utc", "end_time_utc", "superseded")


@query
def aggregate_diff(spark, d):
    old = agg.aggregates_year(metric_rows(first_version(spark, d)))
    return agg.compare_aggregates(old, years(spark, d))


@query
def region_facts(spark, d):
    rows = stored_flights(spark, d)
    metrics = metric_rows(rows)
    peaks = agg.peak_month(agg.aggregates_month(metrics, by_vehicle=False))
    return insights.region_facts(agg.aggregates_year(metrics), peaks)


@query
def region_insights(spark, d):
    return insights.insights(region_facts(spark, d))


@query
def drilldown(spark, d):
    rows = stored_flights(spark, d)
    top = agg.top_regions(agg.aggregates_year(metric_rows(rows)), 1).where("measure = 'flights_count'")
    found = insights.drilldown(top, metric_rows(rows))
    return found.select("flight_id", "region_code", "start_time_utc", "duration_minutes")


# Streams.


def _deliver(reports: DataFrame, landing: str) -> None:
    """Two deliveries: the original reports, then the re-issues.

    Their number of files, and so of batches that settle the touched months again, does not grow with the rows.
    Rows of one order share a file.
    """
    for seq in (0, 1):
        reports.where(F.col("_row_ord.seq") == seq).repartition(DELIVERED_FILES, "_row_ord.key").write.mode("append").parquet(landing)


def _run_ingest(spark, d) -> incremental.Tables:
    root = scratch_path(spark, "stream")
    landing = f"{root}/landing"
    reports = adapters.flight_reports(spark, d)
    _deliver(reports, landing)
    schema = spark.read.parquet(landing).schema
    tables = incremental.Tables(f"{root}/tables")
    only_schema = [quality.SchemaCheck()]
    source = incremental.watch(spark, landing, schema, files_per_batch=4)
    incremental.ingest_stream(source, tables, f"{root}/checkpoint", only_schema).awaitTermination()
    return tables


@query
def incremental_flights(spark, d):
    tables = _run_ingest(spark, d)
    rows = spark.read.parquet(tables.flights)
    return rows.select("flight_id", "start_time_utc", "end_time_utc", "region_code", "superseded")


@query
def incremental_recompute(spark, d):
    tables = _run_ingest(spark, d)
    return spark.read.parquet(tables.aggregates).select(
        "region_code", "year", "flights_count", "duration_sum_min", "duration_avg_min"
    )


@query
def stream_daily_counts(spark, d):
    root = scratch_path(spark, "live")
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet")
    rows = adapters.from_events(events).withColumn(
        "start_time_utc", F.to_timestamp(F.concat(F.col("start_time_utc").cast("string"), F.lit("+00:00")))
    )
    live.write_counts(rows, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    out = live.totals(spark.read.parquet(f"{root}/out"))
    # The clock time in UTC of the window start, whatever the session zone.
    seconds = F.unix_micros("window_start") / F.lit(1_000_000)
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    day = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return out.withColumn("window_start", day)
