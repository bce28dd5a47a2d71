"""Incremental ingest of arriving report files with Structured Streaming."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import aggregates, insights, quality, snapshots
from ..operators.normalize import flag_superseded, is_valid, metric_rows, type_rows
from ..schema import CANONICAL
from ..plans.staging import staged
from ..sources.registry import load_flights


@dataclass(frozen=True)
class Tables:
    """Paths of the tables an incremental ingest keeps, all below one root."""

    root: str

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def flights(self) -> str:
        return f"{self.root}/flights"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    @property
    def aggregates(self) -> str:
        return f"{self.root}/aggregates_year"

    @property
    def months(self) -> str:
        return f"{self.root}/aggregates_month"

    @property
    def insights(self) -> str:
        return f"{self.root}/insights"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality_report"

    @property
    def retractions(self) -> str:
        return f"{self.root}/retractions"

    @property
    def events(self) -> str:
        return f"{self.root}/events_log"


def watch(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream over report files as they arrive (Parquet of raw rows)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def watch_files(spark: SparkSession, path: str, pattern: str = "*", files_per_batch: int = 1000) -> DataFrame:
    """Stream of the names of files of any known format as they arrive below a folder."""
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    files = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return files.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path")


def _overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def _event(spark: SparkSession, name: str, batch_id: int, records: int, status: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("event"),
        F.lit(f"batch-{batch_id:08d}").alias("version"),
        F.struct(F.lit(records).cast("long").alias("records"), F.lit(status).alias("quality_status")).alias("payload"),
        F.uuid().alias("trace_id"),
        F.current_timestamp().alias("emitted_at"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )


def process_batch(
    batch: DataFrame, batch_id: int, tables: Tables, checks: list[quality.Check] | None = None, replaced: DataFrame | None = None
) -> None:
    """One micro-batch: store it, gate on quality, settle supersession, refresh aggregates.

    `replaced` (path) are files of the batch whose rows of earlier batches no longer count
    once it has passed the gate.

    Rows go to a partition per batch, so a repeated batch overwrites itself. Typed rows
    keep the batch number as `ingested_at`; a re-issued flight supersedes the earlier one
    however late it comes, by recomputing the (year, month) partitions it falls into.
    """
    spark = batch.sparkSession
    typed = staged(
        type_rows(batch).withColumns(
            {
                "ingested_at": F.lit(batch_id).cast("long"),
                "year": F.coalesce(F.year("start_time_utc"), F.lit(0)),
                "month": F.coalesce(F.month("start_time_utc"), F.lit(0)),
            }
        ),
        "typed",
    )
    bad = typed.where(~is_valid()).withColumn("batch_id", F.lit(batch_id))
    _overwrite(bad, tables.rejected, "batch_id")
    good = typed.where(is_valid())
    records = good.count()
    if records == 0:
        # Nothing usable arrived: that fails the gate and is on record.
        none = spark.range(1).select(
            F.lit("valid_rows").alias("check_name"), F.lit(quality.FAIL).alias("status"),
            F.lit("no valid row arrived").alias("summary"), F.lit(0).cast("long").alias("violation_count"),
            F.lit(None).cast("string").alias("details"), F.lit(batch_id).alias("batch_id"),
        )
        _overwrite(none, tables.quality, "batch_id")
        names = ("dataset.ingested", "dataset.validated")
        _write_events([_event(spark, n, batch_id, 0, quality.FAIL) for n in names], tables)
        return
    log = [_event(spark, "dataset.ingested", batch_id, records, "OK")]

    flagged = flag_superseded(good)
    results = staged(quality.check_results(quality.counted_flights(flagged).select(*CANONICAL), checks), "checks")
    status = quality.overall(results).first().status
    _overwrite(results.withColumn("batch_id", F.lit(batch_id)), tables.quality, "batch_id")
    log.append(_event(spark, "dataset.validated", batch_id, records, status))
    if status == quality.FAIL:
        # The rows are kept for review, nothing downstream runs.
        _overwrite(good.withColumn("batch_id", F.lit(batch_id)), f"{tables.root}/quarantine", "batch_id")
    else:
        _overwrite(good.withColumn("batch_id", F.lit(batch_id)), tables.reports, "year", "month", "batch_id")
        touched = good.select("year", "month")
        if replaced is not None:
            touched = touched.union(_retracted(spark, replaced, batch_id, tables))
        recompute(spark, touched, tables)
        log.append(_event(spark, "aggregates.built", batch_id, records, status))
        refresh_insights(spark, tables)
        log.append(_event(spark, "insights.ready", batch_id, records, status))
    _write_events(log, tables)


def _write_events(log: list[DataFrame], tables: Tables) -> None:
    events = log[0]
    for event in log[1:]:
        events = events.unionByName(event)
    _overwrite(events, tables.events, "batch_id")


def touched_months(table: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """The rows of the given (year, month) partitions; others are not read."""
    code = F.col("year") * 12 + F.col("month")
    years = sorted({y for y, _ in months})
    return table.where(F.col("year").isin(years) & code.isin(sorted(y * 12 + m for y, m in months)))


def plain_path(path: str) -> Column:
    """A path with one slash behind its scheme; scans and listings write it differently."""
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")


def retract(spark: SparkSession, files: DataFrame, batch_id: int, tables: Tables) -> None:
    """Rows of the files (path) from batches before this one no longer count."""
    recompute(spark, _retracted(spark, files, batch_id, tables), tables)
    refresh_insights(spark, tables)


def _retracted(spark: SparkSession, files: DataFrame, batch_id: int, tables: Tables) -> DataFrame:
    """Notes the retraction; returns the (year, month) of the rows concerned."""
    noted = files.select(plain_path("path").alias("path"), F.lit(batch_id).cast("long").alias("before"))
    snapshots.publish(noted, tables.retractions, uuid.uuid4().hex)
    reports = spark.read.parquet(tables.reports).where(F.col("batch_id") < batch_id)
    mine = reports.withColumn("_path", plain_path("_src_path")).join(noted.select(F.col("path").alias("_path")), "_path", "left_semi")
    return mine.select("year", "month").distinct()


def counting(spark: SparkSession, reports: DataFrame, tables: Tables) -> DataFrame:
    """The stored reports without those of files that were replaced or taken back."""
    if "_src_path" not in reports.columns or not snapshots.exists(spark, tables.retractions):
        return reports
    last = snapshots.read(spark, tables.retractions).groupBy(F.col("path").alias("_path")).agg(F.max("before").alias("_before"))
    named = reports.withColumn("_path", plain_path("_src_path"))
    old = (named["_path"] == last["_path"]) & (named["batch_id"] < last["_before"])
    return named.join(last, old, "left_anti").drop("_path")


def recompute(spark: SparkSession, arrived: DataFrame, tables: Tables) -> None:
    """Redo supersession for the months the arrived rows touch, aggregates for their years.

    Reports and flights are partitioned by year and month, so only touched partitions are read.
    Months and years that have no rows left go.
    """
    # Twelve rows a year at most, as many years as a timestamp has.
    months = [(r.year, r.month) for r in arrived.select("year", "month").distinct().toLocalIterator()]
    if not months:
        return
    reports = counting(spark, touched_months(spark.read.parquet(tables.reports), months), tables)
    flights = flag_superseded(reports.drop("batch_id"))
    _overwrite(flights.select(*CANONICAL, "year", "month"), tables.flights, "year", "month")
    left = {(r.year, r.month) for r in reports.select("year", "month").distinct().toLocalIterator()}
    for year, month in set(months) - left:
        _drop(spark, f"{tables.flights}/year={year}/month={month}")
    years = sorted({y for y, _ in months})
    stored = spark.read.parquet(tables.flights).where(F.col("year").isin(years)).select(*CANONICAL)
    metrics = metric_rows(stored)
    for table, path in ((aggregates.aggregates_year(metrics), tables.aggregates), (aggregates.aggregates_month(metrics, by_vehicle=False), tables.months)):
        # A few rows per region and month, read twice.
        table = staged(table, "aggregates")
        _overwrite(table, path, "year")
        kept = {r.year for r in table.select("year").distinct().toLocalIterator()}
        for year in set(years) - kept:
            _drop(spark, f"{path}/year={year}")


def _drop(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def refresh_insights(spark: SparkSession, tables: Tables) -> None:
    """Sentences from the stored aggregates, which are few rows per region."""
    years, months = spark.read.parquet(tables.aggregates), spark.read.parquet(tables.months)
    facts = insights.region_facts(years, aggregates.peak_month(months))
    _overwrite(insights.insights(facts), tables.insights, "year")


def ingest_files(
    names: DataFrame, tables: Tables, checkpoint: str, checks: list[quality.Check] | None = None, hint: str | None = None
) -> StreamingQuery:
    """`ingest_stream` for files that `watch_files` names: each batch loads its files, whatever their format."""

    def process(batch: DataFrame, batch_id: int) -> None:
        # At most files_per_batch names.
        paths = [r.path for r in batch.collect()]
        # Read once, by the typing, whose rows are written.
        process_batch(load_flights(batch.sparkSession, paths, hint), batch_id, tables, checks)

    return (
        names.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    source: DataFrame, tables: Tables, checkpoint: str, checks: list[quality.Check] | None = None
) -> StreamingQuery:
    """Process all files there are, then stop; started again it goes on with new ones."""
    return (
        source.writeStream.foreachBatch(lambda df, i: process_batch(df, i, tables, checks))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
