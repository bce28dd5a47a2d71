"""Dataset versions: status log, differences between versions, slices by quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import second_text
from ..schema import CANONICAL

STATUS_SCHEMA = (
    "dataset_version STRING, event_ts TIMESTAMP_NTZ, status STRING, year INT, source_uri STRING, "
    "checksum STRING, artifacts STRING, warn_count BIGINT, fail_count BIGINT"
)


def status_row(spark: SparkSession, version: str, event_ts, status: str, **fields) -> DataFrame:
    """One entry of the status log (new, ingested, validated, quality_warn, quality_fail)."""
    names = [part.split()[0] for part in STATUS_SCHEMA.split(", ")]
    values = {"dataset_version": version, "event_ts": event_ts, "status": status, **fields}
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"no such status field: {sorted(unknown)}")
    return spark.createDataFrame([tuple(values.get(n) for n in names)], STATUS_SCHEMA)


def current_status(log: DataFrame) -> DataFrame:
    """State of each version: the last status, and the last value of each other field."""
    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("event_ts"))).alias(c)

    def at(*statuses: str) -> Column:
        return F.max(F.when(F.col("status").isin(*statuses), F.col("event_ts")))

    fields = ("year", "source_uri", "checksum", "artifacts", "warn_count", "fail_count")
    return log.groupBy("dataset_version").agg(
        F.max_by("status", "event_ts").alias("status"),
        *[last(c) for c in fields],
        at("ingested").alias("ingested_at"),
        at("validated", "quality_warn", "quality_fail").alias("validated_at"),
    )


def require_version(log: DataFrame, version: str) -> DataFrame:
    """The current state of a version; a missing one is an error."""
    found = current_status(log.where(F.col("dataset_version") == version))
    if found.isEmpty():
        raise LookupError(f"dataset version {version} does not exist")
    return found


def _flight_key(df: DataFrame) -> list[Column]:
    return [
        F.col("flight_id"),
        second_text(F.col("start_time_utc")).alias("start_second"),
        F.coalesce("region_code", F.lit("")).alias("region"),
    ]


def version_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """added, removed, changed or unchanged per flight (id, start second, region).

    Both sides are united and counted, first per key and row hash, then per key: no pairs
    even where a key repeats within a version. Repeated rows compare as multisets.
    """
    measured = [c for c in CANONICAL if c not in ("flight_id", "superseded")]

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        rows = df.where(~F.col("superseded"))
        text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in measured]))
        return rows.select(*_flight_key(rows), F.lit(is_new).alias("is_new"), F.sha2(text, 256).alias("content"))

    both = side(old, False).unionByName(side(new, True))

    n_old, n_new = F.count_if(~F.col("is_new")), F.count_if(F.col("is_new"))
    copies = both.groupBy("flight_id", "start_second", "region", "content").agg(n_old.alias("n_old"), n_new.alias("n_new"))
    grouped = copies.groupBy("flight_id", "start_second", "region").agg(
        F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"), F.bool_and(F.col("n_old") == F.col("n_new")).alias("same")
    )
    change = (
        F.when(F.col("n_old") == 0, "added")
        .when(F.col("n_new") == 0, "removed")
        .when(F.col("same"), "unchanged")
        .otherwise("changed")
    )
    return grouped.select("flight_id", "start_second", "region", change.alias("change"))


def row_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of one version that the other lacks, counting repeats."""
    cols = [c for c in CANONICAL if c in old.columns and c in new.columns]
    # One pass over both: copies count for the new version and against the old one.
    both = old.select(*cols, F.lit(-1).alias("_n")).union(new.select(*cols, F.lit(1).alias("_n")))
    left = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.abs("_n").cast("int")))
    side = F.when(F.col("_n") < 0, "old").otherwise("new")
    return left.select(*cols, side.alias("side"), copies.alias("_copy")).drop("_copy")


def flights_with_issues(flights: DataFrame, issues: DataFrame) -> DataFrame:
    return flights.join(issues, flights.flight_id == issues.flight_uid, "left_semi")


def flights_without_issues(flights: DataFrame, issues: DataFrame) -> DataFrame:
    return flights.join(issues, flights.flight_id == issues.flight_uid, "left_anti")


def operational_metrics(state: DataFrame, assigned: DataFrame) -> DataFrame:
    """geocoded_ratio of the flights and quality_fail_count of the versions, with alerts.

    Both sides are single rows.
    """
    hits, n = F.count_if(F.col("geo_region").isNotNull()), F.count("*")
    fails = state.agg(F.count_if(F.col("status") == "quality_fail")).scalar()
    row = assigned.agg(F.round(hits / F.nullif(n, F.lit(0)), 6).alias("geocoded_ratio"))
    return row.withColumn("quality_fail_count", fails).withColumns(
        {
            "quality_alert": F.col("quality_fail_count") > 0,
            "geocoding_alert": F.coalesce(F.col("geocoded_ratio") < 0.99, F.lit(False)),
        }
    )
