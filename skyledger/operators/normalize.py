"""Raw text rows to the canonical flight table.

Input rows carry the raw columns as text (missing ones count as null), `_row_ord`
(any orderable, unique value that gives the input order), and optionally `_src_tz`
(zone of the file) and `ingested_at` (when versions of a record are mixed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import surrogate_id
from ..functions.text import strip_cell, to_number
from ..functions.times import known_zone, parse_utc, second_text, whole_minutes
from ..plans.staging import staged
from ..schema import CANONICAL

_KEY = ("_key_id", "_key_start", "_key_region")


def _raw(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _text(df: DataFrame, name: str) -> Column:
    return strip_cell(_raw(df, name).cast("string"))


def type_rows(df: DataFrame, tz_hint: str | None = None, default_tz: str = "UTC") -> DataFrame:
    """Parse times and numbers, derive durations and surrogate ids.

    Keeps every input row. `_given_duration` is the duration as reported, before the
    fallback to end - start.
    """
    carried = [c for c in ("_row_ord", "ingested_at", "_src_path", "_src_degraded") if c in df.columns]
    texts = ("flight_id", "region_code", "region_name", "vehicle_category", "operator_type",
             "flight_purpose", "payload_type")
    zone = F.lit(tz_hint).cast("string") if tz_hint or "_src_tz" not in df.columns else F.col("_src_tz")
    zoned = df.withColumn("_zone", zone)
    fallback = F.coalesce(known_zone("_zone"), F.lit(default_tz))
    parsed = F.struct(
        parse_utc(_raw(df, "start_time").cast("string"), fallback).alias("start_time_utc"),
        parse_utc(_raw(df, "end_time").cast("string"), fallback).alias("end_time_utc"),
        to_number(_raw(df, "latitude").cast("string")).alias("latitude"),
        to_number(_raw(df, "longitude").cast("string")).alias("longitude"),
    )
    # Filters on the parsed columns cannot move below the inline, so nothing is parsed twice.
    # They are parsed before it, as Spark does not compile what is inside an inline.
    rows = zoned.select(
        *[_text(df, c).alias(f"_{c}" if c == "flight_id" else c) for c in texts],
        to_number(_raw(df, "duration_minutes").cast("string")).alias("_given_duration"),
        *carried,
        parsed.alias("_parsed"),
    ).select("*", F.inline(F.array("_parsed")))
    start, end = F.col("start_time_utc"), F.col("end_time_utc")
    surrogate = F.when(
        F.coalesce(F.col("_flight_id"), F.lit("")) == "",
        surrogate_id(start, end, F.col("region_code"), F.col("region_name")),
    )
    return rows.select(
        F.coalesce(F.nullif(F.col("_flight_id"), F.lit("")), surrogate).alias("flight_id"),
        surrogate.alias("surrogate_id"),
        "start_time_utc",
        "end_time_utc",
        F.coalesce(F.col("_given_duration"), whole_minutes(start, end).cast("double")).alias("duration_minutes"),
        "region_code",
        "region_name",
        "latitude",
        "longitude",
        "vehicle_category",
        "operator_type",
        "flight_purpose",
        "payload_type",
        "_given_duration",
        *carried,
    )


def _rules() -> dict[str, Column]:
    """What makes a typed row invalid; null counts as not broken."""
    start, end = F.col("start_time_utc"), F.col("end_time_utc")
    return {
        "start_time": start.isNull(),
        "end_time": end.isNull(),
        "end_before_start": end < start,
        "latitude_range": ~F.col("latitude").between(-90, 90),
        "longitude_range": ~F.col("longitude").between(-180, 180),
    }


def invalid_reasons() -> Column:
    """Names of the validity rules a typed row breaks."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in _rules().items()]))


def is_valid() -> Column:
    valid = F.lit(True)
    for broken in _rules().values():
        valid = valid & ~F.coalesce(broken, F.lit(False))
    return valid


def _with_key(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "_key_id": F.col("flight_id"),
            "_key_start": second_text(F.col("start_time_utc")),
            "_key_region": F.coalesce(F.col("region_code"), F.lit("")),
        }
    )


def _order(df: DataFrame) -> Column:
    cols = [c for c in ("ingested_at", "_row_ord") if c in df.columns]
    return F.struct(*cols)


def repeated_keys(df: DataFrame) -> DataFrame:
    """Keys (flight, start second, region) that occur more than once: `_last` position and `_copies`."""
    keyed = _with_key(df).select(*_KEY, _order(df).alias("_order"))
    return keyed.groupBy(*_KEY).agg(F.max("_order").alias("_last"), F.count("*").alias("_copies")).where("_copies > 1")


def written_repeated_keys(df: DataFrame) -> DataFrame:
    """`repeated_keys` of written rows, written, so that few of them are broadcast by their known size.

    Hashes of flight, minute and region are counted first, and only rows whose hash occurs
    more than once are grouped by their whole key. Rows of one key have one hash.
    """
    start = F.col("start_time_utc")
    minute = F.to_date(start), F.hour(start), F.minute(start)
    hashed = df.withColumn("_hash", F.xxhash64("flight_id", *minute, F.coalesce(F.col("region_code"), F.lit(""))))
    hashes = staged(hashed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash"), "hashes")
    some = hashed.join(hashes, "_hash", "left_semi").drop("_hash")
    return staged(repeated_keys(some), "repeated_keys")


def flag_superseded(df: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Mark all but the last row per (flight, start second, region).

    The last position per key is a pre-aggregated max and only keys that occur more
    than once are joined back, so a key that holds a large share of the rows is
    reduced before the shuffle and its rows stay splittable by AQE; a window would
    put them all in one task. `repeated` are the `written_repeated_keys` where they are at hand.
    """
    keyed = _with_key(df).withColumn("_order", _order(df))
    last = (repeated_keys(df) if repeated is None else repeated).select(*_KEY, "_last")
    flagged = keyed.join(last, list(_KEY), "left")
    superseded = F.coalesce(F.col("_order") < F.col("_last"), F.lit(False))
    return flagged.withColumn("superseded", superseded).drop(*_KEY, "_order", "_last")


def normalize(df: DataFrame, tz_hint: str | None = None, default_tz: str = "UTC") -> DataFrame:
    """Canonical flights (superseded rows kept and flagged) plus `_row_ord`."""
    return normalize_typed(type_rows(df, tz_hint, default_tz))


def normalize_typed(typed: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """`normalize` behind `type_rows`; reads its input twice, so large inputs are written first.

    `repeated` are the `written_repeated_keys` of the valid rows where they are at hand.
    """
    return canonical(flag_superseded(typed.where(is_valid()), repeated))


def canonical(df: DataFrame) -> DataFrame:
    """The 14 canonical columns in order; unknown columns are dropped, `_row_ord` is kept."""
    extra = [c for c in ("_row_ord",) if c in df.columns]
    return df.select(*CANONICAL, *extra)


def ingest_counters(df: DataFrame, tz_hint: str | None = None, default_tz: str = "UTC") -> DataFrame:
    """One row: raw, normalized, valid, invalid, duplicates. One scan, one shuffle.

    `raw` and `invalid` count input rows, `duplicates` the superseded ones among the
    valid rows; `valid` rows are those left.
    """
    return typed_counters(type_rows(df, tz_hint, default_tz))


def typed_counters(typed: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """`ingest_counters` behind `type_rows`.

    `repeated` are the `written_repeated_keys` of the valid rows; with them no row is shuffled.
    """
    if repeated is not None:
        copies = repeated.select(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"))
        rows = typed.select(F.count("*").alias("raw"), F.count_if(~is_valid()).alias("invalid")).crossJoin(copies)
        return _counted(rows)
    rows = _with_key(typed).withColumn("_ok", is_valid())
    keys = [F.when(F.col("_ok"), F.col(k)).alias(k) for k in _KEY]
    groups = rows.select("_ok", *keys).groupBy("_ok", *_KEY).agg(F.count("*").alias("_n"))
    totals = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(~F.col("_ok"), F.col("_n"))), F.lit(0)).alias("invalid"),
        F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_n") - 1)), F.lit(0)).alias("duplicates"),
    )
    return _counted(totals)


def _counted(totals: DataFrame) -> DataFrame:
    return totals.select(
        "raw",
        (F.col("raw") - F.col("invalid")).alias("normalized"),
        (F.col("raw") - F.col("invalid") - F.col("duplicates")).alias("valid"),
        "invalid",
        "duplicates",
    )


def rejected(df: DataFrame, tz_hint: str | None = None, default_tz: str = "UTC") -> DataFrame:
    """Rows the normalisation removes, with the broken rules."""
    return typed_rejected(type_rows(df, tz_hint, default_tz))


def typed_rejected(typed: DataFrame) -> DataFrame:
    """`rejected` behind `type_rows`."""
    return (
        typed.where(~is_valid())
        .withColumn("reasons", F.array_join(invalid_reasons(), ","))
        .drop("_given_duration")
    )


def duration_mismatch(
    df: DataFrame, tolerance: float = 1.0, tz_hint: str | None = None, default_tz: str = "UTC"
) -> DataFrame:
    """Valid rows whose reported duration differs from end - start by more than the tolerance."""
    derived = whole_minutes(F.col("start_time_utc"), F.col("end_time_utc")).cast("double")
    return (
        type_rows(df, tz_hint, default_tz)
        .where(is_valid() & F.col("_given_duration").isNotNull())
        .withColumn("derived_minutes", derived)
        .withColumnRenamed("_given_duration", "given_minutes")
        .where(F.abs(F.col("given_minutes") - F.col("derived_minutes")) > tolerance)
    )


def batch_years(flights: DataFrame) -> DataFrame:
    """Distinct start years of the flights that count."""
    return (
        flights.where(~F.col("superseded"))
        .select(F.year("start_time_utc").alias("year"))
        .where("year IS NOT NULL")
        .distinct()
    )


def infer_year(flights: DataFrame) -> int | None:
    """The batch year if all flights start in one year; None for an empty batch.

    Several years are an error: the caller has to name the year.
    """
    years = [r.year for r in batch_years(flights).limit(2).collect()]
    if len(years) > 1:
        raise ValueError("flights start in several years; pass the batch year")
    return years[0] if years else None


def metric_exclusions(flights: DataFrame, low: float = 0.0, high: float = 1440.0) -> DataFrame:
    """Flights that the metrics leave out because of their duration, with the reason."""
    d = F.col("duration_minutes")
    reason = (
        F.when(d.isNull(), "no duration")
        .when(d <= low, "duration not above the lower bound")
        .when(d > high, "duration above the upper bound")
    )
    out = flights.where(~F.col("superseded")).withColumn("reason", reason).where("reason IS NOT NULL")
    return out.select("flight_id", "start_time_utc", "region_code", "duration_minutes", "reason")


def metric_rows(
    flights: DataFrame, year: int | None = None, low: float = 0.0, high: float = 1440.0
) -> DataFrame:
    """Flights that enter the metrics: not superseded, low < duration <= high, in the year.

    Durations take the stored precision of two decimals.
    """
    rows = flights.where(~F.col("superseded")).where(
        (F.col("duration_minutes") > low) & (F.col("duration_minutes") <= high)
    )
    if year is not None:
        rows = rows.where(F.year("start_time_utc") == year)
    return rows.withColumn("minutes", F.col("duration_minutes").cast("decimal(10,2)"))
