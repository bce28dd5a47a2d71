"""Yearly and monthly aggregates, dynamics, rankings.

All functions but `counted` take metric rows (see `normalize.metric_rows`) or the
aggregates built here. Group keys may be skewed: every aggregate has a map-side
partial step, and distinct flights are spread by flight id before they are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent_change
from ..schema import DIMENSIONS


def _flights(approx: float | None) -> Column:
    if approx is None:
        return F.count_distinct("flight_id")
    return F.approx_count_distinct("flight_id", approx)


def _measures(approx: float | None = None) -> list[Column]:
    return [
        _flights(approx).alias("flights_count"),
        F.sum("minutes").cast("decimal(12,2)").alias("duration_sum_min"),
        F.avg("minutes").cast("decimal(10,2)").alias("duration_avg_min"),
    ]


def dated(rows: DataFrame) -> DataFrame:
    """Add event_date, year and month of the UTC start."""
    start = F.col("start_time_utc")
    return rows.withColumns(
        {"event_date": F.to_date(start), "year": F.year(start), "month": F.month(start)}
    )


def aggregates_year(rows: DataFrame, version: str | None = None, approx: float | None = None) -> DataFrame:
    """Flights, total and average minutes per region and year.

    `approx` (a relative error) trades the exact distinct count for a sketch.
    """
    out = dated(rows).groupBy("region_code", "year").agg(*_measures(approx))
    return out if version is None else out.withColumn("dataset_version", F.lit(version))


def aggregates_month(rows: DataFrame, by_vehicle: bool = True) -> DataFrame:
    """Flights and minutes per region, year, month and, if wanted, vehicle category."""
    keys = ["region_code", "year", "month"] + (["vehicle_category"] if by_vehicle else [])
    return dated(rows).groupBy(*keys).agg(*_measures())


def median_duration(rows: DataFrame, *keys: str) -> DataFrame:
    """Exact median minutes per group (default: region and year).

    Durations are counted per value first. A value is one of the 144 000 hundredths
    of a minute in a day, which bounds the state of the percentile.
    """
    by = list(keys) or ["region_code", "year"]
    counts = dated(rows).groupBy(*by, "minutes").agg(F.count("*").alias("_n"))
    median = F.percentile(F.col("minutes").cast("double"), F.lit(0.5), F.col("_n"))
    return counts.groupBy(*by).agg(F.round(median, 4).alias("duration_median_min"))


def breakdowns(rows: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Flights and minutes per year and value of each dimension, where it is filled.

    The dimensions are stacked into (dimension, value) rows, so one shuffle serves
    all of them.
    """
    pairs = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions]
    )
    stacked = dated(rows).select("flight_id", "minutes", "year", F.inline(pairs))
    filled = stacked.where(F.coalesce(F.col("value"), F.lit("")) != "")
    return filled.groupBy("dimension", "value", "year").agg(*_measures())


def _change(window, unit: str, adjacent: Column, *measures: str) -> dict[str, Column]:
    out = {}
    for m in measures:
        previous = F.when(adjacent, F.lag(m).over(window))
        out[f"{m}_{unit}_pct"] = percent_change(F.col(m), previous)
    return out


def _whole_months(months: DataFrame) -> DataFrame:
    """Refuses a table split by vehicle: its flights would count once per category."""
    if "vehicle_category" in months.columns:
        raise ValueError("months are split by vehicle; build them with by_vehicle=False")
    return months


def month_over_month(months: DataFrame) -> DataFrame:
    """Change against the month before, within a year; null unless that month exists."""
    months = _whole_months(months)
    w = Window.partitionBy("region_code", "year").orderBy("month")
    adjacent = F.lag("month").over(w) == F.col("month") - 1
    return months.withColumns(_change(w, "mom", adjacent, "flights_count", "duration_sum_min"))


def year_over_year(years: DataFrame) -> DataFrame:
    """Change against the year before; null unless that year exists."""
    w = Window.partitionBy("region_code").orderBy("year")
    adjacent = F.lag("year").over(w) == F.col("year") - 1
    return years.withColumns(
        _change(w, "yoy", adjacent, "flights_count", "duration_sum_min", "duration_avg_min")
    )


def trailing_trend(months: DataFrame, width: int = 3) -> DataFrame:
    """Average flights of this and the months before it in the region, `width` rows in all,
    and the running total within the year."""
    months = _whole_months(months)
    by_time = Window.partitionBy("region_code").orderBy("year", "month")
    in_year = Window.partitionBy("region_code", "year").orderBy("month")
    trailing = F.avg("flights_count").over(by_time.rowsBetween(1 - width, 0))
    running = F.sum("flights_count").over(in_year.rowsBetween(Window.unboundedPreceding, 0))
    return months.withColumns(
        {"flights_trailing_avg": F.round(trailing, 4), "flights_running": running}
    )


def top_regions(years: DataFrame, n: int = 5) -> DataFrame:
    """The n leading regions of each year, by flights and by minutes.

    Ties go to the other measure, then to the region code.
    """
    minutes, flights = F.col("duration_sum_min").desc(), F.col("flights_count").desc()
    orders = {
        "flights_count": (flights, minutes, "region_code"),
        "duration_sum_min": (minutes, flights, "region_code"),
    }
    ranked = [
        years.withColumn("rank", F.row_number().over(Window.partitionBy("year").orderBy(*order)))
        .where(F.col("rank") <= n)
        .withColumn("measure", F.lit(measure))
        for measure, order in orders.items()
    ]
    return ranked[0].unionByName(ranked[1])


def top_share(years: DataFrame, n: int = 5) -> DataFrame:
    """Share of the n leading regions (by flights) in the flights of each year."""
    order = (F.col("flights_count").desc(), F.col("duration_sum_min").desc(), "region_code")
    rank = F.row_number().over(Window.partitionBy("year").orderBy(*order))
    ranked = years.withColumn("rank", rank)
    top = F.sum(F.when(F.col("rank") <= n, F.col("flights_count")))
    return ranked.groupBy("year").agg(
        top.alias("top_flights"),
        F.sum("flights_count").alias("all_flights"),
        F.round(top / F.sum("flights_count"), 6).alias("top_share"),
    )


def peak_month(months: DataFrame) -> DataFrame:
    """Busiest month of each region and year; the earliest one on a tie."""
    totals = _whole_months(months).groupBy("region_code", "year", "month").agg(F.sum("flights_count").alias("n"))
    best = F.max(F.struct(F.col("n"), (-F.col("month")).alias("neg")))
    return totals.groupBy("region_code", "year").agg(best.alias("best")).select(
        "region_code",
        "year",
        (-F.col("best.neg")).alias("peak_month"),
        F.col("best.n").alias("peak_month_flights"),
    )


def seasonality(months: DataFrame) -> DataFrame:
    """Share of each month in the flights of its year, relative to an even twelfth."""
    totals = _whole_months(months).groupBy("year", "month").agg(F.sum("flights_count").alias("flights_count"))
    share = F.col("flights_count") / F.sum("flights_count").over(Window.partitionBy("year"))
    return totals.withColumn("share", share).select(
        "year",
        "month",
        "flights_count",
        F.round("share", 6).alias("share"),
        F.round(F.col("share") * 12, 6).alias("index"),
    )


def reporting_hours(years: DataFrame) -> DataFrame:
    """Total minutes as hours."""
    hours = F.round(F.col("duration_sum_min").cast("double") / 60, 4)
    return years.withColumn("duration_sum_h", hours)


def reconcile(years: DataFrame, flights: DataFrame, limit: int | None = None) -> DataFrame:
    """Aggregates next to the number of normalised flights of the same region and year.

    The flights are counted before the join. A null key on either side matches nothing.
    """
    keys = [k for k in ("dataset_version", "region_code", "year") if k in years.columns]
    counts = flights.groupBy(*keys).agg(F.count("*").alias("normalized_flights"))
    joined = years.join(counts, keys, "left").select(
        *keys, "flights_count", F.coalesce("normalized_flights", F.lit(0)).alias("normalized_flights")
    )
    ordered = joined.orderBy(*keys)
    return ordered if limit is None else ordered.limit(limit)


def compare_aggregates(old: DataFrame, new: DataFrame) -> DataFrame:
    """Yearly aggregates of two dataset versions side by side, with differences."""
    keys = ["region_code", "year"]
    measures = ("flights_count", "duration_sum_min")

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        other = "new" if tag == "old" else "old"
        cols = [F.col(m).alias(f"{tag}_{m}") for m in measures]
        cols += [F.lit(None).cast(df.schema[m].dataType).alias(f"{other}_{m}") for m in measures]
        return df.select(*keys, *cols)

    both = tagged(old, "old").unionByName(tagged(new, "new"))
    sides = [f"{tag}_{m}" for tag in ("old", "new") for m in measures]
    merged = both.groupBy(*keys).agg(*[F.max(s).alias(s) for s in sides])
    zero = F.lit(0)
    return merged.withColumns(
        {
            f"{m}_delta": F.coalesce(f"new_{m}", zero) - F.coalesce(f"old_{m}", zero)
            for m in measures
        }
    )


def _behind(table: DataFrame, order: tuple[str, ...], after: tuple) -> Column:
    """Rows behind a key in ascending order, nulls first."""
    behind, same = F.lit(False), F.lit(True)
    for name, value in zip(order, after, strict=True):
        value_column = F.lit(value).cast(table.schema[name].dataType)
        more = F.col(name).isNotNull() if value is None else F.coalesce(F.col(name) > value_column, F.lit(False))
        behind = behind | (same & more)
        same = same & F.col(name).eqNullSafe(value_column)
    return behind


def stats_page(
    table: DataFrame,
    year: int | None = None,
    region: str | None = None,
    order: tuple[str, ...] = ("region_code", "year"),
    after: tuple | None = None,
    size: int = 50,
) -> DataFrame:
    """One page of an aggregate table: filtered, ordered by unique columns, after a key.

    Paging by key reads each page with a top-k instead of skipping rows. Nulls come first,
    in `after` as well.
    """
    rows = table
    if year is not None:
        rows = rows.where(F.col("year") == year)
    if region is not None:
        rows = rows.where(F.col("region_code") == region)
    if after is not None:
        rows = rows.where(_behind(table, order, after))
    return rows.orderBy(*order).limit(size)
