"""Rule-based sentences about the aggregates. They quote numbers and never change them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import year_over_year

# English month names.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def region_facts(years: DataFrame, peaks: DataFrame) -> DataFrame:
    """Per region and year: flights, hours, average, changes on the year before, peak month."""
    hours = F.round(F.col("duration_sum_min") / 60, 2)
    best = peaks.withColumnsRenamed({"region_code": "_region", "year": "_year"})
    # A null region is a group of its own.
    same = F.col("region_code").eqNullSafe(F.col("_region")) & (F.col("year") == F.col("_year"))
    facts = year_over_year(years).join(best, same, "left")
    return facts.select(
        "region_code",
        "year",
        "flights_count",
        hours.alias("duration_total_h"),
        "duration_avg_min",
        "flights_count_yoy_pct",
        "duration_avg_min_yoy_pct",
        "peak_month",
        "peak_month_flights",
    )


def _change(c: str, what: str) -> Column:
    pct = F.abs(F.col(c)).cast("decimal(18,1)").cast("string")
    return (
        F.when(F.col(c).isNull(), F.lit(f"{what}: no previous year"))
        .when(F.col(c) > 0, F.concat(F.lit(f"{what} up "), pct, F.lit("% y/y")))
        .when(F.col(c) < 0, F.concat(F.lit(f"{what} down "), pct, F.lit("% y/y")))
        .otherwise(F.lit(f"{what} unchanged y/y"))
    )


def insights(facts: DataFrame) -> DataFrame:
    """A sentence per region and year, with its formula and the keys of the aggregates used."""
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.col("peak_month"))
    peak = F.concat(
        F.lit("Peak in "), month, F.lit(" ("), F.col("peak_month_flights").cast("string"), F.lit(" flights)")
    )
    text = F.concat(
        _change("flights_count_yoy_pct", "Flights"),
        F.lit(", "),
        _change("duration_avg_min_yoy_pct", "average duration"),
        F.lit(". "),
        peak,
        F.lit("."),
    )
    formula = (
        "100*(flights_count[year]-flights_count[year-1])/flights_count[year-1]; "
        "100*(duration_avg_min[year]-duration_avg_min[year-1])/duration_avg_min[year-1]; "
        "max_by(month, flights_count)"
    )
    region = F.coalesce("region_code", F.lit("-"))
    return facts.select(
        "region_code",
        "year",
        text.alias("insight"),
        F.lit(formula).alias("formula"),
        F.concat(F.lit("aggregates_year/"), region, F.lit("/"), F.col("year").cast("string")).alias("source_keys"),
    )


def drilldown(aggregates: DataFrame, flights: DataFrame) -> DataFrame:
    """The flights behind aggregate rows; a null region is a group of its own."""
    keys = aggregates.select(F.col("region_code").alias("_region"), F.col("year").alias("_year"))
    same = flights["region_code"].eqNullSafe(F.col("_region")) & (
        F.year(flights["start_time_utc"]) == F.col("_year")
    )
    return flights.join(keys, same, "left_semi")
