from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import SAMPLE_CSV, flights, plan_of, write

from skyledger.operators import aggregates as a
from skyledger.operators import insights, versions
from skyledger.operators.normalize import metric_rows, normalize
from skyledger.sources import registry


@pytest.fixture(scope="module")
def metrics(spark, tmp_path_factory):
    path = write(tmp_path_factory.mktemp("csv"), "a.csv", SAMPLE_CSV)
    return metric_rows(normalize(registry.load_flights(spark, path))).cache()


def flight(i, start, minutes=60.0, region="A", **more):
    return {"flight_id": f"F{i}", "start_time_utc": start, "end_time_utc": start + timedelta(minutes=minutes),
            "duration_minutes": minutes, "region_code": region, **more}


def test_sample_metrics(metrics):
    years = a.aggregates_year(metrics)
    got = {r.region_code: (r.flights_count, float(r.duration_sum_min)) for r in years.collect()}
    assert got == {"RU-MOW": (2, 110.0), "RU-KDA": (1, 50.0), "RU-SPE": (1, 32.0), "RU-SVE": (1, 30.0)}
    whole = metrics.agg(F.sum("minutes").alias("s"), F.avg("minutes").alias("m")).first()
    assert (float(whole.s), float(whole.m)) == (222.0, 44.4)
    assert a.median_duration(metrics, "year").first().duration_median_min == 45.0
    months = a.aggregates_month(metrics.withColumn("region_code", F.lit("all")), by_vehicle=False)
    rows = a.month_over_month(months).orderBy("month").collect()
    assert [(r.flights_count, float(r.duration_sum_min), r.flights_count_mom_pct, r.duration_sum_min_mom_pct) for r in rows] == [
        (2, 77.0, None, None), (2, 95.0, 0.0, 23.38), (1, 50.0, -50.0, -47.37)]
    top = a.top_regions(years, 2).where("measure = 'duration_sum_min'").orderBy("rank")
    assert [r.region_code for r in top.collect()] == ["RU-MOW", "RU-KDA"]


def test_changes_need_the_adjacent_period_and_a_base(spark):
    years = spark.createDataFrame([("A", 2020, 10, 0.0, 1.0), ("A", 2022, 5, 1.0, 1.0), ("A", 2023, 10, 2.0, 3.0),
                                   ("B", 2020, 0, 0.0, 0.0), ("B", 2021, 3, 1.0, 1.0)],
                                  "region_code string, year int, flights_count long, duration_sum_min double, duration_avg_min double")
    got = {(r.region_code, r.year): r.flights_count_yoy_pct for r in a.year_over_year(years).collect()}
    assert got == {("A", 2020): None, ("A", 2022): None, ("A", 2023): 100.0, ("B", 2020): None, ("B", 2021): None}


def test_counts_are_distinct_and_approximate_on_request(spark):
    start = datetime(2024, 5, 1)
    df = metric_rows(flights(spark, [flight(i % 40, start + timedelta(hours=i)) for i in range(80)]))
    assert a.aggregates_year(df).first().flights_count == 40
    assert abs(a.aggregates_year(df, approx=0.05).first().flights_count - 40) <= 4


def test_hot_region_is_spread_before_the_distinct_count(metrics):
    plan = plan_of(a.aggregates_year(metrics))
    assert "hashpartitioning(region_code" in plan and "flight_id" in plan.split("hashpartitioning(region_code")[-1]
    assert "Python" not in plan


def test_top_n_is_limited_before_the_shuffle(metrics):
    assert "WindowGroupLimit" in plan_of(a.top_regions(a.aggregates_year(metrics)))


def test_peaks_shares_trends(spark):
    rows = [flight(i, datetime(2024, m, 1), region=r) for i, (m, r) in enumerate(
        [(3, "A"), (3, "A"), (2, "A"), (2, "A"), (7, "B"), (8, "B"), (8, "C")])]
    months = a.aggregates_month(metric_rows(flights(spark, rows)), by_vehicle=False)
    peaks = {r.region_code: (r.peak_month, r.peak_month_flights) for r in a.peak_month(months).collect()}
    assert peaks == {"A": (2, 2), "B": (7, 1), "C": (8, 1)}
    season = {r.month: (r.share, r["index"]) for r in a.seasonality(months).collect()}
    assert season[2] == (round(2 / 7, 6), round(24 / 7, 6))
    years = a.aggregates_year(metric_rows(flights(spark, rows)))
    assert a.top_share(years, 2).first().top_share == round(6 / 7, 6)
    trend = {(r.region_code, r.month): (r.flights_trailing_avg, r.flights_running) for r in a.trailing_trend(months).collect()}
    assert trend[("A", 3)] == (2.0, 4) and trend[("B", 8)] == (1.0, 2)
    assert a.reporting_hours(years).where("region_code = 'A'").first().duration_sum_h == 4.0


def test_breakdowns_leave_blank_values_out(spark):
    start = datetime(2024, 1, 1)
    df = flights(spark, [flight(0, start, operator_type="x", payload_type=""), flight(1, start, operator_type="x"),
                         flight(2, start, operator_type="y", flight_purpose="p")])
    got = {(r.dimension, r.value): r.flights_count for r in a.breakdowns(metric_rows(df)).collect()}
    assert got == {("operator_type", "x"): 2, ("operator_type", "y"): 1, ("flight_purpose", "p"): 1}


def test_reconciliation_and_pages(spark):
    start = datetime(2024, 1, 1)
    df = flights(spark, [flight(0, start), flight(1, start, 0.0), flight(2, start, region=None)])
    rows = a.reconcile(a.aggregates_year(metric_rows(df)), a.dated(df)).collect()
    assert [(r.region_code, r.flights_count, r.normalized_flights) for r in rows] == [(None, 1, 0), ("A", 1, 2)]
    table = spark.createDataFrame([(r, y) for r in "ABC" for y in (2020, 2021)], "region_code string, year int")
    page = a.stats_page(table, size=4).collect()
    rest = a.stats_page(table, after=(page[-1].region_code, page[-1].year), size=4).collect()
    assert [tuple(r) for r in page + rest] == [(r, y) for r in "ABC" for y in (2020, 2021)]
    assert a.stats_page(table, year=2021, region="B").count() == 1


def test_version_difference(spark):
    start = datetime(2024, 1, 1)
    old = [flight(0, start), flight(1, start), flight(2, start), flight(9, start, superseded=True)]
    new = [flight(0, start), flight(1, start, 61.0), flight(3, start), flight(2, start + timedelta(seconds=1))]
    diff = versions.version_diff(flights(spark, old), flights(spark, new))
    got = sorted((r.flight_id, r.start_second[-2:], r.change) for r in diff.collect())
    assert got == [("F0", "00", "unchanged"), ("F1", "00", "changed"), ("F2", "00", "removed"),
                   ("F2", "01", "added"), ("F3", "00", "added")]
    assert "Join" not in plan_of(diff)
    rows = versions.row_difference(flights(spark, old), flights(spark, new)).collect()
    assert sum(r.side == "old" for r in rows) == 3 and sum(r.side == "new" for r in rows) == 3
    o, n = (a.aggregates_year(metric_rows(flights(spark, x))) for x in (old, new))
    row = a.compare_aggregates(o, n).first()
    assert (row.old_flights_count, row.new_flights_count, row.flights_count_delta, float(row.duration_sum_min_delta)) == (3, 4, 1, 61.0)


def test_insights_and_drilldown(spark):
    rows = [flight(0, datetime(2023, 5, 1), 100.0), flight(1, datetime(2024, 7, 1), 94.0), flight(2, datetime(2024, 7, 2), 94.0)]
    df = metric_rows(flights(spark, rows))
    years = a.aggregates_year(df)
    peaks = a.peak_month(a.aggregates_month(df, by_vehicle=False))
    text = {r.year: r for r in insights.insights(insights.region_facts(years, peaks)).collect()}
    assert text[2024].insight == "Flights up 100.0% y/y, average duration down 6.0% y/y. Peak in July (2 flights)."
    assert text[2023].insight.startswith("Flights: no previous year")
    assert text[2024].source_keys == "aggregates_year/A/2024" and "flights_count" in text[2024].formula
    assert insights.drilldown(years.where("year = 2024"), df).count() == 2


def test_version_difference_compares_multisets(spark):
    day = datetime(2024, 1, 1)
    a1, b1 = flight(1, day, 10.0), flight(1, day, 20.0)
    assert [r.change for r in versions.version_diff(flights(spark, [a1, a1, b1]), flights(spark, [a1, b1, b1])).collect()] == ["changed"]
    assert [r.change for r in versions.version_diff(flights(spark, [a1, b1, a1]), flights(spark, [b1, a1, a1])).collect()] == ["unchanged"]
    rows = versions.row_difference(flights(spark, [a1, a1, b1]), flights(spark, [b1, b1, b1])).collect()
    assert sorted((r.side, r.duration_minutes) for r in rows) == [("new", 20.0), ("new", 20.0), ("old", 10.0), ("old", 10.0)]


def test_null_region_has_pages_and_insights(spark):
    rows = [flight(i, datetime(2023 + i % 2, 1 + i % 3, 1), 30.0, region) for i, region in enumerate([None, "A", None, None, "B", None])]
    metrics = metric_rows(flights(spark, rows))
    years = a.aggregates_year(metrics)
    everything = [(r.region_code, r.year) for r in a.stats_page(years).collect()]
    assert everything[0][0] is None and len(everything) == years.count()
    for i, key in enumerate(everything):
        page = a.stats_page(years, after=key, size=2).collect()
        assert [(r.region_code, r.year) for r in page] == everything[i + 1 : i + 3]
    facts = insights.region_facts(years, a.peak_month(a.aggregates_month(metrics, by_vehicle=False)))
    assert all(r.insight for r in insights.insights(facts).collect())
    with pytest.raises(ValueError, match="vehicle"):
        a.peak_month(a.aggregates_month(metrics))
