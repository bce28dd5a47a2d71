import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import flights, plan_of

from skyledger.operators import quality as q

START = datetime(2024, 1, 15, 6)


def sample(n=5):
    regions = ["RU-MOW", "RU-SPE", "RU-MOW", "RU-SVE", "RU-KDA"]
    return [
        {
            "flight_id": f"F{i}", "start_time_utc": START + timedelta(days=10 * i), "end_time_utc": START + timedelta(days=10 * i, minutes=m),
            "duration_minutes": float(m), "region_code": regions[i], "latitude": 55.0, "longitude": 37.0,
        }
        for i, m in list(enumerate((45, 32, 65, 30, 50)))[:n]
    ]


def statuses(df, checks=None):
    return {r.check_name: r.status for r in q.check_results(df, checks).collect()}


def test_clean_flights(spark):
    df = flights(spark, sample())
    assert list(statuses(df)) == ["schema", "duration_range", "coordinate_range", "uniqueness",
                                  "monthly_completeness", "duration_outliers"]
    assert set(statuses(df).values()) == {"OK"}
    assert q.overall(q.check_results(df)).first().asDict() == {
        "status": "OK", "quality_status": "validated", "warn_count": 0, "fail_count": 0, "total": 0}
    assert q.flight_issues(df).count() == 0
    details = q.DurationOutlierCheck().result(df).first().details
    assert json.loads(details)["thresholds"] == {"lower": 5.0, "upper": 77.0}


def test_failures(spark):
    rows = sample()
    rows[0]["duration_minutes"] = -5.0
    rows[1]["latitude"] = 120.0
    df = flights(spark, rows + [rows[0]])
    got = statuses(df)
    assert (got["duration_range"], got["coordinate_range"], got["uniqueness"]) == ("FAIL",) * 3
    assert q.overall(q.check_results(df)).first().quality_status == "quality_fail"
    report = {r.check_name: r for r in q.quality_report(df).collect()}
    assert report["duration_range"].summary == "2 durations are out of range"
    assert report["duration_range"].impacted_records == 1
    assert report["coordinate_range"].impacted_regions == ["RU-SPE"]
    shown = json.loads(report["coordinate_range"].sample_rows)[0]
    assert shown["start_time_utc"] == "2024-01-25T06:00:00Z" and shown["latitude"] == 120.0
    issues = {(r.flight_uid, r.check_name) for r in q.flight_issues(df).collect()}
    assert {("F0", "duration_range"), ("F0", "uniqueness"), ("F1", "coordinate_range")} <= issues
    assert [r.flight_uid for r in q.ordered_issues(q.flight_issues(df)).collect()] == sorted(
        r.flight_uid for r in q.flight_issues(df).collect())


def test_month_gap_warns(spark):
    rows = sample(2)
    rows[0]["start_time_utc"], rows[1]["start_time_utc"] = datetime(2024, 1, 1), datetime(2024, 3, 1)
    df = flights(spark, rows)
    row = q.MonthlyCompletenessCheck().result(df).first()
    assert (row.status, row.violation_count) == ("WARN", 1)
    assert json.loads(row.details) == {"missing_months": {"2024": [2]}, "observed": {"2024": [1, 3]}}
    assert q.overall(q.check_results(df)).first().quality_status == "quality_warn"


def test_nulls_fail_where_they_should(spark):
    rows = sample()
    rows[0]["start_time_utc"] = None
    rows[1]["duration_minutes"] = None
    df = flights(spark, rows)
    got = statuses(df)
    assert (got["schema"], got["monthly_completeness"], got["duration_range"]) == ("FAIL", "FAIL", "OK")
    assert json.loads(q.SchemaCheck().result(df).first().details) == {
        "null_counts": {"duration_minutes": 1, "start_time_utc": 1}}
    assert {r.flight_uid for r in q.flight_issues(df).collect()} == {"F0"}


def test_absent_and_extra_columns(spark):
    df = flights(spark, sample()).drop("duration_minutes", "latitude").withColumn("extra", F.lit(1))
    row = {r.check_name: r for r in q.check_results(df).collect()}
    assert row["schema"].status == "FAIL"
    assert row["schema"].summary == "required columns are absent; there are columns beyond the record"
    assert row["duration_range"].summary == row["duration_outliers"].summary == "there is no column duration_minutes"
    assert row["coordinate_range"].status == "WARN"
    no_key = flights(spark, sample()).drop("flight_id")
    assert statuses(no_key, [q.UniquenessCheck()]) == {"uniqueness": "FAIL"}


def test_empty_table(spark):
    got = {r.check_name: (r.status, r.summary) for r in q.check_results(flights(spark, [])).collect()}
    assert got["duration_outliers"] == ("WARN", "there is no duration to compare")
    assert got["schema"][0] == "OK"


def test_all_violating_flights_become_issues_samples_stay_five(spark):
    rows = [dict(sample(1)[0], flight_id=f"V{i}", duration_minutes=5000.0 + i) for i in range(40)]
    df = flights(spark, rows)
    checks = [q.DurationRangeCheck()]
    assert q.flight_issues(df, checks).count() == 40
    report = q.quality_report(df, checks).first()
    assert len(json.loads(report.sample_rows)) == 5
    assert report.violation_count == 40


def test_null_keys_equal_each_other_and_hot_keys_are_whole(spark):
    rows = [dict(sample(1)[0], region_code=None) for _ in range(50)] + sample()[1:]
    found = q.UniquenessCheck().violations(flights(spark, rows))
    assert found.count() == 50
    plan = plan_of(found)
    assert "Window" not in plan and "NestedLoop" not in plan


def test_superseded_rows_are_left_out_unless_asked_for(spark):
    rows = sample(2)
    df = flights(spark, rows + [dict(rows[0], superseded=True)])
    assert statuses(q.counted_flights(df))["uniqueness"] == "OK"
    assert statuses(q.counted_flights(df, include_superseded=True))["uniqueness"] == "FAIL"


def test_own_check(spark):
    class NoMoscow(q.Check):
        name = "no_moscow"

        def rule(self, df):
            return F.col("region_code") == "RU-MOW"

        def measures(self, df):
            return {"n": F.count_if(self.rule(df))}

        def outcome(self, df):
            n = self._m("n")
            return q._outcome(self.name, F.when(n > 0, "WARN").otherwise("OK"), F.lit("flights in Moscow"), n, F.lit(None))

    df = flights(spark, sample())
    assert statuses(df, [NoMoscow(), q.SchemaCheck()]) == {"no_moscow": "WARN", "schema": "OK"}
    assert {r.flight_uid for r in q.flight_issues(df, [NoMoscow()]).collect()} == {"F0", "F2"}


def test_outliers_match_pandas(spark):
    import numpy as np

    values = np.round(np.random.default_rng(5).gamma(2, 30, 400), 2)
    df = flights(spark, [dict(sample(1)[0], flight_id=f"F{i}", duration_minutes=float(v)) for i, v in enumerate(values)])
    q1, q3 = np.quantile(values, [0.25, 0.75])
    want = {f"F{i}" for i, v in enumerate(values) if v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)}
    got = {r.flight_id for r in q.DurationOutlierCheck().violations(df).collect()}
    assert got == want and want


def test_mixed_columns(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (" ", None)], "duration_minutes string, latitude string")
    got = {r.column_name: (r.filled, r.not_numeric, r.status) for r in q.mixed_type_columns(df).collect()}
    assert got == {"duration_minutes": (2, 1, "WARN"), "latitude": (2, 2, "OK")}


def test_collisions_and_anomalies(spark):
    rows = sample()
    rows[1]["flight_id"] = "F0"
    found = q.storage_key_audit(flights(spark, rows)).collect()
    assert [(r.flight_id, r.rows) for r in found] == [("F0", 2)]
    rows[2]["duration_minutes"], rows[3]["longitude"] = 0.0, 181.0
    got = {r.anomaly: r.n for r in q.anomalies(flights(spark, rows), 2023).collect()}
    assert got == {"zero_duration": 1, "negative_duration": 0, "coordinates_out_of_range": 1, "outside_batch_year": 5}
