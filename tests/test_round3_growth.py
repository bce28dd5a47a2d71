"""Growth of the file queries, round 3: what is judged, moved and computed per row."""

from datetime import datetime

from pyspark.sql import functions as F

from skyledger.operators import clean, quality
from skyledger.schema import CANONICAL


def test_rows_are_not_shuffled_to_drop_service_rows(spark):
    rows = [("a", i, [" Page 1 " if i < 2 else f"F-{i}"]) for i in range(40)] + [("b", i, ["x"]) for i in range(40)]
    df = spark.createDataFrame(rows, "_src_path string, _row_ord int, cells array<string>")
    kept = clean.drop_service_rows(df, F.col("cells"))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 78


def test_only_the_first_rows_are_judged(spark):
    rows = [("a", i, ["Page"] if i < 12 else ["x"]) for i in range(30)]
    df = spark.createDataFrame(rows, "_src_path string, _row_ord int, cells array<string>")
    kept = clean.drop_service_rows(df.withColumn("cells", F.array(F.lit(" Page 2"))), F.col("cells"), limit=10)
    assert sorted(r._row_ord for r in kept.collect()) == list(range(10, 30))


def _flights(spark, durations):
    at = datetime(2024, 1, 1)
    values = {"flight_id": "F", "start_time_utc": at, "end_time_utc": at, "region_code": "R", "superseded": False}
    schema = "flight_id string, start_time_utc timestamp_ntz, end_time_utc timestamp_ntz, duration_minutes double, region_code string, superseded boolean"
    rows = [(values["flight_id"] + str(i // 2), at, at, float(d), "R", False) for i, d in enumerate(durations)]
    df = spark.createDataFrame(rows, schema)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in CANONICAL])


def test_fence_and_repeated_keys_are_computed_once(spark):
    df = _flights(spark, [10, 10, 11, 12, 11, 10, 900])
    checks = [quality.UniquenessCheck(), quality.DurationOutlierCheck()]
    results, found = quality.check_results(df, checks), quality.violations(df, checks)
    for frame in (results, found):
        # No grouping of the flights is left in the plans.
        assert "percentile_approx" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert {r.check_name: r.violation_count for r in results.collect()} == {"uniqueness": 6, "duration_outliers": 1}
    assert found.groupBy("check_name").count().count() == 2
