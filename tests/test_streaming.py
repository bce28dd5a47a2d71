from datetime import datetime

from pyspark.sql import functions as F
from rows import raw

from skyledger.operators import aggregates, quality
from skyledger.operators.normalize import metric_rows, normalize
from skyledger.plans import adapters
from skyledger.streaming import incremental, live

CHECKS = [quality.SchemaCheck()]


def day(i, month=1, end=11, **more):
    return {"flight_id": f"F{i}", "start_time": f"2024-{month:02d}-01 10:00", "end_time": f"2024-{month:02d}-01 {end}:00",
            "region_code": "A", **more}


def deliver(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def run(spark, landing, root, schema, checks=CHECKS):
    tables = incremental.Tables(f"{root}/tables")
    source = incremental.watch(spark, landing, schema, files_per_batch=1)
    incremental.ingest_stream(source, tables, f"{root}/checkpoint", checks).awaitTermination()
    return tables


def test_stream_equals_batch_also_after_a_restart(spark, tmp_path):
    landing = str(tmp_path / "in")
    first = raw(spark, [day(i, month=1 + i % 3) for i in range(9)] + [day(20, end="09"), {"flight_id": "bad"}])
    second = raw(spark, [day(0, end=12), day(1, month=2, end=13), day(30, month=5)])
    deliver(first, landing)
    tables = run(spark, landing, tmp_path, first.schema)
    deliver(second, landing)
    run(spark, landing, tmp_path, first.schema)

    both = first.withColumn("ingested_at", F.lit(0)).unionByName(second.withColumn("ingested_at", F.lit(1)))
    want = normalize(both)
    got = spark.read.parquet(tables.flights)
    cols = ["flight_id", "start_time_utc", "end_time_utc", "superseded"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    years = aggregates.aggregates_year(metric_rows(want)).collect()
    stored = spark.read.parquet(tables.aggregates).select(*aggregates.aggregates_year(metric_rows(want)).columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, years))
    assert spark.read.parquet(tables.rejected).count() == 2
    events = [r.event for r in spark.read.parquet(tables.events).orderBy("batch_id", "event").collect()]
    assert events == ["aggregates.built", "dataset.ingested", "dataset.validated", "insights.ready"] * 2


def test_late_original_does_not_win_over_a_newer_delivery(spark, tmp_path):
    landing = str(tmp_path / "in")
    a, b = raw(spark, [day(0, end=12)]), raw(spark, [day(1), day(0, end=13)])
    deliver(a, landing)
    tables = run(spark, landing, tmp_path, a.schema)
    deliver(b, landing)
    run(spark, landing, tmp_path, a.schema)
    kept = spark.read.parquet(tables.flights).where("NOT superseded AND flight_id = 'F0'").collect()
    assert [r.end_time_utc for r in kept] == [datetime(2024, 1, 1, 13)]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    tables = incremental.Tables(str(tmp_path / "t"))
    batch = raw(spark, [day(0), day(1)])
    incremental.process_batch(batch, 0, tables, CHECKS)
    once = sorted(map(str, spark.read.parquet(tables.flights).collect()))
    incremental.process_batch(batch, 0, tables, CHECKS)
    assert sorted(map(str, spark.read.parquet(tables.flights).collect())) == once
    assert spark.read.parquet(tables.reports).count() == 2


def test_failed_quality_stops_the_batch(spark, tmp_path):
    tables = incremental.Tables(str(tmp_path / "t"))
    incremental.process_batch(raw(spark, [day(0), day(1, duration_minutes="9999")]), 0, tables,
                              [quality.DurationRangeCheck()])
    assert not (tmp_path / "t" / "flights").exists()
    assert spark.read.parquet(f"{tables.root}/quarantine").count() == 2
    events = {r.event: r.payload.quality_status for r in spark.read.parquet(tables.events).collect()}
    assert events == {"dataset.ingested": "OK", "dataset.validated": "FAIL"}


def test_files_of_several_formats_arrive(spark, tmp_path):
    landing = tmp_path / "in"
    (landing / "a").mkdir(parents=True)
    tables = incremental.Tables(str(tmp_path / "t"))
    when = "2024-01-0{}T10:00:00Z,2024-01-0{}T11:00:00Z"
    (landing / "a" / "x.csv").write_text(f"flight_id,start,end\nA,{when.format(1, 1)}\n")
    (landing / "y.html").write_text("<table><tr><th>flight</th><th>start</th><th>end</th></tr><tr><td>B</td><td>2024-01-02</td><td>2024-01-03</td></tr></table>")
    for _ in range(2):
        names = incremental.watch_files(spark, str(landing))
        incremental.ingest_files(names, tables, str(tmp_path / "cp"), CHECKS).awaitTermination()
        (landing / "z.csv").write_text(f"flight_id,start,end\nA,2024-01-01T10:00:00Z,2024-01-01T12:00:00Z\n")
    got = {(r.flight_id, r.end_time_utc.hour, r.superseded) for r in spark.read.parquet(tables.flights).collect()}
    assert got == {("A", 11, True), ("A", 12, False), ("B", 0, False)}


def test_batch_without_a_valid_row_is_on_record(spark, tmp_path):
    tables = incremental.Tables(str(tmp_path / "t"))
    incremental.process_batch(raw(spark, [{"flight_id": "bad"}]), 3, tables, CHECKS)
    events = {(r.event, r.payload.records, r.payload.quality_status) for r in spark.read.parquet(tables.events).collect()}
    assert events == {("dataset.ingested", 0, "FAIL"), ("dataset.validated", 0, "FAIL")}
    assert [r.status for r in spark.read.parquet(tables.quality).collect()] == ["FAIL"]
    assert spark.read.parquet(tables.rejected).count() == 1


def test_recompute_reads_touched_months_only(spark, tmp_path):
    tables = incremental.Tables(str(tmp_path / "t"))
    incremental.process_batch(raw(spark, [day(i, month=1 + i % 5) for i in range(10)]), 0, tables, CHECKS)
    found = incremental.touched_months(spark.read.parquet(tables.reports), [(2024, 2), (1, 1)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(found.inputFiles()) > 1 and found.count() == 2
    assert {r.month for r in found.collect()} == {2}


def test_late_rows_count(spark, tmp_path):
    schema = "start_time_utc timestamp, region_code string, duration_minutes double"
    landing = str(tmp_path / "in")
    for when in ("2024-06-01 10:00:00", "2020-01-01 10:00:00", "2024-06-01 11:00:00"):
        spark.createDataFrame([(when, "R", 2.0)], "t string, region_code string, duration_minutes double").select(
            F.col("t").cast("timestamp").alias("start_time_utc"), "region_code", "duration_minutes"
        ).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        live.write_counts(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = live.totals(spark.read.parquet(f"{tmp_path}/out")).collect()
    assert sorted((str(r.window_start)[:10], r.flights_count, float(r.duration_sum_min)) for r in got) == [
        ("2020-01-01", 1, 2.0), ("2024-06-01", 2, 4.0)]


def test_live_counts_equal_batch(spark, tmp_path, any_zone):
    d = "/root/testdata/sf0.001"
    events = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).parquet(f"{d}/event[s].parquet")
    instant = F.to_timestamp(F.concat(F.col("start_time_utc").cast("string"), F.lit("+00:00")))
    flights = adapters.from_events(events).withColumn("start_time_utc", instant)
    live.write_counts(flights, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = {(r.s // 86400, r.region_code): r.flights_count
           for r in live.totals(spark.read.parquet(f"{tmp_path}/out")).withColumn("s", F.unix_seconds("window_start")).collect()}
    batch = adapters.event_flights(spark, d).groupBy(F.datediff(F.to_date("start_time_utc"), F.lit("1970-01-01").cast("date")).alias("d"), "region_code").count()
    assert got == {(r.d, r.region_code): r["count"] for r in batch.collect()}
