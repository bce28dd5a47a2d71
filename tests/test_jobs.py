import glob
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from rows import SAMPLE_CSV, flights, write

from skyledger.operators import aggregates, geo, quality, sinks, versions
from skyledger.plans import jobs, staging
from skyledger.sources.canonical import read_flights


def text_of(path):
    return "".join(open(p, encoding="utf-8").read() for p in glob.glob(f"{path}/part-*"))


def test_ingest_validate_aggregate(spark, tmp_path):
    source, root = write(tmp_path, "a.csv", SAMPLE_CSV), str(tmp_path / "lake")
    _, counters = jobs.ingest(spark, source, root, "v1")
    assert counters.first().asDict() == {"raw": 5, "normalized": 5, "valid": 5, "invalid": 0, "duplicates": 0}
    state = versions.require_version(spark.read.parquet(f"{root}/dataset_version"), "v1").first()
    assert (state.status, state.year) == ("ingested", 2024) and state.ingested_at and not state.validated_at
    lineage = json.loads(text_of(f"{root}/artifacts/2024/v1/lineage.json"))
    assert lineage["counts"]["valid"] == 5
    assert lineage["checksum"] == lineage["source"]["checksum"] == state.checksum
    raw_csv = text_of(f"{root}/artifacts/2024/v1/raw.csv").splitlines()
    assert len(raw_csv) == 6 and raw_csv[0].startswith("flight_id,start_time")
    staged = spark.read.parquet(f"{root}/flights_raw")
    payload = json.loads(staged.orderBy("flight_external_id").first().payload)
    assert payload["start_time_utc"] == "2024-01-15T06:45:00+00:00" and payload["surrogate_id"] is None
    norm = spark.read.parquet(f"{root}/flights_norm")
    assert dict(norm.dtypes)["duration_minutes"] == "decimal(10,2)" and norm.count() == 5

    _, summary = jobs.validate(spark, root, "v1")
    assert summary.first().quality_status == "validated"
    state = versions.current_status(spark.read.parquet(f"{root}/dataset_version")).first()
    assert (state.status, state.warn_count, state.fail_count, state.checksum) == ("validated", 0, 0, lineage["checksum"])
    assert sinks.read_version(spark, f"{root}/flight_quality_issues", "v1").count() == 0
    report = json.loads(text_of(f"{root}/artifacts/quality/v1/report.json"))
    assert report["dataset_version"] == "v1" and len(report["checks"]) == 7
    short = json.loads(text_of(f"{root}/artifacts/quality/v1/quality_violations.json"))
    assert short == {"warn_count": 0, "fail_count": 0, "total": 0, "quality_status": "validated"}

    assert jobs.build_aggregates(spark, root, "v1", 2024).count() == 4
    table = spark.read.parquet(f"{root}/aggregates_year")
    sinks.export(table, f"{root}/export_csv")
    sinks.export(table, f"{root}/export_json", "json")
    assert spark.read.option("header", True).csv(f"{root}/export_csv").count() == 4
    assert spark.read.json(f"{root}/export_json").count() == 4


def test_versions_keep_apart_and_are_replaced(spark, tmp_path):
    root = str(tmp_path / "lake")
    one = write(tmp_path, "a.csv", SAMPLE_CSV)
    two = write(tmp_path, "b.csv", "\n".join(SAMPLE_CSV.splitlines()[:3]) + "\n")
    jobs.ingest(spark, one, root, "v1")
    jobs.ingest(spark, two, root, "v2")
    jobs.ingest(spark, two, root, "v2")
    assert read_flights(spark, f"{root}/flights", "v1").count() == 5
    assert read_flights(spark, f"{root}/flights", "v2").count() == 2
    assert read_flights(spark, f"{root}/flights").count() == 7
    with pytest.raises(LookupError):
        jobs.validate(spark, root, "v9")


def test_empty_result_replaces_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "issues")
    df = spark.createDataFrame([("F", "c")], "flight_uid string, check_name string")
    sinks.replace_version(df, path, "v1")
    sinks.replace_version(df, path, "v2")
    sinks.replace_version(df.limit(0), path, "v1")
    assert sinks.read_version(spark, path, "v1").count() == 0
    assert sinks.read_version(spark, path).count() == 1


def test_dry_run_writes_no_table_and_year_must_be_known(spark, tmp_path):
    root = tmp_path / "lake"
    source = write(tmp_path, "a.csv", SAMPLE_CSV)
    flights_, counters = jobs.ingest(spark, source, str(root), "v1", dry_run=True)
    assert flights_.count() == 5 and counters.first().valid == 5 and not root.exists()
    bad = write(tmp_path, "bad.csv", "flight_id,start_time\nA,never\n")
    with pytest.raises(ValueError, match="year"):
        jobs.ingest(spark, bad, str(root), "v1")


def test_slices_and_operational_metrics(spark):
    df = flights(spark, [{"flight_id": "A", "duration_minutes": 0.5}, {"flight_id": "B", "duration_minutes": 5.0}])
    issues = quality.flight_issues(df, [quality.DurationRangeCheck()])
    assert [r.flight_id for r in versions.flights_with_issues(df, issues).collect()] == ["A"]
    assert [r.flight_id for r in versions.flights_without_issues(df, issues).collect()] == ["B"]
    log = versions.status_row(spark, "v", None, "quality_fail", fail_count=1)
    state = log.select("dataset_version", "status")
    placed = df.withColumn("geo_region", F.when(F.col("flight_id") == "A", "R"))
    row = versions.operational_metrics(state, placed).first()
    assert row.asDict() == {"geocoded_ratio": 0.5, "quality_fail_count": 1, "quality_alert": True, "geocoding_alert": True}


def test_region_refresh_replaces(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    def collection(*codes):
        return json.dumps({"features": [{"properties": {"code": c, "name": c}, "geometry": {"type": "Polygon", "coordinates": [ring]}} for c in codes]})
    root = str(tmp_path / "lake")
    assert jobs.load_regions(spark, write(tmp_path, "r.json", collection("77", "78", "78")), root) == 3
    assert jobs.load_regions(spark, write(tmp_path, "s.json", collection("79")), root) == 1
    assert [r.code for r in sinks.read_regions(spark, f"{root}/regions").collect()] == ["79"]
    # A collection that fails half way leaves the table as it was.
    broken = {"features": [*json.loads(collection("80"))["features"], {"properties": {"code": "81", "name": "81"}, "geometry": {"type": "Point", "coordinates": [0, 0]}}]}
    with pytest.raises(Exception, match="no polygon"):
        jobs.load_regions(spark, write(tmp_path, "t.json", json.dumps(broken)), root)
    assert [r.code for r in sinks.read_regions(spark, f"{root}/regions").collect()] == ["79"]


def test_scratch_folder_comes_from_the_session(spark):
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "/shared"}[key]))
    assert staging.scratch_path(named, "x").startswith("/shared/skyledger/x-")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert staging.scratch_path(spark, "x").startswith(base.rstrip("/"))
