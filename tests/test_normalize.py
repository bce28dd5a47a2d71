from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import flights, plan_of, raw

from skyledger.operators import normalize as n
from skyledger.schema import CANONICAL, FLIGHT_SCHEMA


def four_rows(spark):
    base = {"region_code": "RU-MOW", "region_name": "Москва", "latitude": "55.75", "longitude": "37.61"}
    return raw(
        spark,
        [
            base | {"flight_id": "A1", "start_time": "2024-01-01 10:00", "end_time": "2024-01-01 11:00", "latitude": "55,75"},
            base | {"flight_id": "A1", "start_time": "2024-01-01 10:00", "end_time": "2024-01-01 11:30", "duration_minutes": "90"},
            base | {"region_code": None, "start_time": "2024-01-01 12:00", "end_time": "2024-01-01 12:45", "duration_minutes": ""},
            base | {"flight_id": "A2", "start_time": "2024-01-01 14:00", "end_time": "2024-01-01 14:30",
                    "duration_minutes": "30", "latitude": "95"},
        ],
    )


def test_zone_durations_surrogates_supersession(spark, any_zone):
    df = four_rows(spark)
    out = n.normalize(df, tz_hint="Europe/Moscow")
    assert out.drop("_row_ord").columns == list(CANONICAL)
    assert [f.dataType for f in out.select(*CANONICAL).schema] == [f.dataType for f in FLIGHT_SCHEMA]
    rows = out.orderBy("_row_ord").collect()
    assert [r.duration_minutes for r in rows] == [60.0, 90.0, 45.0]
    assert [r.superseded for r in rows] == [True, False, False]
    assert rows[0].start_time_utc == datetime(2024, 1, 1, 7)
    assert rows[2].flight_id == rows[2].surrogate_id == "9cc0d476-d0c5-558f-9e67-0348ed995fd1"
    assert rows[0].surrogate_id is None
    assert all(r.latitude == 55.75 for r in rows)
    counts = n.ingest_counters(df, tz_hint="Europe/Moscow").first().asDict()
    assert counts == {"raw": 4, "normalized": 3, "valid": 2, "invalid": 1, "duplicates": 1}


def test_rejected_rows_name_their_reasons(spark):
    day = {"start_time": "2024-01-01 10:00", "end_time": "2024-01-01 11:00"}
    df = raw(
        spark,
        [
            day | {"flight_id": "ok"},
            day | {"flight_id": "late", "end_time": "2024-01-01 09:00"},
            day | {"flight_id": "both", "latitude": "91", "longitude": "-180,5"},
            {"flight_id": "none", "start_time": "soon"},
            day | {"flight_id": "edge", "latitude": "-90", "longitude": "180"},
        ],
    )
    reasons = {r.flight_id: r.reasons for r in n.rejected(df).collect()}
    assert reasons == {
        "late": "end_before_start",
        "both": "latitude_range,longitude_range",
        "none": "start_time,end_time",
    }


def test_last_row_wins_by_ingest_time_then_order(spark):
    r = {"flight_id": "A", "start_time": "2024-01-01T10:00:00.1Z", "end_time": "2024-01-01T11:00Z"}
    df = raw(
        spark,
        [
            r | {"ingested_at": 2, "payload_type": "first of 2"},
            r | {"ingested_at": 2, "payload_type": "last"},
            r | {"ingested_at": 1, "payload_type": "old", "start_time": "2024-01-01T10:00:00.9Z"},
            r | {"ingested_at": 1, "payload_type": "other region", "region_code": "X"},
        ],
    )
    kept = n.normalize(df).where("NOT superseded").collect()
    assert {k.payload_type for k in kept} == {"last", "other region"}


def test_reissue_without_id_and_new_end_is_another_flight(spark):
    r = {"start_time": "2024-01-01T10:00Z", "end_time": "2024-01-01T11:00Z", "region_code": "X"}
    df = raw(spark, [r, r | {"end_time": "2024-01-01T12:00Z"}, r])
    rows = n.normalize(df).orderBy("_row_ord").collect()
    assert [x.superseded for x in rows] == [True, False, False]
    assert rows[0].flight_id == rows[2].flight_id != rows[1].flight_id


def test_leading_zeros_and_missing_columns(spark):
    df = raw(spark, [{"flight_id": " 007 ", "start_time": "2024-01-01", "end_time": "2024-01-02"}])
    row = n.normalize(df).first()
    assert (row.flight_id, row.duration_minutes, row.region_code, row.latitude) == ("007", 1440.0, None, None)


def test_hot_key_and_partitioning_do_not_change_the_result(spark):
    r = {"flight_id": "HOT", "start_time": "2024-01-01T10:00Z", "end_time": "2024-01-01T11:00Z"}
    rows = [dict(r) for _ in range(300)]
    rows += [r | {"flight_id": f"F{i}"} for i in range(600)]
    df = raw(spark, rows)
    key = F.col("_row_ord")
    want = {x._row_ord for x in n.normalize(df).where("superseded").collect()}
    assert want == set(range(299))
    shuffled = df.repartition(7, F.xxhash64(key))
    assert {x._row_ord for x in n.normalize(shuffled).where("superseded").collect()} == want


def test_plan_has_no_python_window_or_nested_loop(spark):
    plan = plan_of(n.normalize(four_rows(spark)))
    for bad in ("Python", "Window", "NestedLoop", "CartesianProduct"):
        assert bad not in plan


def test_year_inference(spark):
    def at(*years):
        return flights(spark, [{"flight_id": str(y), "start_time_utc": datetime(y, 1, 1)} for y in years])

    assert n.infer_year(at(2024, 2024)) == 2024
    assert n.infer_year(at()) is None
    with pytest.raises(ValueError):
        n.infer_year(at(2023, 2024))


def test_metric_rows_and_duration_mismatch(spark):
    start = datetime(2024, 1, 1)
    df = flights(
        spark,
        [{"flight_id": str(m), "start_time_utc": start, "duration_minutes": m} for m in (0.0, -1.0, 1440.0, 1440.5, 1.005)]
        + [{"flight_id": "s", "start_time_utc": start, "duration_minutes": 5.0, "superseded": True}]
        + [{"flight_id": "y", "start_time_utc": datetime(2023, 1, 1), "duration_minutes": 5.0}],
    )
    assert {r.flight_id for r in n.metric_rows(df, 2024).collect()} == {"1440.0", "1.005"}
    day = {"start_time": "2024-01-01 10:00", "end_time": "2024-01-01 11:00"}
    given = raw(spark, [day | {"flight_id": "a", "duration_minutes": "61"}, day | {"flight_id": "b", "duration_minutes": "61,5"}])
    assert [r.flight_id for r in n.duration_mismatch(given).collect()] == ["b"]
