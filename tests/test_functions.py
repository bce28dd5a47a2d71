import uuid
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.functions.ids import uuid5_url
from skyledger.functions.text import blank_to_null, header_key, header_target, strip, to_number
from skyledger.functions.times import known_zone, offset_text, parse_utc, whole_minutes, zulu_text
from skyledger.operators.quantiles import exact_quantiles, iqr_fence

TIMES = {
    "2024-01-15T06:45:00Z": "2024-01-15 06:45:00",
    "2024-01-15T06:45:00+03:00": "2024-01-15 03:45:00",
    "2024-01-15T06:45:00+0300": "2024-01-15 03:45:00",
    "2024-01-15 06:45:00.123456-02": "2024-01-15 08:45:00.123456",
    "2024-01-15 06:45:00 UTC": "2024-01-15 06:45:00",
    "20240115T064500Z": "2024-01-15 06:45:00",
    " 2024-01-15T06:45:00Z ": "2024-01-15 06:45:00",
    "2024-03-10 02:30": "2024-03-10 02:30:00",
    "10.03.2024 02:30": "2024-10-03 02:30:00",
    "15.01.2024": "2024-01-15 00:00:00",
    "01/15/2024 6:45 PM": "2024-01-15 18:45:00",
    "01/15/2024, 12:05 AM": "2024-01-15 00:05:00",
    "15 Jan 2024 06:45": "2024-01-15 06:45:00",
    "January 5, 2024": "2024-01-05 00:00:00",
    "2024/01/15 7:05": "2024-01-15 07:05:00",
    "202401150645": "2024-01-15 06:45:00",
    "2024-015": "2024-01-15 00:00:00",
    "2024-W03-1": "2024-01-15 00:00:00",
    "2020W537T10:00": "2021-01-03 10:00:00",
    "2024-01-01T10:00:00,5Z": "2024-01-01 10:00:00.5",
    "2024": None,
    "2024-01": None,
    "12:30": None,
    "garbage": None,
    "2024-13-45": None,
    "2024-01-15 10:00 Europe/Moscow": None,
    "5 Foo 2024": None,
    "": None,
    None: None,
}


def test_times_do_not_depend_on_the_session_zone(spark, any_zone):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    got = {r.t: r.u for r in df.select("t", parse_utc(F.col("t")).cast("string").alias("u")).collect()}
    assert got == TIMES


def test_zone_of_the_file(spark, any_zone):
    rows = [("Europe/Moscow", "09:00"), ("+05:30", "06:30"), ("Japan", "03:00"), ("Turkey", "09:00"), ("EST5EDT", "17:00"), ("Mars/Base", "12:00"), (None, "12:00")]
    df = spark.createDataFrame([(z, "2024-01-01 12:00") for z, _ in rows], "z string, t string")
    zone = F.coalesce(known_zone("z"), F.lit("UTC"))
    got = df.select("z", parse_utc(F.col("t"), zone).cast("string").alias("u")).collect()
    assert {(r.z, r.u[11:16]) for r in got} == set(rows)
    explicit = df.select(parse_utc(F.lit("2024-01-01T12:00Z"), F.lit("Europe/Moscow")).cast("string").alias("u"))
    assert {r.u for r in explicit.collect()} == {"2024-01-01 12:00:00"}


def test_minutes_and_texts(spark, any_zone):
    df = spark.createDataFrame(
        [(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30, 59, 500000))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    row = df.select(
        whole_minutes(F.col("a"), F.col("b")).alias("up"),
        whole_minutes(F.col("b"), F.col("a")).alias("down"),
        offset_text(F.col("a")).alias("plain"),
        offset_text(F.col("b")).alias("fraction"),
        zulu_text(F.col("b")).alias("z"),
    ).first()
    assert (row.up, row.down) == (120, -120)
    assert row.plain == "2024-03-10 01:30:00+00:00"
    assert row.fraction == "2024-03-10 03:30:59.500000+00:00"
    assert row.z == "2024-03-10T03:30:59Z"


def test_numbers(spark):
    cases = {"1,5": 1.5, " 7 ": 7.0, "-.5": -0.5, "1e3": 1000.0, "45d": None, "NaN": None, "Infinity": None,
             "": None, "e": None, "1.2.3": None, None: None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.n for r in df.select("t", to_number(F.col("t")).alias("n")).collect()} == cases


def test_text(spark):
    df = spark.createDataFrame([("  a b\t",), (" NULL ",), ("null",), (" ",)], "t string")
    rows = df.select(strip(F.col("t")).alias("s"), blank_to_null(F.col("t")).alias("n")).collect()
    assert [tuple(r) for r in rows] == [("a b", "a b"), ("NULL", None), ("null", None), ("", None)]


def test_headers(spark):
    for target, aliases in schema.ALIASES.items():
        for alias in aliases:
            assert schema.target_of(alias) == target
    texts = ["Номер полета", "Duration (min)", " Flight-ID ", "Время начала", "unknown", "Тип БПЛА", "__x--y__"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", header_key(F.col("t")).alias("k"), header_target(F.col("t")).alias("target")).collect()
    assert [r.k for r in rows] == [schema.header_name(t) for t in texts]
    assert [r.target for r in rows] == [schema.target_of(t) for t in texts]
    assert schema.target_of("Время начала") == "start_time"
    assert schema.unique_names(["a", "a", "a_1", "a", "b"]) == ["a", "a_1", "a_1_1", "a_2", "b"]


def test_uuid5_equals_python(spark):
    names = ["", "a", "2024-01-01 09:00:00+00:00|2024-01-01 09:45:00+00:00|Москва"] + [f"n{i}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for r in df.select("n", uuid5_url(F.col("n")).alias("u")).collect():
        assert r.u == str(uuid.uuid5(uuid.NAMESPACE_URL, r.n))


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_are_exact(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.normal(50, 20, 3001), np.full(1500 * (seed + 1), 42.0), rng.integers(0, 9, 800)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.9, "f": 1.0}
    got = exact_quantiles(df, "v", probs, buckets=16).first()
    assert [got[k] for k in probs] == pytest.approx([np.quantile(values, p) for p in probs.values()], abs=1e-12)


def test_quantiles_of_few_or_no_values(spark):
    one = spark.createDataFrame([(5.0,)], "v double")
    assert iqr_fence(one, "v").first().asDict() == {"q1": 5.0, "q3": 5.0, "lower": 5.0, "upper": 5.0}
    none = spark.createDataFrame([(None,)], "v double")
    assert iqr_fence(none, "v").first().lower is None


def test_numbers_are_finite(spark):
    df = spark.createDataFrame([("1e400",), ("-1e400",), ("1,5",), ("1e3",)], "t string")
    assert [r.n for r in df.select(to_number(F.col("t")).alias("n")).collect()] == [None, None, 1.5, 1000.0]


def test_every_accepted_zone_is_known_to_the_jvm(spark):
    from zoneinfo import available_timezones

    zones = spark.createDataFrame([(z,) for z in available_timezones()], "z string")
    local = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    got = zones.select("z", F.convert_timezone(known_zone("z"), F.lit("UTC"), local).alias("t")).collect()
    assert {r.z for r in got if r.t is None} <= {"Factory", "GMT+0", "GMT-0", "ROC", "localtime"}
