"""Growth of geo_job, round 4: scans that are read once, keys that are counted by hash, compiled row code."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import plan_of

from skyledger.functions.text import WHITESPACE, blank_to_null, strip, strip_cell
from skyledger.operators import clean, normalize, quality
from skyledger.operators.quantiles import exact_quantiles
from skyledger.plans import jobs
from skyledger.plans.staging import staged


def named(spark, rows):
    schema = "flight_id string, duration_minutes string, _src_path string, _row_ord struct<block:int,line:int>"
    return spark.createDataFrame([(a, d, p, (0, n)) for n, (a, d, p) in enumerate(rows)], schema)


def test_a_named_scan_is_read_once(spark):
    rows = [(" Page 1 ", None, "a"), (None, " ", "a"), (" F1 ", "1,5", "a"), ("Source: x", None, "a"), ("F2", "2", "b"), ("Страница 3", None, "b")]
    rows += [("generated", str(i), "c") for i in range(13)] + [("homepage ", "3", None), ("Page 1", None, None)]
    kept = clean.sanitize(named(spark, rows))
    plan = plan_of(kept)
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan and "LocalTableScan" not in plan
    got = sorted((r._row_ord.line, r.flight_id, r.duration_minutes) for r in kept.collect())
    assert got == [
        (2, "F1", "1.5"), (3, "Source: x", None), (4, "F2", "2"), (5, "Страница 3", None),
        *[(i, "generated", str(i - 6)) for i in range(16, 19)], (19, "homepage", "3"), (20, "Page 1", None),
    ]
    assert sorted(kept.columns) == ["_row_ord", "_src_path", "duration_minutes", "flight_id"]


def test_rows_are_ranked_by_judgement_as_by_cells(spark):
    marks = ["Page 1", "", "x", "generated on", " source: y", "page", None]
    rows = [(marks[(i * i + i // 9) % 7], marks[(i * 5) % 7], f"s{i % 17}") for i in range(400)]
    df = clean.trim_strings(named(spark, rows))
    for limit in (1, 3, 10):
        by_cells = clean.drop_service_rows(df, clean.raw_cells(df), limit)
        judged = staged(df.withColumn("_service", clean.is_service_row(clean.raw_cells(df))), "rows")
        by_judgement = clean.drop_service_rows(judged, None, limit)
        assert sorted(map(str, by_cells.collect())) == sorted(map(str, by_judgement.collect()))


CELLS = ["", " ", "a", " a", "a ", "\ta\n", "Москва", " Москва　", "\xa0x", "x\xa0", "~", "!", "\x7f", "null", " NULL ", "é", "aé", "éa", "-", '"', None, *WHITESPACE]


def test_cells_are_stripped_as_texts_are(spark):
    df = spark.createDataFrame([(c,) for c in CELLS], "c string")
    c = F.col("c")
    rows = df.select("c", strip(c).alias("a"), strip_cell(c).alias("b"), blank_to_null(c).alias("n")).collect()
    assert [r.b for r in rows] == [r.a for r in rows] == [None if c is None else c.strip() for c in CELLS]
    assert [r.n for r in rows] == [None if r.a in ("", "null", "NULL", None) else r.a for r in rows]


def test_wide_rows_are_compiled_in_parts(spark):
    wide = spark.range(1).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(90)])
    path = staged(wide, "wide")
    plan = clean.trim_strings(path)._jdf.queryExecution().executedPlan()
    code = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(plan)
    # The JVM leaves larger methods to its interpreter.
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_values_are_counted_before_their_range_is_looked_up(spark):
    df = spark.createDataFrame([(float(i % 7),) for i in range(100)] + [(None,)], "v double")
    found = exact_quantiles(df, "v", {"q1": 0.25, "q3": 0.75})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if re.search(r"\bFilter\b", line) and "lambdafunction" in line]
    assert found.first().asDict() == {"q1": 1.0, "q3": 5.0}
    assert exact_quantiles(df.where("v > 9"), "v", {"q": 0.5}).first().q is None


def typed_rows(spark):
    at = datetime(2024, 1, 1, 10, 0, 30)
    rows = [
        ("A", at, "R", 1), ("A", at.replace(microsecond=500_000), "R", 2), ("A", at.replace(second=31), "R", 3),
        ("A", at, None, 4), ("A", at, "", 5), ("B", at, "R", 6), ("B", at.replace(minute=1), "R", 7),
        ("C", None, "R", 8), ("C", None, "R", 9), *[("H", at, "R", 10 + i) for i in range(50)],
    ]
    schema = "flight_id string, start_time_utc timestamp_ntz, region_code string, _row_ord int"
    df = spark.createDataFrame(rows, schema).withColumns({"end_time_utc": F.col("start_time_utc"), "latitude": F.lit(1.0), "longitude": F.lit(1.0)})
    return staged(df, "typed")


def test_keys_counted_by_hash_supersede_the_same_rows(spark):
    typed = typed_rows(spark)
    valid = typed.where(normalize.is_valid())
    repeated = normalize.written_repeated_keys(valid)
    assert sorted((r._key_id, r._copies, r._last._row_ord) for r in repeated.collect()) == [("A", 2, 2), ("A", 2, 5), ("H", 50, 59)]
    flagged = normalize.flag_superseded(valid, repeated)
    assert "SortMergeJoin" not in plan_of(flagged)
    superseded = {r._row_ord for r in flagged.where("superseded").collect()}
    assert superseded == {r._row_ord for r in normalize.flag_superseded(valid).where("superseded").collect()} == {1, 4, *range(10, 59)}
    counted = normalize.typed_counters(typed, repeated)
    assert counted.first() == normalize.typed_counters(typed).first()
    assert counted.first().asDict() == {"raw": 59, "normalized": 57, "valid": 6, "invalid": 2, "duplicates": 51}
    empty = typed.where("false")
    none = normalize.typed_counters(empty, normalize.written_repeated_keys(empty)).first()
    assert none == normalize.typed_counters(empty).first()


def test_unique_keys_are_not_grouped(spark, monkeypatch):
    rows = [(f"F{i // 2 if i < 6 else i}", None if i < 4 else "R") for i in range(40)] + [(None, None)] * 3
    df = staged(spark.createDataFrame(rows, "flight_id string, region_code string"), "flights")
    read = []
    monkeypatch.setattr(quality, "staged", lambda d, name: read.append((name, staged(d, name))) or read[-1][1])
    check = quality.UniquenessCheck(("flight_id", "region_code"))
    assert check.result(df).first().violation_count == 9
    assert check.violations(df).count() == 6 + 3
    assert [(name, d.count()) for name, d in read] == [("hashes", 4), ("repeated_keys", 4)]


@pytest.mark.parametrize("name", ["in.csv", "in.html"])
def test_ingest_reads_written_rows(spark, tmp_path, monkeypatch, name):
    if name == "in.csv":
        text = "flight_id,start_time,end_time\nPage 1,,\nF1,2024-01-01T00:00:00Z,2024-01-01T01:00:00Z\nF1,2024-01-01T00:00:00Z,2024-01-01T02:00:00Z\n"
    else:
        text = "<table><tr><th>flight_id</th><th>start_time</th><th>end_time</th></tr><tr><td>F1</td><td>2024-01-01T00:00:00Z</td><td>2024-01-01T01:00:00Z</td></tr></table>"
    (tmp_path / name).write_text(text)
    plans = []
    inner = jobs.type_rows
    monkeypatch.setattr(jobs, "type_rows", lambda raw, **k: plans.append(plan_of(raw)) or inner(raw, **k))
    _, counters = jobs.ingest(spark, str(tmp_path / name), str(tmp_path / "lake"), "v1")
    # Neither the CSV reader nor the parser of pages is behind the rows that are typed, stored and reviewed.
    assert "FileScan parquet" in plans[0] and "FileScan csv" not in plans[0] and "InArrow" not in plans[0]
    got = counters.first()
    assert (got.raw, got.duplicates) == ((2, 1) if name == "in.csv" else (1, 0))
