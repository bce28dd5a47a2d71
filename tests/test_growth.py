"""Files, batches and shuffles that must not grow faster than the rows."""

import glob
from datetime import datetime
from html.parser import HTMLParser

import pytest
from rows import plan_of

from skyledger.plans import filequeries, jobs, queries
from skyledger.sources import html, quoted, textsalvage


@pytest.fixture
def small(spark, tmp_path, monkeypatch):
    """Tables of 120 orders by 60 customers, and 40 suppliers; scratch folders below tmp_path."""
    d = str(tmp_path / "tables")
    day = datetime(1995, 3, 1)
    orders = [(k, k % 60, "O", 1.0, day, "5-LOW") for k in range(1, 121)]
    kinds = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, kinds).write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(k, f"C{k}", k % 25, "M") for k in range(60)], "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(f"S{k}",) for k in range(40)], "s_name string").coalesce(1).write.parquet(f"{d}/supplier.parquet")
    for module in (filequeries, queries):
        monkeypatch.setattr(module, "scratch_path", lambda spark, name: str(tmp_path / name))
    return d


def test_pages_hold_many_rows(spark, small, tmp_path):
    rows = filequeries.QUERIES["mixed_sources"](spark, small).collect()
    assert sorted(r.flight_id for r in rows) == sorted(f"F-{k}" for k in range(1, 121))
    # At most a file per task, not one per customer.
    assert len(glob.glob(f"{tmp_path}/mixed/c/*.htm")) <= spark.sparkContext.defaultParallelism


def test_names_are_written_by_several_tasks(spark, small, tmp_path):
    sums = [r.checksum for r in filequeries.QUERIES["source_checksums"](spark, small).collect()]
    assert len(sums) == len(set(sums)) == 41
    names = glob.glob(f"{tmp_path}/sums/part-*")
    assert len(names) == 40 and len({n.split("part-")[1][:5] for n in names}) > 1


def test_workbooks_hold_many_rows(spark, small, monkeypatch):
    books = []
    inner = filequeries.workbook.workbook_rows
    monkeypatch.setattr(filequeries.workbook, "workbook_rows", lambda b: books.append(b.count()) or inner(b))
    rows = filequeries.QUERIES["workbook_scan"](spark, small).collect()
    assert {(r.flight_id, r.region_code) for r in rows} == {(f"F-{k}", f"R{k % 60 % 25}") for k in range(1, 121)}
    assert books[0] <= spark.sparkContext.defaultParallelism


def test_lines_of_a_large_source_stay_where_they_are_read(spark):
    lines = spark.createDataFrame([("a", 0, "Flight No;Start"), ("a", 1, "F1;2024"), ("b", 0, "x"), ("a", 2, "F2")], "_src_path string, _row_ord int, value string")
    cells = textsalvage.salvage(lines)
    assert [r.cells for r in cells.collect()] == [["F1", "2024"]]
    assert "SortMergeJoin" not in plan_of(cells) and "BroadcastHashJoin" in plan_of(cells)
    rejects = textsalvage.salvage_rejects(lines)
    assert {(r._src_path, r.reason) for r in rejects.collect()} == {("b", "no header")}
    assert "SortMergeJoin" not in plan_of(rejects)


def test_deliveries_have_a_fixed_number_of_files(spark, small, tmp_path):
    parts = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "24"}
    was = {k: spark.conf.get(k) for k in parts}
    for k, v in parts.items():
        spark.conf.set(k, v)
    try:
        reports = queries.adapters.flight_reports(spark, small)
        queries._deliver(reports, str(tmp_path / "landing"))
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{tmp_path}/landing/*.parquet")) <= 2 * queries.DELIVERED_FILES
    assert spark.read.parquet(str(tmp_path / "landing")).count() == 122


PAGES = [
    '<!DOCTYPE html><meta name=report-tz content="+03:00"><table><tr><th>A<td>x &amp; y</th></tr><tr><td><a HREF=\'u\'>1</a></td><td/></table>',
    "<table><tr><td>1<!-- n --></td></tr><tr><td><br/>2 <a href=u>3</a><script>'<td>'</script></table>",
    '<table><tr><td>a<b c="<td>">d</b></tr></table x><table><tr><td>decoy',
    "<table><tr><td>open &am",
    "<table><tr><td a = b>1</td ><td>< 2",
]


@pytest.mark.parametrize("page", PAGES)
def test_simple_tags_give_what_the_parser_gives(page):
    parsed, cut = html._FirstTable(), html._FirstTable()
    parsed.feed(page)
    parsed.close()
    html._feed(cut, page)
    for p in (parsed, cut):
        p._end_row()
    assert (cut.tz, cut.seen, cut.rows) == (parsed.tz, parsed.seen, parsed.rows)


def test_simple_pages_are_not_parsed(monkeypatch):
    monkeypatch.setattr(HTMLParser, "feed", lambda *_: pytest.fail("parsed"))
    assert html.first_table(PAGES[0])[0] == "+03:00"


def test_records_are_cut_once(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('x,y\n1,"a\nb"\n2,c\n')
    found = quoted.read_records(spark, [str(path)])
    assert sorted(r.record for r in found.collect()) == ['1,"a\nb"', "2,c", "x,y"]
    assert "MapInArrow" not in plan_of(found)


def test_ingest_types_rows_once(spark, tmp_path, monkeypatch):
    (tmp_path / "in.csv").write_text("flight_id,start_time,end_time\nF1,2024-01-01T00:00:00Z,2024-01-01T01:00:00Z\nF2,x,y\n")
    calls = []
    typed = jobs.type_rows
    monkeypatch.setattr("skyledger.operators.normalize.type_rows", lambda *a, **k: calls.append(1) or typed(*a, **k))
    monkeypatch.setattr(jobs, "type_rows", lambda *a, **k: calls.append(1) or typed(*a, **k))
    _, counters = jobs.ingest(spark, str(tmp_path / "in.csv"), str(tmp_path / "lake"), "v1")
    assert (counters.first().raw, counters.first().invalid, len(calls)) == (2, 1, 1)
