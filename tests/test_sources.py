import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F
from rows import SAMPLE_CSV, write

from skyledger.operators import clean, quality
from skyledger.operators.normalize import normalize, type_rows
from skyledger.sources import delimited, html, registry, textsalvage, workbook


def test_csv_sample(spark, tmp_path):
    path = write(tmp_path, "a.csv", SAMPLE_CSV)
    rows = normalize(registry.load_flights(spark, path)).collect()
    assert len(rows) == 5
    assert {r.region_name for r in rows} >= {"Москва", "Краснодарский край"}
    assert sum(r.duration_minutes for r in rows) == 222
    assert registry.checksums(spark, path).first().checksum == hashlib.sha256(SAMPLE_CSV.encode()).hexdigest()


def test_csv_quotes_nulls_service_rows_and_commas(spark, tmp_path):
    text = (
        "Flight No,Start,END,Region Title,Lat,Notes\r\n"
        "Page 1 of 3,,,,,\r\n"
        ",,,,,\r\n"
        '007,2024-01-01T10:00Z,2024-01-01T11:00Z,"Moscow, ""city""","55,75",x\r\n'
        "Page 2,2024-01-01T10:00Z,2024-01-01T11:00Z,NULL,null,y\r\n"
    )
    rows = registry.load_flights(spark, write(tmp_path, "a.csv", text)).orderBy("_row_ord").collect()
    assert [r.flight_id for r in rows] == ["007", "Page 2"]
    assert rows[0].region_name == 'Moscow, "city"'
    assert rows[0].latitude == "55.75"
    assert rows[1].region_name is None and rows[1].latitude is None


def test_csv_files_with_other_header_order(spark, tmp_path):
    write(tmp_path, "a.csv", "id,flight_id,start\n1,A,2024-01-01\n")
    write(tmp_path, "b.csv", "START,Номер полета\n2024-01-02,B\n")
    rows = registry.load_flights(spark, str(tmp_path)).collect()
    assert {(r.flight_id, r.start_time) for r in rows} == {("A", "2024-01-01"), ("B", "2024-01-02")}
    files = sorted(str(p) for p in tmp_path.glob("*.csv"))
    with pytest.raises(ValueError, match="different headers"):
        delimited.scan_delimited(spark, files)
    with pytest.raises(Exception):
        delimited.scan_delimited(spark, files, line_breaks=False).collect()


def test_csv_line_breaks_in_cells(spark, tmp_path):
    broken = write(tmp_path, "a.csv", 'flight_id,notes,start\nA,"two\nlines, ""quoted""",2024-01-01\nB,x,2024-01-02\n')
    plain = write(tmp_path, "b.csv", 'flight_id,notes,start\nC,"x ""y""",2024-01-03\n')
    rows = delimited.scan_delimited(spark, [broken, plain]).collect()
    assert {(r.flight_id, r.notes, r.start) for r in rows} == {
        ("A", 'two\nlines, "quoted"', "2024-01-01"), ("B", "x", "2024-01-02"), ("C", 'x "y"', "2024-01-03")}


def test_checksums(spark, tmp_path, monkeypatch):
    path = write(tmp_path, "a.csv", "flight_id\nA\n")
    want = hashlib.sha256(b"flight_id\nA\n").hexdigest()
    absent = str(tmp_path / "none.csv")
    assert {r.checksum for r in registry.checksums(spark, [path, absent]).collect()} == {want, ""}
    monkeypatch.setattr(registry, "WHOLE_BYTES", 3)
    assert [r.checksum for r in registry.checksums(spark, path).collect()] == [want]


def test_salvage_rejects(spark):
    rows = [("a", 0, "noise"), ("a", 1, "Flight No;Start"), ("a", 2, "F1;2024-01-01"), ("a", 3, "F2;x;y"), ("b", 0, "q;r"), ("b", 1, "s")]
    lines = spark.createDataFrame(rows, "_src_path string, _row_ord bigint, value string")
    assert [r.cells for r in textsalvage.salvage(lines).collect()] == [["F1", "2024-01-01"]]
    got = {(r._src_path, r._row_ord, r.reason) for r in textsalvage.salvage_rejects(lines).collect()}
    assert got == {("a", 3, "3 fields, header has 2"), ("b", 0, "no header")}


def test_workbook_dates(spark, tmp_path):
    styles = (
        '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts count="2">'
        '<numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd hh:mm"/><numFmt numFmtId="171" formatCode="0.0&quot;days&quot;"/></numFmts>'
        '<cellXfs count="4"><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="171"/><xf numFmtId="20"/></cellXfs></styleSheet>'
    )
    sheet = (
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        '<row r="1"><c r="A1" t="inlineStr"><is><t>flight_id</t><rPh sb="0" eb="1"><t>zzz</t></rPh></is></c></row>'
        '<row r="2"><c r="A2" s="1"><v>45306.28125</v></c><c r="B2" s="2"><v>45306.5</v></c><c r="C2" s="3"><v>0.5</v></c>'
        '<c r="D2" t="b"><v>1</v></c><c r="E2" t="e"><v>#N/A</v></c><c r="F2" s="1"><v>1</v></c></row></sheetData></worksheet>'
    )
    path = book([], shared=False)
    content = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(path)) as old, zipfile.ZipFile(content, "w") as new:
        for name in old.namelist():
            new.writestr(name, sheet if "sheet" in name and name.startswith("xl/worksheets") else old.read(name))
        new.writestr("xl/styles.xml", styles)
    rows = list(workbook.sheet_rows(content.getvalue()))
    assert rows[0] == ["flight_id"]
    assert rows[1] == ["2024-01-15 06:45:00", "45306.5", "12:00:00", "true", None, "1900-01-01 00:00:00"]
    assert workbook.serial_text("0.25", True) == "1904-01-01 06:00:00"
    (tmp_path / "bad.xls").write_bytes(b"old binary")
    assert workbook.scan_workbooks(spark, str(tmp_path / "bad.xls")).count() == 0


def test_first_filled_of_several_sources(spark, tmp_path):
    path = write(tmp_path, "a.csv", "flight_id,flight,region,regionid,notes,notes\n,X,,R1,p,q\nA,Y,R2,R3,,\n")
    rows = registry.load_flights(spark, path).orderBy("_row_ord").collect()
    assert [(r.flight_id, r.region_code) for r in rows] == [("X", "R1"), ("A", "R2")]
    assert (rows[0].notes, rows[0].notes_1) == ("p", "q")


def test_row_order_over_file_splits(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = "\n".join(f"F{i:05d},2024-01-01" for i in range(5000))
        path = write(tmp_path, "a.csv", f"flight_id,start\n{lines}\n")
        df = delimited.scan_delimited(spark, path)
        assert df.rdd.getNumPartitions() > 1
        ids = [r.flight_id for r in df.orderBy("_row_ord").select("flight_id").collect()]
        assert ids == sorted(ids) and len(ids) == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_service_rows_stop_at_the_limit_and_at_the_first_normal_row(spark):
    data = [("a", i, ["Page 1", None]) for i in range(12)]
    data += [("b", 0, ["Generated x", "y"]), ("b", 1, ["ok", "y"]), ("b", 2, ["Source: z", None]), ("c", 0, ["Page", "x"])]
    df = spark.createDataFrame(data, "_src_path string, _row_ord int, cells array<string>")
    kept = {(r._src_path, r._row_ord) for r in clean.drop_service_rows(df, F.col("cells")).collect()}
    assert kept == {("a", 10), ("a", 11), ("b", 1), ("b", 2), ("c", 0)}


def test_decimal_points(spark):
    df = spark.createDataFrame([("a,b", "1,5")], "region_name string, latitude string")
    assert tuple(clean.decimal_points(df).first()) == ("a,b", "1.5")
    assert tuple(clean.decimal_points(df, all_strings=True).first()) == ("a.b", "1.5")


PAGE = """<html><head><META name="report-tz" content="Europe/Moscow" /></head><body>
<table><thead><tr><th colspan=3>Report</th></tr><tr><th>Flight Id</th><th>Start Time</th><th>End Time</th></tr></thead>
<tbody><tr><td><b>RU</b>-1</td><td><a href="/x">2024-01-01T00:00</a></td><td>2024-01-01T01:00</td></tr>
<tr></tr></tbody><tfoot><tr><td>total</td></tr></tfoot></table>
<table><tr><td>other</td></tr></table></body></html>"""


def test_html_report(spark, tmp_path):
    path = write(tmp_path, "a.HTML", PAGE)
    loaded = registry.load_flights(spark, path)
    row = loaded.collect()
    assert [(r.flight_id, r._src_tz) for r in row] == [("RU-1", "Europe/Moscow")]
    assert str(type_rows(loaded).first().start_time_utc) == "2023-12-31 21:00:00"
    link = html.cell_links(html.scan_html(spark, path)).collect()
    assert [(r.column_name, r.href) for r in link] == [("Start Time", "/x")]


def test_html_without_thead_or_table():
    tz, seen, header, rows = html.first_table(
        "<table><tr></tr><tr><td>Flight<td>Start</tr><tr><td>A<td> B &amp; C <tr><td>only</table>"
    )
    assert (tz, seen, header) == (None, True, ["Flight", "Start"])
    assert [c for c, _ in rows] == [["A", "B & C"], ["only"]]
    assert html.first_table("<p>none</p>")[1] is False


def test_html_page_without_table_gives_no_row(spark):
    pages = spark.createDataFrame([("p", "<p>x</p>"), ("q", "<table><tr><td>id</td></tr><tr><td>1</td></tr></table>")], "key string, html string")
    cells = html.table_rows(pages)
    assert [r._src_path for r in cells.collect()] == ["q"]
    review = {r.path: r.status for r in quality.source_review(cells, pages.withColumnRenamed("key", "path"), width=1).collect()}
    assert review == {"p": "FAIL", "q": "OK"}


def book(rows, shared=True):
    """A minimal workbook."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    texts, cells = [], []
    for r, row in enumerate(rows, 1):
        line = ""
        for c, value in enumerate(row):
            ref = f"{chr(65 + c)}{r}"
            if value is None:
                continue
            if isinstance(value, (int, float)):
                line += f'<c r="{ref}"><v>{value}</v></c>'
            elif shared:
                texts.append(f"<si><t>{value}</t></si>")
                line += f'<c r="{ref}" t="s"><v>{len(texts) - 1}</v></c>'
            else:
                line += f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'
        cells.append(f'<row r="{r}">{line}</row>')
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="Flights" r:id="rId2"/>'
                                      '<sheet name="Other" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/x.xml"/>'
                                                 '<Relationship Id="rId2" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{''.join(cells)}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{''.join(texts)}</sst>")
    return out.getvalue()


@pytest.mark.parametrize("shared", [True, False])
def test_workbook(spark, tmp_path, shared):
    rows = [["Flight ID", "Start Time", "End Time", "Duration (minutes)", "Region Code"],
            ["RU-1", "2024-01-01T00:00:00", "2024-01-01T01:00:00", 60, "RU-MOW"],
            ["RU-2", None, "2024-01-01T01:00:00"]]
    path = tmp_path / "a.xlsx"
    path.write_bytes(book(rows, shared))
    got = registry.load_flights(spark, str(path)).orderBy("_row_ord").collect()
    assert (got[0].flight_id, got[0].start_time, got[0].duration_minutes) == ("RU-1", "2024-01-01T00:00:00", "60")
    assert (got[1].flight_id, got[1].start_time, got[1].region_code) == ("RU-2", None, None)
    assert workbook.scan_workbooks(spark, str(path)).count() == 2


def test_text_table_in_a_damaged_document(spark, tmp_path):
    path = write(tmp_path, "a.pdf", "%PDF-1.4\n1 0 obj<>\nsome, words\n"
                 "flight_id,start_time,end_time,duration_minutes,region_code\n"
                 "RU-1,2024-01-01T00:00:00,2024-01-01T00:30:00,30,RU-MOW\n\n%%EOF\n")
    row = registry.load_flights(spark, path).collect()
    assert [(r.flight_id, r.duration_minutes, r._src_degraded) for r in row] == [("RU-1", "30", True)]
    files = registry.list_files(spark, path)
    assert quality.source_review(textsalvage.scan_text_tables(spark, path), files).first().status == "FAIL"


def test_salvage_delimiters_encoding_and_noise(spark, tmp_path):
    write(tmp_path, "a.pdf", "Flight;Start,End;Operator\nA;1,2;x\nB;3;y\nFlight;Start,End;Operator\nA;B\nfooter page 2;;\n")
    write(tmp_path, "b.pdf", "flight\tregion_name\nZ\tMünchen\n", encoding="latin-1")
    cells = textsalvage.scan_text_tables(spark, str(tmp_path))
    rows = {tuple(r.cells) for r in textsalvage.drop_noise(cells, "footer page").collect()}
    assert rows == {("A", "1,2", "x"), ("B", "3", "y"), ("Z", "München")}


def test_formats(spark, tmp_path):
    paths = ["a.csv", "b.XLSX", "c.htm", "d.pdf", "e.xls", "f.txt", "g"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [r.format for r in registry.classify(df).collect()]
    assert got == ["csv", "xlsx", "html", "pdf", "xlsx", None, None]
    assert {r.format for r in registry.classify(df, "TEXT/CSV").collect()} == {"csv"}
    with pytest.raises(ValueError):
        registry.register(registry.SourceFormat("csv", (), None))
    with pytest.raises(ValueError, match="unknown source format"):
        registry.load_flights(spark, write(tmp_path, "x.txt", "a"))


def test_own_format(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "FORMATS", dict(registry.FORMATS))
    monkeypatch.setattr(registry, "_LOOKUP", dict(registry._LOOKUP))
    with pytest.warns(UserWarning, match="htm"):
        registry.register(registry.SourceFormat("lines", ("lst", "htm"), lambda s, files: s.read.text(files)))
    assert registry.load_flights(spark, write(tmp_path, "x.lst", "a\nb")).count() == 2
