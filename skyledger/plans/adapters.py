"""Flight reports derived from the order and event tables.

Plain integer arithmetic on keys makes valid, invalid, re-issued and id-less reports in
fixed proportions, so the same rows can be stated in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deals a table out to the cores if it is too small to have a split for each.

    The plan's size estimate decides, without a job; larger tables split as they are read.
    """
    context = df.sparkSession.sparkContext
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(context.defaultParallelism) if size < context.defaultParallelism * (8 << 20) else df


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n)


def _iso(ts: Column, key: Column) -> Column:
    suffix = F.when(key % 3 == 0, "Z").when(key % 3 == 1, "+03:00").otherwise("")
    return F.concat(F.replace(F.substring(ts.cast("string"), 1, 19), F.lit(" "), F.lit("T")), suffix)


def _tenths(n: Column, point: Column) -> Column:
    """n / 10 as decimal text."""
    sign = F.when(n < 0, "-").otherwise("")
    whole = F.floor(F.abs(n) / 10).cast("string")
    return F.concat(sign, whole, point, (F.abs(n) % 10).cast("string"))


def flight_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows: one report per order, and a re-issue for every 50th order."""
    orders = spread(table(spark, sf_dir, "orders"))
    customers = table(spark, sf_dir, "customer")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    start = F.col("o_orderdate") + _minutes((key % 1440).cast("int"))
    copies = F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = joined.select("*", start.alias("start"), F.explode(copies).alias("seq"))
    end = F.col("start") + _minutes((cust % 1600 - 20 + F.col("seq") * 30).cast("int"))
    point = F.when(key % 2 == 0, ",").otherwise(".")
    minutes = (
        F.when(key % 5 == 0, F.lit(None))
        .when(key % 5 == 1, "")
        .when(key % 5 == 2, "45,5")
        .otherwise((key * 37 % 1500).cast("string"))
    )
    return rows.select(
        F.when(key % 17 == 0, "").otherwise(F.concat(F.lit(" F-"), key.cast("string"))).alias("flight_id"),
        _iso(F.col("start"), key).alias("start_time"),
        _iso(end, key).alias("end_time"),
        minutes.alias("duration_minutes"),
        F.when(key % 23 != 0, F.concat(F.lit("R"), F.col("c_nationkey").cast("string"))).alias("region_code"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("region_name"),
        _tenths(key * 7919 % 1900 - 950, point).alias("latitude"),
        _tenths(key * 104729 % 3700 - 1850, point).alias("longitude"),
        F.col("o_orderpriority").alias("vehicle_category"),
        F.col("o_orderstatus").alias("operator_type"),
        F.col("c_mktsegment").alias("flight_purpose"),
        F.when(key % 4 != 0, F.concat(F.lit("P"), (key % 7).cast("string"))).otherwise("").alias("payload_type"),
        F.struct("seq", key.alias("key")).alias("_row_ord"),
    )


def event_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical flights from the event table: start `ts`, `value` minutes, 25 regions."""
    return from_events(table(spark, sf_dir, "events"))


def from_events(events: DataFrame) -> DataFrame:
    text = F.lit(None).cast("string")
    seconds = F.col("value").cast("decimal(18,6)") * 60
    return events.select(
        F.concat(F.lit("E-"), F.col("event_id").cast("string")).alias("flight_id"),
        text.alias("surrogate_id"),
        F.col("ts").alias("start_time_utc"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("end_time_utc"),
        F.col("value").alias("duration_minutes"),
        F.concat(F.lit("R"), (F.col("user_id") % 25).cast("string")).alias("region_code"),
        text.alias("region_name"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.col("event_type").alias("vehicle_category"),
        text.alias("operator_type"),
        text.alias("flight_purpose"),
        text.alias("payload_type"),
        F.lit(False).alias("superseded"),
        F.struct("event_id").alias("_row_ord"),
    )


def region_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON feature text per nation: a 5 x 5 grid over the globe.

    Region 6 is L-shaped (its north-east quarter is cut off), region 12 has a hole,
    region 18 is a multipolygon of two halves.
    """
    k = F.col("n_nationkey")
    west, south = (k % 5) * 72 - 180, F.floor(k / 5).cast("int") * 36 - 90

    def ring(*corners: tuple[int, int]) -> Column:
        closed = corners + corners[:1]
        points = [F.array((west + x).cast("double"), (south + y).cast("double")) for x, y in closed]
        return F.array(*points)

    box = F.array(ring((0, 0), (72, 0), (72, 36), (0, 36)))
    ell = F.array(ring((0, 0), (72, 0), (72, 18), (36, 18), (36, 36), (0, 36)))
    holed = F.array(
        ring((0, 0), (72, 0), (72, 36), (0, 36)), ring((26, 13), (46, 13), (46, 23), (26, 23))
    )
    halves = F.array(
        F.array(ring((0, 0), (36, 0), (36, 36), (0, 36))), F.array(ring((36, 0), (72, 0), (72, 36), (36, 36)))
    )
    shape = F.when(k == 6, F.to_json(ell)).when(k == 12, F.to_json(holed)).when(k == 18, F.to_json(halves))
    kind = F.when(k == 18, "MultiPolygon").otherwise("Polygon")
    return table(spark, sf_dir, "nation").select(
        F.concat(
            F.lit('{"type":"Feature","properties":{"CODE":"R'),
            k.cast("string"),
            F.lit('","Name":"'),
            F.col("n_name"),
            F.lit('"},"geometry":{"type":"'),
            kind,
            F.lit('","coordinates":'),
            F.coalesce(shape, F.to_json(box)),
            F.lit("}}"),
        ).alias("value"),
        k.alias("ord"),
    )


def line_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical flights from the line items; many share an id, some also the start."""
    text = F.lit(None).cast("string")
    number = F.lit(None).cast("double")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.lit("L"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "flight_id"
        ),
        text.alias("surrogate_id"),
        F.col("l_shipdate").alias("start_time_utc"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("end_time_utc"),
        F.col("l_quantity").alias("duration_minutes"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("R"), F.col("l_linenumber").cast("string"))).alias(
            "region_code"
        ),
        text.alias("region_name"),
        number.alias("latitude"),
        number.alias("longitude"),
        F.col("l_linestatus").alias("vehicle_category"),
        *[text.alias(c) for c in ("operator_type", "flight_purpose", "payload_type")],
        F.lit(False).alias("superseded"),
        F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("_row_ord"),
    )


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTML report per order: a table with head and body, markup and links in cells, and
    a second table that does not count."""
    key = F.col("o_orderkey").cast("string")
    parts = [
        F.lit('<html><head><meta name="report-tz" content="+03:00" /></head><body><p>Report '), key,
        F.lit("</p><table class=r><thead><tr><th>x</th></tr><tr><th>Flight <b>Id</b></th><th> Start Time</th>"
              "<th>End-Time</th><th>Region Code</th></tr></thead><tbody><tr><td>F-<i>"),
        key, F.lit('</i></td><td><a href="/o/'), key, F.lit('">'), F.col("o_orderdate").cast("string"),
        F.lit("</a></td><td>"), F.col("o_orderdate").cast("string"), F.lit("</td><td> "), F.col("o_orderstatus"),
        F.lit(" &amp; "), F.col("o_orderpriority"),
        F.lit("</td></tr><tr><td>G-"), key,
        F.lit("</td><td>never</td></tr></tbody></table><table><tr><td>decoy</td></tr></table></body></html>"),
    ]
    return spread(table(spark, sf_dir, "orders")).select(F.col("o_orderkey").alias("key"), F.concat(*parts).alias("html"))


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of five damaged documents: a header, orders as table rows, document text as noise."""
    def delimiter(n: Column) -> Column:
        return F.when(n == 0, ";").when(n == 1, "\t").otherwise(",")

    def line(n: Column, a: Column, b: Column, body: Column) -> list[Column]:
        return [
            F.concat(F.lit("report-"), n.cast("string")).alias("_src_path"),
            F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")).alias("_row_ord"),
            body.alias("value"),
        ]

    regions = table(spark, sf_dir, "region")
    r = F.col("r_regionkey")
    headers = regions.select(
        *line(r, F.lit(-1), F.lit(0), F.call_function("concat_ws", delimiter(r), *map(F.lit, ("Flight No", "Start", "END", "duration"))))
    )
    orders = spread(table(spark, sf_dir, "orders"))
    key = F.col("o_orderkey")
    n = key % 5
    when = F.substring(F.col("o_orderdate").cast("string"), 1, 19)
    row = F.call_function("concat_ws", delimiter(n), F.concat(F.lit(" F-"), key.cast("string")), when, when, (key % 90).cast("string"))
    rows = orders.select(*line(n, key, F.lit(0), row))
    documents = spread(table(spark, sf_dir, "documents")).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "t"))
    noise = documents.select(*line(F.col("doc_id") % 5, F.col("doc_id"), F.col("pos") + 1, F.col("t")))
    return headers.unionByName(rows).unionByName(noise)


def service_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two cells per customer's source; three of four order keys make service rows."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    first = (
        F.when(key % 4 == 0, F.concat(F.lit(" Page "), text))
        .when(key % 4 == 1, F.concat(F.lit("Generated on "), text))
        .when(key % 4 == 2, " ")
        .otherwise(F.concat(F.lit("F-"), text))
    )
    second = F.when(key % 4 == 2, F.lit(None)).otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("_src_path"), key.alias("_row_ord"), F.array(first, second).alias("cells")
    )


def header_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header candidates: decorated customer names, spelled aliases per order, whole documents."""
    customers = table(spark, sf_dir, "customer").select(
        F.lit("c").alias("kind"),
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(")\t")).alias("text"),
    )
    key = F.col("o_orderkey")
    spelled = (
        F.when(key % 6 == 0, "Flight No")
        .when(key % 6 == 1, " DURATION (min) ")
        .when(key % 6 == 2, "Номер полета")
        .when(key % 6 == 3, "Region-Code")
        .when(key % 6 == 4, "Широта")
        .otherwise(F.concat(F.lit("Column "), F.col("o_orderpriority")))
    )
    orders = table(spark, sf_dir, "orders").select(F.lit("o").alias("kind"), key.alias("id"), spelled.alias("text"))
    documents = table(spark, sf_dir, "documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    return customers.unionByName(orders).unionByName(documents)


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names, one per order."""
    key = F.col("o_orderkey")
    suffix = F.element_at(
        F.array(*map(F.lit, (".csv", ".XLSX", ".htm", ".pdf", ".xls", ".txt", "", ".Html"))), (key % 8 + 1).cast("int")
    )
    path = F.concat(F.lit("s3://bucket.x/reports/"), F.col("o_orderstatus"), F.lit("/"), key.cast("string"), suffix)
    return table(spark, sf_dir, "orders").select(path.alias("path"))


def tagged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web pages, every second one with a report-tz tag put in."""
    page = F.col("page_id")
    tag = F.concat(F.lit('<meta content="Zone/'), page.cast("string"), F.lit('" name="report-tz">'))
    html = F.when(page % 2 == 0, F.concat(tag, F.col("html"))).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select(page.alias("key"), html.alias("html"))
