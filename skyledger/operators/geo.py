"""Regions of flights: point in polygon through a grid of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import covers, crossings_odd


def region_cells(regions: DataFrame, degrees: float = 1.0) -> DataFrame:
    """One row per grid cell that a region may touch, with its candidate regions.

    A candidate keeps only the edges a ray from inside the cell can meet. A cell that
    no edge touches lies wholly inside or outside, which its centre decides here once.
    """
    step = F.lit(float(degrees))

    def index(c: Column) -> Column:
        return F.floor(c / step).cast("int")

    west, south = F.col("cell_x") * step, F.col("cell_y") * step
    east, north = west + step, south + step

    def in_row(e: Column) -> Column:
        return (F.greatest(e["y1"], e["y2"]) >= south) & (F.least(e["y1"], e["y2"]) <= north)

    # Edges are dealt to rows of cells first; a cell then gets those of its row only.
    rows = regions.withColumn("cell_y", F.explode(F.sequence(index(F.col("min_y")), index(F.col("max_y")))))
    rows = rows.withColumn("edges", F.filter("edges", in_row)).where(F.size("edges") > 0)
    spread = rows.withColumn("cell_x", F.explode(F.sequence(index(F.col("min_x")), index(F.col("max_x")))))
    band = spread.withColumn("near", F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= west))
    touched = F.exists("near", lambda e: F.least(e["x1"], e["x2"]) <= east)
    centre_in = crossings_odd(F.col("near"), west + step / 2, south + step / 2)
    no_edges = F.slice(F.col("near"), 1, 0)
    judged = band.select(
        "cell_x", "cell_y", "code", "centroid_x", "centroid_y",
        touched.alias("border"),
        F.when(touched, F.col("near")).otherwise(no_edges).alias("edges"),
        (~touched & centre_in).alias("inside"),
    ).where("border OR inside")
    # The candidates of a cell are regions, so a cell's list is bounded by the region directory.
    candidate = F.struct("code", "centroid_x", "centroid_y", "inside", "edges")
    return judged.groupBy("cell_x", "cell_y").agg(F.collect_list(candidate).alias("candidates"))


def geocodable(lon: str = "longitude", lat: str = "latitude") -> Column:
    """Both coordinates are there and not (0, 0)."""
    x, y = F.col(lon), F.col(lat)
    return F.coalesce(x.isNotNull() & y.isNotNull() & ~((x == 0) & (y == 0)), F.lit(False))


def assign_regions(
    flights: DataFrame, cells: DataFrame, degrees: float = 1.0
) -> DataFrame:
    """Add geo_region: the region that covers the start point; null if none or not geocodable.

    Of several regions (a point on a border) the one with the nearest centroid is
    taken, then the smaller code. `geo_matches` counts them.

    A flight meets one cell row, so nothing is grouped or ranked afterwards. AQE broadcasts
    the cells while they are small; beyond that the join shuffles on the cell, flights
    without a usable point spread over cells that do not exist, and AQE splits a busy cell.
    """
    x, y = F.col("longitude"), F.col("latitude")
    nowhere = F.lit(1_000_000) + F.pmod(F.xxhash64("flight_id"), F.lit(4096))
    keyed = flights.withColumns(
        {
            "cell_x": F.when(geocodable(), F.floor(x / degrees)).otherwise(nowhere).cast("int"),
            "cell_y": F.when(geocodable(), F.floor(y / degrees)).otherwise(nowhere).cast("int"),
        }
    )
    joined = keyed.join(cells, ["cell_x", "cell_y"], "left")
    hits = F.filter("candidates", lambda c: c["inside"] | covers(c["edges"], x, y))
    matched = joined.withColumn("_hits", hits)

    def distance(c: Column) -> Column:
        # Seven digits, whatever the size of the region, so that equal distances compare equal.
        d = (c["centroid_x"] - x) * (c["centroid_x"] - x) + (c["centroid_y"] - y) * (c["centroid_y"] - y)
        return d.cast("float")

    nearest = F.array_min(
        F.transform("_hits", lambda c: F.struct(distance(c).alias("d"), c["code"].alias("code")))
    )
    return matched.withColumns(
        {"geo_region": nearest["code"], "geo_matches": F.coalesce(F.size("_hits"), F.lit(0))}
    ).drop("cell_x", "cell_y", "candidates", "_hits")


def flights_geo(assigned: DataFrame, version: str) -> DataFrame:
    """The geo table: flight, point, region and observation time."""
    return assigned.where(geocodable()).select(
        F.lit(version).alias("dataset_version"),
        F.col("flight_id").alias("flight_uid"),
        F.col("geo_region").alias("region_code"),
        F.col("longitude").alias("location_x"),
        F.col("latitude").alias("location_y"),
        F.col("start_time_utc").alias("observed_at"),
        F.year("start_time_utc").alias("year"),
    )


def geocoded_ratio(assigned: DataFrame, alert_below: float = 0.99) -> DataFrame:
    """Share of the flights with a region, and whether it calls for an alert."""
    hits = F.count_if(F.col("geo_region").isNotNull())
    ratio = F.round(hits / F.nullif(F.count("*"), F.lit(0)), 6)
    return assigned.agg(
        F.count("*").alias("flights"), hits.alias("geocoded"), ratio.alias("geocoded_ratio")
    ).withColumn("alert", F.coalesce(F.col("geocoded_ratio") < alert_below, F.lit(False)))


def with_region_names(flights: DataFrame, regions: DataFrame, key: str = "region_code") -> DataFrame:
    """Look the region up by code; flights with an unknown code stay."""
    names = regions.select(F.col("code").alias(key), F.col("name").alias("directory_name"))
    return flights.join(names, key, "left")


def audit_locations(geo: DataFrame, cells: DataFrame, degrees: float = 1.0) -> DataFrame:
    """Stored locations that their stored region really covers, per region and in all.

    Joined on the grid cell as the assignment is, so a busy region is many cells; a location
    outside all cells of its region counts as not covered. `cells` are `region_cells`.
    """
    x, y = F.col("location_x"), F.col("location_y")
    keyed = geo.where("region_code IS NOT NULL").withColumns(
        {"cell_x": F.floor(x / degrees).cast("int"), "cell_y": F.floor(y / degrees).cast("int")}
    )
    own = F.filter("candidates", lambda c: c["code"] == F.col("region_code"))
    ok = F.exists(own, lambda c: c["inside"] | covers(c["edges"], x, y))
    return keyed.join(cells, ["cell_x", "cell_y"], "left").groupBy("region_code").agg(
        F.count("*").alias("stored"), F.count_if(F.coalesce(ok, F.lit(False))).alias("intersected")
    )


def region_geometry_check(features: DataFrame) -> DataFrame:
    """Geometry rules per feature: rings closed, four points at least, coordinates in range,
    code there and not repeated."""
    g = F.col("geometry")
    points = F.flatten(F.flatten("polygons"))
    rings = F.flatten("polygons")
    shapes = features.withColumn("polygons", _lenient_polygons(g))
    per_code = features.groupBy("code").agg(F.count("*").alias("_copies"))
    rules = {
        "no_polygon": F.size("polygons") == 0,
        "ring_open": F.exists(rings, lambda r: F.element_at(r, 1) != F.element_at(r, -1)),
        "ring_short": F.exists(rings, lambda r: F.size(r) < 4),
        "out_of_range": F.exists(
            points, lambda p: (F.abs(F.get(p, F.lit(0))) > 180) | (F.abs(F.get(p, F.lit(1))) > 90)
        ),
        "code_missing": F.coalesce(F.col("code"), F.lit("")) == "",
        "code_repeated": F.coalesce(F.col("_copies"), F.lit(1)) > 1,
    }
    problems = F.array_compact(
        F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(n)) for n, broken in rules.items()])
    )
    return shapes.join(per_code, "code", "left").select(
        "code",
        F.array_join(problems, ",").alias("problems"),
        F.when(F.size(problems) > 0, "FAIL").otherwise("OK").alias("status"),
    )


def _lenient_polygons(g: Column) -> Column:
    kind = "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"
    none = F.array().cast(kind)

    def of(p: Column) -> Column:
        return (
            F.when(p["type"] == "Polygon", F.array(F.from_json(p["coordinates"], "ARRAY<ARRAY<ARRAY<DOUBLE>>>")))
            .when(p["type"] == "MultiPolygon", F.from_json(p["coordinates"], kind))
            .otherwise(none)
        )

    nested = F.flatten(F.transform(g["geometries"], of))
    return F.coalesce(F.when(g["type"] == "GeometryCollection", nested).otherwise(of(g)), none)
