"""Region boundaries from GeoJSON (WGS-84)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import ring_edges, ring_moments

_GEOMETRY = "type STRING, coordinates STRING"
_FEATURE = (
    "properties MAP<STRING, STRING>, "
    f"geometry STRUCT<{_GEOMETRY}, geometries ARRAY<STRUCT<{_GEOMETRY}>>>"
)
_POLYGON = "ARRAY<ARRAY<ARRAY<DOUBLE>>>"


def read_features(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Features of GeoJSON feature collections: code, name, geometry, ord."""
    schema = f"features ARRAY<STRUCT<{_FEATURE.replace('properties MAP', 'properties: MAP').replace('geometry STRUCT', 'geometry: STRUCT')}>>"
    files = spark.read.schema(schema).option("multiLine", True).json(paths)
    rows = files.select(
        F.col("_metadata.file_path").alias("path"), F.posexplode("features").alias("pos", "feature")
    )
    return _named(rows.select(F.struct("path", "pos").alias("ord"), "feature.*"))


def parse_features(texts: DataFrame) -> DataFrame:
    """The same from rows (value = one GeoJSON feature as text, ord)."""
    rows = texts.select("ord", F.from_json("value", _FEATURE).alias("f")).select("ord", "f.*")
    return _named(rows)


def _named(rows: DataFrame) -> DataFrame:
    lower = F.transform_keys("properties", lambda k, _: F.lower(k))

    def required(key: str) -> Column:
        missing = F.raise_error(F.lit(f"feature without the property {key}"))
        return F.when(F.map_contains_key(lower, key), F.element_at(lower, F.lit(key))).otherwise(
            missing.cast("string")
        )

    return rows.select("ord", required("code").alias("code"), required("name").alias("name"), "geometry")


def _polygons(kind: Column, coordinates: Column) -> Column:
    """Polygons of a Polygon or MultiPolygon; other kinds give an empty list."""
    return (
        F.when(kind == "Polygon", F.array(F.from_json(coordinates, _POLYGON)))
        .when(kind == "MultiPolygon", F.from_json(coordinates, f"ARRAY<{_POLYGON}>"))
        .otherwise(F.array().cast(f"ARRAY<{_POLYGON}>"))
    )


def multipolygons(features: DataFrame) -> DataFrame:
    """Geometry as a list of polygons; collections are flattened, other parts dropped.

    A feature without any polygon fails the job.
    """
    g = F.col("geometry")
    direct = _polygons(g["type"], g["coordinates"])
    nested = F.flatten(F.transform(g["geometries"], lambda p: _polygons(p["type"], p["coordinates"])))
    polygons = F.when(g["type"] == "GeometryCollection", nested).otherwise(direct)
    bad = F.raise_error(F.concat(F.lit("no polygon in the geometry of region "), F.col("code")))
    found = F.coalesce(F.size(polygons), F.lit(0)) > 0
    checked = F.when(found, polygons).otherwise(bad.cast(f"ARRAY<{_POLYGON}>"))
    return features.select("ord", "code", "name", checked.alias("polygons"))


def region_table(features: DataFrame) -> DataFrame:
    """code, name, edges, bounding box and centroid, one row per code.

    The last feature of a repeated code wins. The centroid weighs the rings by area;
    rings after the first of a polygon are holes.
    """
    shapes = multipolygons(features)
    last = shapes.groupBy("code").agg(F.max_by(F.struct("name", "polygons"), "ord").alias("r"))
    rings = F.flatten(
        F.transform(
            "r.polygons",
            lambda polygon: F.transform(
                polygon,
                lambda ring, i: F.struct(
                    F.when(i == 0, 1.0).otherwise(-1.0).alias("sign"), ring_edges(ring).alias("edges")
                ),
            ),
        )
    )
    with_rings = last.select("code", F.col("r.name").alias("name"), rings.alias("rings"))
    moments = F.transform(
        "rings", lambda r: F.struct(r["sign"].alias("sign"), ring_moments(r["edges"]).alias("m"))
    )
    edges = F.flatten(F.transform("rings", lambda r: r["edges"]))
    shaped = with_rings.select("code", "name", edges.alias("edges"), moments.alias("moments"))

    def total(field: str) -> Column:
        return F.aggregate("moments", F.lit(0.0), lambda acc, r: acc + r["sign"] * r["m"][field])

    def extreme(pick, a: str, b: str) -> Column:
        return pick(F.transform("edges", lambda e: (F.least if pick is F.array_min else F.greatest)(e[a], e[b])))

    return shaped.select(
        "code",
        "name",
        "edges",
        extreme(F.array_min, "x1", "x2").alias("min_x"),
        extreme(F.array_min, "y1", "y2").alias("min_y"),
        extreme(F.array_max, "x1", "x2").alias("max_x"),
        extreme(F.array_max, "y1", "y2").alias("max_y"),
        (total("mx") / total("a")).alias("centroid_x"),
        (total("my") / total("a")).alias("centroid_y"),
    )
