"""Planar geometry on edge arrays (structs x1, y1, x2, y2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def ring_edges(ring: Column) -> Column:
    """Edges of a closed ring given as an array of [x, y] points."""
    pairs = F.arrays_zip(
        F.slice(ring, F.lit(1), F.size(ring) - 1).alias("a"), F.slice(ring, F.lit(2), F.size(ring) - 1).alias("b")
    )
    return F.transform(
        pairs,
        lambda p: F.struct(
            F.get(p["a"], F.lit(0)).alias("x1"),
            F.get(p["a"], F.lit(1)).alias("y1"),
            F.get(p["b"], F.lit(0)).alias("x2"),
            F.get(p["b"], F.lit(1)).alias("y2"),
        ),
    )


def _cross(e: Column) -> Column:
    return e["x1"] * e["y2"] - e["x2"] * e["y1"]


def _sum(edges: Column, term) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))


def ring_moments(edges: Column) -> Column:
    """Struct of area (positive) and area times centroid of a ring, whatever its direction."""
    area = _sum(edges, _cross) / 2
    sign = F.when(area < 0, -1.0).otherwise(1.0)
    mx = _sum(edges, lambda e: (e["x1"] + e["x2"]) * _cross(e)) / 6
    my = _sum(edges, lambda e: (e["y1"] + e["y2"]) * _cross(e)) / 6
    return F.struct((area * sign).alias("a"), (mx * sign).alias("mx"), (my * sign).alias("my"))


def on_edge(edges: Column, x: Column, y: Column) -> Column:
    """The point lies on one of the edges."""

    def touches(e: Column) -> Column:
        aligned = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
        return (
            aligned
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    return F.exists(edges, touches)


def crossings_odd(edges: Column, x: Column, y: Column) -> Column:
    """A ray from the point towards larger x crosses an odd number of edges."""

    def crossed(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        # The height difference is not zero where the edge spans y.
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return F.when(spans & (x < at), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda acc, e: acc + crossed(e)) % 2 == 1


def covers(edges: Column, x: Column, y: Column) -> Column:
    """Point in polygon, boundary (of holes, too) included."""
    return on_edge(edges, x, y) | crossings_odd(edges, x, y)
