"""Distances on the sphere and polygons as rings of points, in column expressions.

A ring is ``array<struct<x double, y double>>`` (x: longitude, y: latitude); a
polygon is an array of rings, so holes and parts need no special case: a point
is inside if it crosses an odd number of edges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean radius of the earth in metres.
RADIUS_M = 6_371_008.8
RING = "array<struct<x:double,y:double>>"
POLYGON = f"array<{RING}>"


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def haversine_m(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * RADIUS_M * math.asin(min(1.0, math.sqrt(a)))


def box(x1: float, y1: float, x2: float, y2: float) -> list:
    """A polygon of one closed ring."""
    x1, y1, x2, y2 = map(float, (x1, y1, x2, y2))
    return [[(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]]


def edges(polygon: Column) -> Column:
    """All edges of all rings, as structs a and b."""
    one = lambda ring: F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))
    return F.flatten(F.transform(polygon, one))


def bounds(polygon: Column) -> Column:
    """Struct x1, y1, x2, y2."""
    points = F.flatten(polygon)
    axis = lambda name: F.transform(points, lambda p: p[name])
    return F.struct(F.array_min(axis("x")).alias("x1"), F.array_min(axis("y")).alias("y1"), F.array_max(axis("x")).alias("x2"), F.array_max(axis("y")).alias("y2"))


def on_edge(x: Column, y: Column, e: Column) -> Column:
    a, b = e["a"], e["b"]
    cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
    return (cross == 0) & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def meets(polygon_edges: Column, x: Column, y: Column) -> Column:
    """Is the point inside the polygon or on its boundary?"""

    def crossed(n: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (a["y"] > y) != (b["y"] > y)
        left = x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return n + F.when(spans & left, 1).otherwise(0)

    inside = F.aggregate(polygon_edges, F.lit(0), crossed) % 2 == 1
    return inside | F.exists(polygon_edges, lambda e: on_edge(x, y, e))


def closest_point(polygon_edges: Column, x: Column, y: Column) -> Column:
    """The polygon's boundary point nearest in degrees: struct d (degrees), x, y."""

    def on(e: Column) -> Column:
        a, b = e["a"], e["b"]
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        t = F.coalesce(((x - a["x"]) * dx + (y - a["y"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        px, py = a["x"] + t * dx, a["y"] + t * dy
        return F.struct(F.sqrt(F.pow(x - px, 2) + F.pow(y - py, 2)).alias("d"), px.alias("x"), py.alias("y"))

    return F.array_min(F.transform(polygon_edges, on))
