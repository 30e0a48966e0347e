"""Expressions over a GeoJSON geometry kept as JSON text.

A Polygon nests coordinates three deep and a MultiPolygon four deep, so the text
is parsed with the schema its ``type`` calls for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_POLYGON = "coordinates array<array<array<double>>>"
_MULTI = "coordinates array<array<array<array<double>>>>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def geometry_type(geometry) -> Column:
    return F.get_json_object(_col(geometry), "$.type")


def parts(geometry) -> Column:
    """Array of polygons, each an array of rings; NULL for other geometry types."""
    g = _col(geometry)
    kind = geometry_type(g)
    return F.when(kind == "Polygon", F.array(F.from_json(g, _POLYGON)["coordinates"])).when(
        kind == "MultiPolygon", F.from_json(g, _MULTI)["coordinates"]
    )


def outer_ring(geometry) -> Column:
    """First ring of the (first) polygon."""
    return F.get(F.get(parts(geometry), 0), 0)


def _axis(ring: Column, i: int) -> Column:
    return F.transform(ring, lambda p: F.get(p, i))


def bbox_centroid(ring) -> Column:
    """Middle of the bounding box: struct(lon, lat)."""
    ring = _col(ring)
    x, y = _axis(ring, 0), _axis(ring, 1)
    return F.struct(
        ((F.array_min(x) + F.array_max(x)) / 2).alias("lon"),
        ((F.array_min(y) + F.array_max(y)) / 2).alias("lat"),
    )


def vertex_centroid(ring) -> Column:
    """Mean of the ring's points, the closing point included: struct(lon, lat)."""
    ring = _col(ring)

    def mean(i: int) -> Column:
        total = F.aggregate(ring, F.lit(0.0), lambda acc, p: acc + F.get(p, i))
        return F.try_divide(total, F.size(ring))

    return F.struct(mean(0).alias("lon"), mean(1).alias("lat"))


def _ring_moments(ring: Column) -> Column:
    """Unsigned area and first moments of a closed ring, taken relative to its first point."""
    x0, y0 = F.get(F.get(ring, 0), 0), F.get(F.get(ring, 0), 1)

    def edge(acc: Column, i: Column) -> Column:
        p, q = F.get(ring, i), F.get(ring, i + 1)
        px, py, qx, qy = F.get(p, 0) - x0, F.get(p, 1) - y0, F.get(q, 0) - x0, F.get(q, 1) - y0
        cross = px * qy - qx * py
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["x"] + (px + qx) * cross).alias("x"),
            (acc["y"] + (py + qy) * cross).alias("y"),
        )

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def finish(acc: Column) -> Column:
        # Orientation-free: dividing by the sign makes the area positive.
        area = F.abs(acc["a"]) / 2
        sign = F.signum(acc["a"])
        return F.struct(
            area.alias("a"),
            (sign * acc["x"] / 6 + area * x0).alias("x"),
            (sign * acc["y"] / 6 + area * y0).alias("y"),
        )

    # A ring of fewer than two points has no edge; sequence() would count down.
    edges = F.when(F.size(ring) >= 2, F.sequence(F.lit(0), F.size(ring) - 2)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(edges, zero, edge, finish)


def area_centroid(geometry) -> Column:
    """Area-weighted centroid over all parts with holes taken out: struct(lon, lat)."""

    def add(acc: Column, m: Column, sign: Column) -> Column:
        return F.struct(
            (acc["a"] + sign * m["a"]).alias("a"),
            (acc["x"] + sign * m["x"]).alias("x"),
            (acc["y"] + sign * m["y"]).alias("y"),
        )

    rings = F.flatten(
        F.transform(
            parts(geometry),
            lambda rings: F.transform(
                rings,
                lambda ring, i: F.struct(
                    F.when(i == 0, 1.0).otherwise(-1.0).alias("sign"), _ring_moments(ring).alias("m")
                ),
            ),
        )
    )
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    total = F.aggregate(rings, zero, lambda acc, r: add(acc, r["m"], r["sign"]))
    return F.struct(
        F.try_divide(total["x"], total["a"]).alias("lon"), F.try_divide(total["y"], total["a"]).alias("lat")
    )


def degree_distance(lon1, lat1, lon2, lat2) -> Column:
    """Straight-line distance in degrees, five decimals."""
    dx, dy = _col(lon1) - _col(lon2), _col(lat1) - _col(lat2)
    return F.round(F.sqrt(dx * dx + dy * dy), 5)
