import json
import math
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from gridops.functions import geo as g
from gridops.operators import joins, nearby
from gridops.sinks.tables import build_dim_grid
from gridops.sources.files import read_geojson_lookup


def box(x, y, w=2.0, h=1.0):
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


def geo(spark, shapes):
    return spark.createDataFrame([(i, None if s is None else json.dumps(s)) for i, s in shapes], "grid_id int, geometry string")


def polygon(*rings):
    return {"type": "Polygon", "coordinates": list(rings)}


def points(spark, pts):
    """A degenerate ring: every vertex is the point, so the centroid is the point itself."""
    return geo(spark, [(i, polygon([[x, y]])) for i, x, y in pts])


def test_three_centroids_of_a_box(spark):
    df = geo(spark, [(1, polygon(box(0, 0)))])
    ring = g.outer_ring("geometry")
    row = df.select(g.bbox_centroid(ring).alias("b"), g.vertex_centroid(ring).alias("v"), g.area_centroid("geometry").alias("a")).first()
    assert (row.b.lon, row.b.lat) == (1.0, 0.5)
    assert (round(row.v.lon, 9), round(row.v.lat, 9)) == (0.8, 0.4)
    assert (round(row.a.lon, 9), round(row.a.lat, 9)) == (1.0, 0.5)


def test_area_centroid_with_hole_parts_and_either_orientation(spark):
    holed = polygon(box(0, 0, 4, 4), box(0, 0, 2, 4))  # the left half is a hole
    two = {"type": "MultiPolygon", "coordinates": [[box(0, 0, 1, 1)], [box(10, 0, 3, 1)[::-1]]]}
    df = build_dim_grid(geo(spark, [(1, holed), (2, two), (3, {"type": "Point", "coordinates": [1, 2]}), (4, None)]))
    got = {r.grid_id: (r.centroid_longitude, r.centroid_latitude) for r in df.collect()}
    assert got[1] == pytest.approx((3.0, 2.0)) and got[2] == pytest.approx(((0.5 * 1 + 11.5 * 3) / 4, 0.5))
    assert got[3] == (None, None) and got[4] == (None, None)


def test_outer_ring_by_type(spark):
    multi = {"type": "MultiPolygon", "coordinates": [[box(5, 5), box(6, 6)], [box(0, 0)]]}
    df = geo(spark, [(1, polygon(box(1, 1), box(2, 2))), (2, multi), (3, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]})])
    got = {r.grid_id: r.ring for r in df.select("grid_id", g.outer_ring("geometry").alias("ring")).collect()}
    assert got[1][0] == [1.0, 1.0] and got[2][0] == [5.0, 5.0] and got[3] is None


def test_geojson_lookup(spark, fresh):
    doc = {
        "type": "FeatureCollection",
        "features": [{"type": "Feature", "properties": {"cellId": i}, "geometry": polygon(box(i, 0))} for i in (1, 2)],
    }
    (fresh / "grid.geojson").write_text(json.dumps(doc, indent=1))
    got = read_geojson_lookup(spark, str(fresh / "grid.geojson"))
    assert {r.grid_id: json.loads(r.geometry)["coordinates"][0][0] for r in got.collect()} == {1: [1, 0], 2: [2, 0]}
    (fresh / "lines.json").write_text("\n".join(json.dumps({"features": [f]}) for f in doc["features"]))
    assert read_geojson_lookup(spark, str(fresh / "lines.json"), one_per_line=True).count() == 2
    with pytest.raises(FileNotFoundError):
        read_geojson_lookup(spark, str(fresh / "absent.geojson"))


def brute(pts, k):
    out = {}
    for i, x, y in pts:
        near = sorted((round(math.hypot(x - a, y - b), 5), j) for j, a, b in pts if j != i)
        out[i] = near[:k]
    return out


def check_nearby(spark, pts, k):
    got = {}
    for r in nearby.nearby_grids(nearby.cell_centroids(points(spark, pts)), k).orderBy("grid_id", "position").collect():
        got.setdefault(r.grid_id, []).append((r.distance_degrees, r.nearby_grid_id))
    want = brute(pts, k)
    assert {i: w for i, w in want.items() if w} == got


def test_nearby_on_a_regular_grid(spark):
    check_nearby(spark, [(r * 12 + c, 9 + c * 0.003, 45 + r * 0.0021) for r in range(12) for c in range(12)], 5)


def test_nearby_with_clusters_outliers_and_copies(spark):
    rng = random.Random(11)
    pts = [(i, 9 + rng.gauss(0, 0.0003), 45 + rng.gauss(0, 0.0003)) for i in range(120)]
    pts += [(200 + i, rng.uniform(-170, 170), rng.uniform(-80, 80)) for i in range(40)]
    pts += [(300 + i, 9.5, 45.5) for i in range(60)]  # a third of the cells share one centroid
    pts += [(400 + i, 9.5 + i * 0.000004, 45.5) for i in range(8)]  # closer than the rounding
    check_nearby(spark, [(i, round(x, 6), round(y, 6)) for i, x, y in pts], 3)


def test_nearby_with_fewer_cells_than_k(spark):
    check_nearby(spark, [(1, 0.0, 0.0), (2, 100.0, 50.0), (3, -100.0, -50.0)], 5)
    check_nearby(spark, [(1, 0.0, 0.0)], 5)
    with pytest.raises(ValueError):
        nearby.nearby_grids(nearby.cell_centroids(points(spark, [(1, 0.0, 0.0)])), 21)


def test_enrichment_keeps_rows_and_both_joins_agree(spark):
    hourly = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0), (9, 4.0), (None, 5.0)], "grid_id int, total_activity double")
    cells = geo(spark, [(1, polygon(box(0, 0))), (2, polygon(box(1, 0))), (3, polygon(box(2, 0)))])
    a, b = joins.enrich_geometry(hourly, cells), joins.enrich_geometry_shuffle(hourly, cells)
    assert rows(a, *a.columns) == rows(b, *a.columns) and a.count() == 5
    cover = joins.join_coverage(a, hourly).first()
    assert (cover.rows_kept, cover.missing_grids, cover.rows_ratio) == (True, 2, 2 / 5)
    assert cover.coverage == pytest.approx(2 / 3)
    assert rows(joins.missing_geometry(hourly.where("grid_id IS NOT NULL"), cells), "grid_id") == [(9,)]


def test_shared_centroids_and_location(spark):
    cells = geo(spark, [(1, polygon(box(0, 0))), (2, polygon(box(0, 0))), (3, polygon(box(5, 0)))])
    assert nearby.distinct_centroids(cells).select("cells").first()[0] == 2
    assert nearby.distinct_centroids(cells.where("grid_id <> 2")).isEmpty()
    assert nearby.grid_location(cells, 7).isEmpty()
    assert nearby.grid_location(cells, 3).select(F.round("longitude", 6)).first()[0] == 5.8


def test_nearest_of_one_cell_equals_those_of_all(spark, tables):
    cells = tables.cells
    every = rows(nearby.nearby_grids(cells, 7).where("grid_id IN (1, 42, 13)"), "grid_id", "position", "nearby_grid_id", "distance_degrees")
    one = [r for g in (1, 42, 13) for r in rows(nearby.nearest_to(cells, g, 7), "grid_id", "position", "nearby_grid_id", "distance_degrees")]
    assert sorted(one, key=str) == every and len(one) == 14  # cell 13 has no geometry
    assert nearby.nearest_to(cells, 999_999).count() == 0
    with pytest.raises(ValueError):
        nearby.nearest_to(cells, 1, 21)


def test_windows_refuse_what_no_grid_or_hour_is(spark, tables):
    from gridops.operators.clean import activity_window

    for grid, hour, date in ((0, None, None), (10_001, None, None), (1, 24, None), (1, -1, None), (1, None, "10-01-2024")):
        with pytest.raises(ValueError):
            activity_window(tables.hourly, grid, hour=hour, date=date)
