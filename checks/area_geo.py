"""Geometry expressions, geometry joins and nearest cells."""

from pyspark.sql import functions as F

from checks.adapter import Tables, rounded
from checks.registry import query
from gridops.functions.scoring import status_label
from gridops.functions import geo as g
from gridops.operators import joins, nearby
from gridops.operators import ranking as r
from gridops.sinks.tables import build_dim_grid

_HOURLY = "h.grid_id, h.timestamp, round(h.total_activity, 4) AS total_activity, geo.geometry"


def _narrow(t: Tables):
    return rounded(t.hourly.select("grid_id", "timestamp", "total_activity"), ["total_activity"])


@query("enrich_geometry", f"SELECT {_HOURLY} FROM hourly h LEFT JOIN geo ON h.grid_id = geo.grid_id")
def enrich_geometry(t: Tables):
    return joins.enrich_geometry(_narrow(t), t.geo)


@query("enrich_geometry_shuffle", f"SELECT {_HOURLY} FROM hourly h LEFT JOIN geo ON h.grid_id = geo.grid_id")
def enrich_geometry_shuffle(t: Tables):
    return joins.enrich_geometry_shuffle(_narrow(t), t.geo)


@query(
    "join_coverage",
    "SELECT count(*) AS enriched_rows, (SELECT count(*) FROM hourly) AS hourly_rows, "
    "count(DISTINCT h.grid_id) FILTER (WHERE geometry IS NULL) AS missing_grids, "
    "round(count(DISTINCT h.grid_id) FILTER (WHERE geometry IS NOT NULL) / count(DISTINCT h.grid_id), 6) AS coverage, "
    "round(count(DISTINCT h.grid_id) FILTER (WHERE geometry IS NOT NULL) / count(*), 6) AS rows_ratio, "
    "count(*) = (SELECT count(*) FROM hourly) AS rows_kept FROM hourly h LEFT JOIN geo ON h.grid_id = geo.grid_id",
)
def join_coverage(t: Tables):
    return rounded(joins.join_coverage(joins.enrich_geometry(t.hourly, t.geo), t.hourly), ["coverage", "rows_ratio"], 6)


@query("missing_geometry", "SELECT DISTINCT h.grid_id FROM hourly h JOIN geo ON h.grid_id = geo.grid_id WHERE geometry IS NULL")
def missing_geometry(t: Tables):
    return joins.missing_geometry(t.hourly, t.geo)


@query("geometry_type", "SELECT grid_id, kind FROM rings")
def geometry_type(t: Tables):
    return t.geo.select("grid_id", g.geometry_type("geometry").alias("kind"))


@query("outer_ring", "SELECT grid_id, array_to_string(list_transform(ring, lambda p: printf('%.4f %.4f', p[1], p[2])), ',') AS ring FROM rings")
def outer_ring(t: Tables):
    text = F.transform(
        g.outer_ring("geometry"), lambda p: F.format_string("%.4f %.4f", F.get(p, 0), F.get(p, 1))
    )
    return t.geo.select("grid_id", F.array_join(text, ",").alias("ring"))


@query(
    "bbox_centroid",
    "SELECT grid_id, round((list_min(list_transform(ring, lambda p: p[1])) + list_max(list_transform(ring, lambda p: p[1]))) / 2, 7) AS lon, "
    "round((list_min(list_transform(ring, lambda p: p[2])) + list_max(list_transform(ring, lambda p: p[2]))) / 2, 7) AS lat FROM rings",
)
def bbox_centroid(t: Tables):
    c = t.geo.select("grid_id", g.bbox_centroid(g.outer_ring("geometry")).alias("c"))
    return c.select("grid_id", F.round("c.lon", 7).alias("lon"), F.round("c.lat", 7).alias("lat"))


@query("vertex_centroid", "SELECT grid_id, round(lon, 7) AS lon, round(lat, 7) AS lat FROM centroids")
def vertex_centroid(t: Tables):
    return rounded(nearby.cell_centroids(t.geo), ["lon", "lat"], 7)


@query(
    "area_centroid",
    "SELECT grid_id, round((ring[1][1] + ring[2][1]) / 2, 7) AS lon, round((ring[1][2] + ring[3][2]) / 2, 7) AS lat FROM rings",
)
def area_centroid(t: Tables):
    c = t.geo.select("grid_id", g.area_centroid("geometry").alias("c"))
    return c.select("grid_id", F.round("c.lon", 7).alias("lon"), F.round("c.lat", 7).alias("lat"))


@query(
    "build_dim_grid",
    "SELECT grid_id, round((ring[1][1] + ring[2][1]) / 2, 7) AS centroid_longitude, "
    "round((ring[1][2] + ring[3][2]) / 2, 7) AS centroid_latitude, geometry FROM rings",
)
def dim_grid(t: Tables):
    return rounded(build_dim_grid(t.geo), ["centroid_longitude", "centroid_latitude"], 7)


@query("grid_location", "SELECT c.grid_id, round(lon, 7) AS longitude, round(lat, 7) AS latitude, geometry FROM centroids c "
       "JOIN geo ON c.grid_id = geo.grid_id")
def grid_location(t: Tables):
    return rounded(nearby.grid_location(t.geo), ["longitude", "latitude"], 7)


@query(
    "degree_distance",
    "SELECT grid_id, round(sqrt((lon - 9.19) * (lon - 9.19) + (lat - 45.46) * (lat - 45.46)), 5) AS distance FROM centroids",
)
def degree_distance(t: Tables):
    cells = nearby.cell_centroids(t.geo)
    return cells.select("grid_id", g.degree_distance("lon", "lat", F.lit(9.19), F.lit(45.46)).alias("distance"))


@query(
    "distinct_centroids",
    "SELECT round(lon, 7) AS lon, round(lat, 7) AS lat, count(*) AS cells FROM (SELECT * FROM centroids UNION ALL "
    "SELECT * FROM centroids WHERE grid_id % 7 = 0) GROUP BY 1, 2 HAVING count(*) > 1",
)
def distinct_centroids(t: Tables):
    """Every seventh cell stands there a second time under another id."""
    again = t.geo.where("grid_id % 7 = 0").withColumn("grid_id", F.col("grid_id") + 1_000_000)
    return rounded(nearby.distinct_centroids(t.geo.union(again)), ["lon", "lat"], 7)


@query(
    "nearby_grids",
    "SELECT grid_id, CAST(position AS INTEGER) AS position, nearby_grid_id, distance_degrees FROM (SELECT *, row_number() OVER "
    "(PARTITION BY grid_id ORDER BY distance_degrees, nearby_grid_id) AS position FROM (SELECT a.grid_id, b.grid_id AS nearby_grid_id, "
    "round(sqrt((a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat)), 5) AS distance_degrees "
    "FROM centroids a JOIN centroids b ON a.grid_id <> b.grid_id WHERE a.lon IS NOT NULL AND b.lon IS NOT NULL)) WHERE position <= 5",
)
def nearby_grids(t: Tables):
    return nearby.nearby_grids(t.cells, 5)


@query(
    "nearby_grids_of_one",
    "SELECT grid_id, CAST(row_number() OVER (ORDER BY distance_degrees, nearby_grid_id) AS INTEGER) AS position, nearby_grid_id, distance_degrees "
    "FROM (SELECT a.grid_id, b.grid_id AS nearby_grid_id, round(sqrt((a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat)), 5) "
    "AS distance_degrees FROM centroids a JOIN centroids b ON a.grid_id = 42 AND b.grid_id <> 42 WHERE b.lon IS NOT NULL) "
    "ORDER BY distance_degrees, nearby_grid_id LIMIT 20",
)
def nearby_grids_of_one(t: Tables):
    return nearby.nearest_to(t.cells, 42, 20)


@query(
    "map_status",
    "SELECT geo.grid_id, geometry, coalesce(status, 'NORMAL') AS status FROM geo LEFT JOIN (SELECT grid_id, 'HIGH' AS status "
    "FROM hourly WHERE timestamp = (SELECT max(timestamp) FROM hourly) "
    "UNION SELECT grid_id, 'HIGH' FROM alerts WHERE alert_type = 'High Activity' AND timestamp = "
    "(SELECT max(timestamp) FROM alerts WHERE alert_type = 'High Activity')) w ON geo.grid_id = w.grid_id",
)
def map_status(t: Tables):
    high = t.alerts.where(F.col("alert_type") == "High Activity")
    rows = r.hotspots(t.hourly, k=None).unionByName(r.rank_alerts(high, k=None), allowMissingColumns=True)
    place = F.struct(-F.col("total_activity"), F.col("status"))
    return joins.map_status(t.geo, rows.select("grid_id", status_label("status").alias("status"), place.alias("position")))
