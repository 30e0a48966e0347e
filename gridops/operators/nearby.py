"""The k nearest cells of every cell, exact, without comparing all pairs.

Space is cut into square buckets at several levels, each half as wide as the one
above. A site searches at the level just above the finest one whose own bucket
holds k+1 sites: its k-th neighbour is then at most sqrt(2) bucket widths away,
while the 3 x 3 buckets of the search level reach two widths in each direction.
Dense areas use small buckets and sparse areas large ones. Every bucket with few
sites sends few searches, so a crowded bucket is read by a bounded number of
sites per level, whatever share of all sites it holds.

Cells with the same centroid form one site. Of a site's cells only the k+1 with
the lowest ids can be among anyone's k nearest, so copies are cut to those
exactly, and each copy reads its site's answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridops.functions.geo import degree_distance, outer_ring, vertex_centroid

ROOT_WIDTH = 512.0  # degrees: one root bucket covers all longitudes and latitudes
# Widths down to 512 / 2**24 = 3e-5 degrees (3 m). Distances are rounded to 1e-5 before
# they are compared, and at this width the search still reaches past that rounding.
FINEST_LEVEL = 24


def _bucket(axis: str, level: Column) -> Column:
    return F.floor((F.col(axis) + ROOT_WIDTH / 2) * F.pow(F.lit(2.0), level) / ROOT_WIDTH)


def cell_centroids(geo: DataFrame) -> DataFrame:
    """grid_id, lon, lat of every cell, from the mean of its ring points."""
    c = vertex_centroid(outer_ring("geometry"))
    return geo.select("grid_id", c.alias("c")).select("grid_id", F.col("c.lon").alias("lon"), F.col("c.lat").alias("lat"))


def nearby_grids(cells: DataFrame, k: int = 5) -> DataFrame:
    """(grid_id, position, nearby_grid_id, distance_degrees) for every cell, k from 1 to 20.

    ``cells`` has grid_id, lon, lat, see :func:`cell_centroids`. They are read several
    times and parsing geometry is the dear part, so pass a written table of them.
    Ordered by the rounded distance, then by id. A cell has fewer than k rows only
    when fewer than k other cells exist.
    """
    if not 1 <= k <= 20:
        raise ValueError("k must be between 1 and 20")
    cells = cells.select("grid_id", "lon", "lat").where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    ranked = cells.withColumn("r", F.row_number().over(Window.partitionBy("lon", "lat").orderBy("grid_id")))
    members = ranked.where(F.col("r") <= k + 1).drop("r")
    sites = members.groupBy("lon", "lat").agg(F.count("*").alias("n"))

    # Each site's finest level whose own bucket holds k+1 members. Levels coarser than the
    # extent of all sites would only repeat one bucket, so counting starts there.
    span = F.greatest(F.max("lon") - F.min("lon"), F.max("lat") - F.min("lat"))
    start = F.when(span > 0, F.least(F.floor(F.log2(F.lit(ROOT_WIDTH) / span)).cast("int"), F.lit(FINEST_LEVEL)))
    coarsest = sites.agg(F.coalesce(start, F.lit(0)).alias("level")).scalar()
    at_levels = sites.withColumn("level", F.explode(F.sequence(coarsest, F.lit(FINEST_LEVEL)))).withColumns(
        {"bx": _bucket("lon", F.col("level")), "by": _bucket("lat", F.col("level"))}
    )
    filled = at_levels.groupBy("level", "bx", "by").agg(F.sum("n").alias("n")).where(F.col("n") >= k + 1)
    finest = (
        at_levels.select("lon", "lat", "level", "bx", "by")
        .join(filled.drop("n"), ["level", "bx", "by"], "left_semi")
        .groupBy("lon", "lat")
        .agg(F.max("level").alias("finest"))
    )
    # A site no bucket serves (k or fewer cells in all) searches the root, which holds every cell.
    searches = sites.join(finest, ["lon", "lat"], "left").select(
        F.col("lon").alias("lon0"),
        F.col("lat").alias("lat0"),
        F.greatest(F.coalesce("finest", F.lit(0)) - 1, F.lit(0)).alias("level"),
        # No k-th neighbour is farther than this, rounding of the distance included.
        (ROOT_WIDTH * 1.4143 / F.pow(F.lit(2.0), "finest") + 2e-5).alias("reach"),
        F.col("lon"),
        F.col("lat"),
    )
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    probes = searches.withColumn("o", F.explode(around)).select(
        "lon0",
        "lat0",
        "reach",
        "level",
        (_bucket("lon", F.col("level")) + F.col("o.dx")).alias("bx"),
        (_bucket("lat", F.col("level")) + F.col("o.dy")).alias("by"),
    )
    used_levels = searches.agg(F.collect_set("level").alias("levels")).scalar()  # 25 values at most
    candidates = members.withColumn("level", F.explode(used_levels)).withColumns(
        {"bx": _bucket("lon", F.col("level")), "by": _bucket("lat", F.col("level"))}
    )
    # The plain distance drops most candidates, so few are rounded and ranked.
    dx, dy = F.col("lon0") - F.col("lon"), F.col("lat0") - F.col("lat")
    near = F.col("reach").isNull() | (dx * dx + dy * dy <= F.col("reach") * F.col("reach"))
    pairs = (
        probes.join(candidates, ["level", "bx", "by"])
        .where(near)
        .select(
            "lon0",
            "lat0",
            F.col("grid_id").alias("nearby_grid_id"),
            degree_distance("lon0", "lat0", "lon", "lat").alias("distance_degrees"),
        )
    )
    nearest = Window.partitionBy("lon0", "lat0").orderBy("distance_degrees", "nearby_grid_id")
    answers = pairs.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1)

    # Every cell reads the k+1 answers of its site, drops itself and keeps k.
    mine = cells.withColumnsRenamed({"lon": "lon0", "lat": "lat0"}).join(answers, ["lon0", "lat0"])
    others = mine.where(F.col("grid_id") != F.col("nearby_grid_id"))
    order = Window.partitionBy("grid_id").orderBy("r")
    return (
        others.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= k)
        .select("grid_id", "position", "nearby_grid_id", "distance_degrees")
    )


def nearest_to(cells: DataFrame, grid_id: int, k: int = 5) -> DataFrame:
    """The answer of :func:`nearby_grids` for one cell: one pass over the cells that keeps ``k`` rows a task.

    No row for a cell that is unknown or has no place.
    """
    if not 1 <= k <= 20:
        raise ValueError("k must be between 1 and 20")
    placed = cells.select("grid_id", "lon", "lat").where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    own = placed.where(F.col("grid_id") == grid_id).agg(F.min(F.struct("lon", "lat"))).scalar()
    told = placed.where((F.col("grid_id") != grid_id) & own.isNotNull()).select(
        F.lit(grid_id).cast(cells.schema["grid_id"].dataType).alias("grid_id"),
        F.col("grid_id").alias("nearby_grid_id"),
        degree_distance(own["lon"], own["lat"], "lon", "lat").alias("distance_degrees"),
    )
    first = told.orderBy("distance_degrees", "nearby_grid_id").limit(k)
    position = F.row_number().over(Window.partitionBy("grid_id").orderBy("distance_degrees", "nearby_grid_id"))
    return first.withColumn("position", position).select("grid_id", "position", "nearby_grid_id", "distance_degrees")


def distinct_centroids(geo: DataFrame) -> DataFrame:
    """Centroids shared by more than one cell, with how many share them; empty when all differ."""
    shared = cell_centroids(geo).groupBy("lon", "lat").agg(F.count("*").alias("cells"))
    return shared.where(F.col("cells") > 1)


def grid_location(geo: DataFrame, grid_id: int | None = None) -> DataFrame:
    """Centroid and geometry of one cell (no row if unknown) or of all."""
    rows = geo if grid_id is None else geo.where(F.col("grid_id") == grid_id)
    c = vertex_centroid(outer_ring("geometry"))
    return rows.withColumn("c", c).select(
        "grid_id", F.col("c.lon").alias("longitude"), F.col("c.lat").alias("latitude"), "geometry"
    )
