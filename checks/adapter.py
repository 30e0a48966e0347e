"""The provided tables in the shape of activity data (see FIXTURES.md).

``events`` becomes raw activity, one row per event, with defects at fixed event
ids: missing grids, malformed timestamps, negative values. ``customer`` becomes
the cell geometry, one square cell per customer, 100 to a row. Nothing is filtered
out, so every frame grows with the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.functions.time import hour_floor
from gridops.ml.labels import label_threshold, split_chronological
from gridops.operators import clean as c
from gridops.operators.aggregate import hourly_grid_summary
from gridops.operators.joins import join_labels
from gridops.operators.nearby import cell_centroids
from gridops.operators.rules import rule_alerts, score_anomalies
from gridops.operators.windows import build_features
from gridops.schema import CHANNELS, FEATURES, RENAMES
from gridops.session import scratch_path
from gridops.sinks.writers import write_parquet

KINDS = {"sms_in": "click", "sms_out": "view", "call_in": "purchase", "call_out": "signup", "internet": "error"}
#: At the default floor of 100 the small tables hold no activity drops.
FLOOR = 20.0


class Tables:
    """Frames a query may start from; each is a lazy plan over the tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        """Raw activity with typed columns, defects included."""
        e = self.table("events")
        event = F.col("event_id")
        value = F.when(event % 199 == 0, -F.col("value")).otherwise(F.col("value"))
        return e.select(
            F.when(event % 223 != 0, hour_floor("ts")).alias("timestamp"),
            F.when(event % 211 != 0, (F.col("user_id") + 1).cast("int")).alias("grid_id"),
            F.when(event % 10 < 7, 39).otherwise(event % 5).cast("int").alias("country_code"),
            *[F.when(F.col("event_type") == kind, value).alias(name) for name, kind in KINDS.items()],
        )

    @cached_property
    def raw_file(self) -> DataFrame:
        """The same rows as a daily file holds them: raw column names, timestamps as text."""
        text = F.coalesce(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("malformed"))
        back = {new: old for old, new in RENAMES.items()}
        return self.raw.withColumn("timestamp", text).withColumnsRenamed(back)

    @cached_property
    def kept(self) -> DataFrame:
        return c.quarantine(self.raw)[1]

    @cached_property
    def clean(self) -> DataFrame:
        return c.derive_calendar(c.derive_totals(c.impute_zero(self.kept)))

    @cached_property
    def hourly(self) -> DataFrame:
        """Hourly summary with sums rounded to four decimals.

        Inputs have two decimals, so rounding restores the exact sum whatever order
        the values were added in, and both engines compare the same numbers.
        """
        sums = hourly_grid_summary(self.clean)
        return c.derive_totals(sums.withColumns({x: F.round(x, 4) for x in CHANNELS}))

    @cached_property
    def last_grid(self) -> int:
        """Highest grid of the activity: these tables' city has as many grids as ``events`` has users."""
        return self.kept.agg(F.max("grid_id")).first()[0]

    @cached_property
    def grid_hour(self) -> DataFrame:
        return self.hourly.withColumns({"date": F.to_date("timestamp"), "hour": F.hour("timestamp")})

    @cached_property
    def features(self) -> DataFrame:
        return rounded(build_features(self.hourly), [f for f in FEATURES if f != "active_hours"], 6)

    @cached_property
    def alerts(self) -> DataFrame:
        return rule_alerts(self.hourly, floor=FLOOR)

    @cached_property
    def anomalies(self) -> DataFrame:
        return score_anomalies(self.hourly)

    def stored(self) -> Tables:
        """The same tables with the hourly summary, its features and alerts written, for answers that read them many times."""
        out = Tables(self.spark, self.sf_dir)
        for name in ("hourly", "features", "alerts"):  # each from the written ones before
            path = scratch_path(self.spark, name)
            write_parquet(getattr(out, name), path)
            out.__dict__[name] = self.spark.read.parquet(path)
        return out

    @cached_property
    def cells(self) -> DataFrame:
        """Centroids of the cells, a stage table."""
        path = scratch_path(self.spark, "centroids")
        write_parquet(cell_centroids(self.geo), path)
        return self.spark.read.parquet(path)

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        """(train, test) of the labelled features, which are written first: the cut and the learners read them often."""
        path = scratch_path(self.spark, "labelled")
        write_parquet(join_labels(self.features, label_threshold(self.hourly), ["future_activity", "target"]), path)
        return split_chronological(self.spark.read.parquet(path))

    @cached_property
    def probes(self) -> DataFrame:
        """Distinct (grid, minute) of every event; some grids have no activity at all."""
        minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
        unknown = F.when(F.col("event_id") % 40 == 0, 1_000_000).otherwise(0)
        grid = (F.col("user_id") + 1 + unknown).cast("int")
        return self.table("events").select(grid.alias("grid_id"), minute.alias("probe_timestamp")).distinct()

    @cached_property
    def geo(self) -> DataFrame:
        """One cell per customer; one cell has no geometry, some are MultiPolygons."""
        key = F.col("c_custkey")
        col, row = key % 100, F.floor(key / 100)
        west, east = 9.011 + col * 0.003, 9.011 + (col + 1) * 0.003
        south, north = 45.356 + row * 0.0021, 45.356 + (row + 1) * 0.0021
        points = [west, south, east, south, east, north, west, north, west, south]
        ring = F.format_string("[[" + ",".join(["[%.4f,%.4f]"] * 5) + "]]", *points)
        grid = (key + 1).cast("int")
        polygon = F.concat(F.lit('{"type":"Polygon","coordinates":'), ring, F.lit("}"))
        multi = F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), ring, F.lit("]}"))
        geometry = F.when(grid == 13, F.lit(None)).when(grid % 50 == 0, multi).otherwise(polygon)
        return self.table("customer").select(grid.alias("grid_id"), geometry.alias("geometry"))


def rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({x: F.round(x, digits) for x in columns})
