"""Star schema and table maintenance as joins over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.functions.geo import area_centroid
from gridops.functions.time import parse_timestamp, time_key
from gridops.schema import AUDIT_SCHEMA, CHANNELS
from gridops.sinks.versioned import StoredTable, one_per_key


def build_dim_time(hourly: DataFrame) -> DataFrame:
    """One row per distinct timestamp with its key, date, hour and English day name."""
    stamps = hourly.select("timestamp").where(F.col("timestamp").isNotNull()).distinct()
    return stamps.select(
        time_key("timestamp").alias("time_key"),
        "timestamp",
        F.to_date("timestamp").alias("date"),
        F.hour("timestamp").alias("hour"),
        F.date_format("timestamp", "EEEE").alias("day"),
    )


def build_dim_grid(geo: DataFrame) -> DataFrame:
    """Grid, centroid longitude and latitude (in the columns their names say), geometry."""
    return geo.withColumn("c", area_centroid("geometry")).select(
        "grid_id",
        F.col("c.lon").alias("centroid_longitude"),
        F.col("c.lat").alias("centroid_latitude"),
        "geometry",
    )


def build_fact(hourly: DataFrame) -> DataFrame:
    """Activity measures keyed by grid and time key."""
    return hourly.select("grid_id", time_key("timestamp").alias("time_key"), *CHANNELS, "total_activity")


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """``target`` plus the incoming rows whose key it lacks; existing rows stay as they are.

    Of several incoming rows with one key the first by ``order_by``, then by the
    other columns, is kept. Running it again changes nothing.
    """
    fresh = one_per_key(incoming, keys, F.min, order_by or [])
    return target.unionByName(fresh.join(target.select(*keys), keys, "left_anti"))


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """``target`` with incoming rows added, replacing rows of the same key.

    Of several incoming rows with one key the last by ``order_by``, then by the
    other columns, wins. Running it again changes nothing.
    """
    latest = one_per_key(incoming, keys, F.max, order_by or [])
    return target.join(latest.select(*keys), keys, "left_anti").unionByName(latest)


def truncate_reload(df: DataFrame, path: str, timestamp_column: str = "timestamp") -> DataFrame:
    """Replace the table at ``path`` by ``df``; malformed timestamps become NULL.

    The rows are written beside the old ones and the version is switched last (see ``versioned``): a run that
    dies or fails leaves the old table, and ``df`` may be read from it. Read it with ``read_reloaded``.
    """
    table = _reloaded(df.sparkSession, path)
    table.replace(df.withColumn(timestamp_column, parse_timestamp(timestamp_column)))
    return table.read()


def read_reloaded(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``truncate_reload`` wrote last."""
    return _reloaded(spark, path).read()


def _reloaded(spark: SparkSession, path: str) -> StoredTable:
    return StoredTable(spark, path, [], place="all")


def append_audit(results: DataFrame, path: str, processed_at: str) -> DataFrame:
    """Append (filename, status, row_count, reason) rows stamped with an ISO UTC time."""
    rows = results.select("filename", "status", "row_count", "reason", F.lit(processed_at).alias("processed_at"))
    rows.write.mode("append").parquet(path)
    return results.sparkSession.read.schema(AUDIT_SCHEMA).parquet(path)
