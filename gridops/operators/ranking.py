"""Top-k reports and set operations. Each ``orderBy().limit()`` runs as a per-task
top-k followed by a merge of k rows per task; nothing is sorted globally."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.functions.scoring import reason_score, status_label
from gridops.operators.aggregate import daily_grid_summary
from gridops.operators.clean import filter_alerts, latest
from gridops.operators.joins import enrich_geometry
from gridops.schema import CHANNELS, HIGH_ACTIVITY


def _by(column: str):
    # Sums tie when equal to four decimals, whatever order they were added in.
    return F.round(column, 4).desc()


def top_daily_hotspots(hourly: DataFrame, k: int = 10) -> DataFrame:
    """The k (date, grid) pairs with the highest daily total."""
    return daily_grid_summary(hourly).orderBy(_by("daily_total_activity"), "date", "grid_id").limit(k)


def top_grids(hourly: DataFrame, k: int = 10) -> DataFrame:
    sums = hourly.groupBy("grid_id").agg(F.sum("total_activity").alias("total_activity"))
    return sums.orderBy(_by("total_activity"), "grid_id").limit(k)


def top_grid_hours(hourly: DataFrame, k: int = 10) -> DataFrame:
    rows = hourly.select("timestamp", "grid_id", "total_activity")
    return rows.orderBy(_by("total_activity"), "timestamp", "grid_id").limit(k)


def top_grids_geo(hourly: DataFrame, geo: DataFrame, k: int = 10) -> DataFrame:
    """Top grids with geometry: the k rows are found first, then joined."""
    return enrich_geometry(top_grids(hourly, k), geo)


def hotspots(hourly: DataFrame, as_of=None, k: int | None = 10) -> DataFrame:
    """The k most active grids at exactly ``as_of`` (default: the newest hour); all, unordered, if k is None."""
    if k is not None and k < 1:
        raise ValueError("k must be at least 1")
    rows = hourly.where(F.col("timestamp") == latest(hourly, as_of))
    rows = rows.select("grid_id", "timestamp", *CHANNELS, "total_activity", F.lit(HIGH_ACTIVITY).alias("status"))
    return rows if k is None else rows.orderBy(_by("total_activity"), "grid_id").limit(k)


def hotspots_each_hour(hourly: DataFrame, k: int = 10) -> DataFrame:
    """:func:`hotspots` for every hour at once, with the rank within the hour."""
    order = Window.partitionBy("timestamp").orderBy(_by("total_activity"), "grid_id")
    ranked = hourly.select("timestamp", "grid_id", "total_activity").withColumn("position", F.row_number().over(order))
    return ranked.where(F.col("position") <= k)


def rank_alerts(alerts: DataFrame, k: int | None = 10, as_of=None, severity: str | None = None) -> DataFrame:
    """The k strongest alerts of one time; all, unordered, if k is None. Channels are reported as 0.0."""
    zeros = [F.lit(0.0).alias(c) for c in CHANNELS]
    rows = filter_alerts(alerts, as_of, severity)
    if k is not None:
        rows = rows.orderBy(F.desc("current_activity"), "grid_id", "alert_type").limit(k)
    return rows.select(
        "grid_id",
        "timestamp",
        *zeros,
        F.col("current_activity").alias("total_activity"),
        F.col("alert_type").alias("status"),
        F.col("alert_type").alias("severity"),
        "reason",
    )


def highest_anomaly_scores(alerts: DataFrame, k: int = 10, as_of=None) -> DataFrame:
    """The newest k ranked alerts by the percent score in their reason; no score sorts as -1."""
    scored = rank_alerts(alerts, k, as_of=as_of).select(
        "grid_id",
        "timestamp",
        F.col("total_activity").alias("current_activity"),
        "severity",
        reason_score("reason").alias("anomaly_score_percent"),
    )
    missing_low = F.coalesce("anomaly_score_percent", F.lit(-1.0)).desc()
    return scored.orderBy(missing_low, F.desc("current_activity"), "grid_id", "severity").limit(k)


def top_attention(scores: DataFrame, k: int = 20) -> DataFrame:
    """The k grid-hours that most need attention: by risk, then by size of the anomaly."""
    sized = scores.withColumn("anomaly_magnitude", F.coalesce(F.abs("anomaly_score"), F.lit(0.0)))
    return sized.orderBy(F.desc("risk_score"), F.desc("anomaly_magnitude"), "grid_id", "timestamp").limit(k)


def order_series(df: DataFrame) -> DataFrame:
    """Total order by (grid, time); a range-partitioned sort, only worth it for output files."""
    return df.orderBy("grid_id", "timestamp")


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def watchlist(hotspots: DataFrame, alerts: DataFrame, k: int = 10) -> DataFrame:
    """Union of hotspot and alert rows by activity, first k, with status label and position."""
    rows = hotspots.unionByName(alerts, allowMissingColumns=True)
    first = rows.orderBy(F.coalesce("total_activity", F.lit(0.0)).desc(), "grid_id", "status").limit(k)
    # The window sees the k rows that are left.
    order = Window.orderBy(F.coalesce("total_activity", F.lit(0.0)).desc(), "grid_id", "status")
    return first.select(
        F.row_number().over(order).alias("position"),
        "grid_id",
        "timestamp",
        "total_activity",
        status_label("status").alias("status"),
    )


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()
