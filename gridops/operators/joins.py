"""Equi-joins between activity, geometry, baselines, labels and detectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridops.functions.scoring import anomaly_score, deviation
from gridops.sources.files import join_optional


def enrich_geometry(hourly: DataFrame, geo: DataFrame) -> DataFrame:
    """Left join geometry on grid_id.

    No hint: Spark broadcasts the lookup when its statistics, or its measured size at
    run time, are below the threshold, and otherwise shuffles both.
    """
    return hourly.join(geo, "grid_id", "left")


def enrich_geometry_shuffle(hourly: DataFrame, geo: DataFrame) -> DataFrame:
    """The same join as a sort-merge join, for comparison and for lookups too large to broadcast."""
    return hourly.join(geo.hint("merge"), "grid_id", "left")


def join_coverage(enriched: DataFrame, hourly: DataFrame) -> DataFrame:
    """Whether the join kept the rows, grids without geometry, and the share of grids covered.

    ``rows_ratio`` divides covered grids by rows, the figure reported by existing dashboards.
    """
    # Roll up per grid first: both distinct counts become plain counts.
    per_grid = (
        enriched.groupBy("grid_id")
        .agg(F.count("*").alias("enriched"), F.count("geometry").alias("with_geometry"))
        .select("grid_id", "enriched", (F.col("with_geometry") > 0).alias("covered"))
    )
    rows = hourly.agg(F.count("*").alias("n")).scalar()
    known = F.col("grid_id").isNotNull()
    grids, covered = F.count_if(known), F.count_if(known & F.col("covered"))
    return per_grid.agg(
        F.coalesce(F.sum("enriched"), F.lit(0)).alias("enriched_rows"),
        F.count_if(~F.col("covered")).alias("missing_grids"),
        F.try_divide(covered, grids).alias("coverage"),
        F.try_divide(covered, F.sum("enriched")).alias("rows_ratio"),
    ).withColumns({"hourly_rows": rows, "rows_kept": F.col("enriched_rows") == rows})


def missing_geometry(hourly: DataFrame, geo: DataFrame) -> DataFrame:
    """Distinct grids that have no geometry."""
    known = geo.where(F.col("geometry").isNotNull()).select("grid_id")
    return hourly.select("grid_id").distinct().join(known, "grid_id", "left_anti")


def join_baseline(hourly: DataFrame, baseline: DataFrame) -> DataFrame:
    """Left join the hour-of-day baseline and add the deviation from it."""
    keyed = hourly.withColumn("hour_of_day", F.hour("timestamp"))
    joined = keyed.join(baseline, ["grid_id", "hour_of_day"], "left")
    return joined.withColumns(
        {
            "deviation": deviation("total_activity", "baseline_activity"),
            "anomaly_score": anomaly_score("total_activity", "baseline_activity"),
        }
    )


def join_daily_total(df: DataFrame) -> DataFrame:
    """Add the (date, grid) total to every row; a window, so the table is read once."""
    total = F.sum("total_activity").over(Window.partitionBy("date", "grid_id"))
    return df.withColumn("daily_total_activity", total)


def join_labels(features: DataFrame, hourly: DataFrame, columns: list[str]) -> DataFrame:
    """Inner join label columns of the hourly table to the features of the same grid and time."""
    labels = hourly.select("grid_id", F.col("timestamp").alias("feature_timestamp"), *columns)
    return features.join(labels, ["grid_id", "feature_timestamp"], "inner")


def join_risk_anomaly(risk: DataFrame, anomalies: DataFrame | None) -> DataFrame:
    """Left join anomaly columns to risk scores; typed NULLs when there are no anomalies."""
    types = {"anomaly_score": "double", "anomaly_flag": "int", "direction": "string", "reason": "string"}
    if anomalies is not None:
        anomalies = anomalies.withColumnRenamed("timestamp", "feature_timestamp")
    joined = join_optional(risk, anomalies, ["grid_id", "feature_timestamp"], types)
    return joined.select(
        "grid_id",
        F.col("feature_timestamp").alias("timestamp"),
        "risk_score",
        "risk_level",
        "model_version",
        *types,
    )


def compare_detectors(anomalies: DataFrame, predictions: DataFrame | None, alerts: DataFrame | None) -> DataFrame:
    """Set the anomaly flag against a model's prediction and the rule alerts.

    A disagreement is 1 where both sides exist and differ, else 0; without a
    detector its two columns are NULL. Alerts become one flag per grid-hour first,
    so several alerts of one grid-hour do not multiply rows.
    """
    keys = ["grid_id", "timestamp"]
    if alerts is not None:
        alerts = alerts.select(*keys).distinct().withColumn("alert_flag", F.lit(1))
    out = join_optional(anomalies, predictions, keys, {"prediction": "double"})
    out = join_optional(out, alerts, keys, {"alert_flag": "int"})

    def differs(column: str, present: bool) -> Column:
        if not present:
            return F.lit(None).cast("int")
        return F.when(F.col("anomaly_flag") != F.col(column), 1).otherwise(0)

    return out.withColumns(
        {
            "ml3_anomaly_disagreement": differs("prediction", predictions is not None),
            "np3_anomaly_disagreement": differs("alert_flag", alerts is not None),
        }
    )


def star_join(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Fact rows with their time attributes.

    No hint: Spark broadcasts the dimension when its statistics, or its measured
    size at run time, are below the threshold, and otherwise shuffles both.
    """
    return fact.join(dim_time, "time_key", "inner")


def map_status(geo: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Every cell with the status of its first watchlist row; NORMAL without one."""
    first = watchlist.groupBy("grid_id").agg(F.min_by("status", "position").alias("status"))
    joined = geo.select("grid_id", "geometry").join(first, "grid_id", "left")
    return joined.withColumn("status", F.coalesce("status", F.lit("NORMAL")))


def check_foreign_keys(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Per key column: fact rows whose value is absent from its dimension."""

    def orphans(key: str, dim: DataFrame) -> DataFrame:
        # Count per value first, so a hot value meets the dimension as one row.
        values = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        lost = values.join(dim.select(key).distinct(), key, "left_anti")
        return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")).select(
            F.lit(key).alias("key_name"), "orphan_rows"
        )

    return reduce(DataFrame.unionByName, [orphans(key, dim) for key, dim in dims.items()])

