"""Answers built from several operators in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridops.operators.clean import latest
from gridops.operators.ranking import rank_alerts
from gridops.schema import FEATURES


def network_summary(hourly: DataFrame, as_of=None) -> DataFrame:
    """total_activity, active_grids, peak_hour, top_grid and as_of in one row; no row without data.

    One scan rolls activity up to (grid, hour of day), at most 24 rows per grid;
    grouping sets over that small table then feed every figure.
    """
    end = latest(hourly, as_of)
    rows = hourly.where(F.col("timestamp") <= end).select("grid_id", F.hour("timestamp").alias("hour"), "total_activity")
    cube = rows.groupBy("grid_id", "hour").agg(
        F.sum("total_activity").alias("activity"), F.max("total_activity").alias("peak")
    )
    sets = cube.groupingSets([["grid_id"], ["hour"]], "grid_id", "hour").agg(
        F.grouping("grid_id").alias("by_hour"),
        F.sum("activity").alias("activity"),
        F.max("peak").alias("peak"),
    )
    by_grid = (F.col("by_hour") == 0) & F.col("grid_id").isNotNull()
    by_hour = F.col("by_hour") == 1
    size = F.round("activity", 4)
    summary = sets.agg(
        F.sum(F.when(by_hour, F.col("activity"))).alias("total_activity"),
        F.count_if(by_grid & (F.col("peak") > 0)).alias("active_grids"),
        F.max_by("hour", F.when(by_hour, F.struct(size, -F.col("hour")))).alias("peak_hour"),
        F.max_by("grid_id", F.when(by_grid, F.struct(size, -F.col("grid_id")))).alias("top_grid"),
    )
    return summary.where(F.col("total_activity").isNotNull()).withColumn("as_of", end)


def alert_history_summary(alerts: DataFrame, grids: DataFrame, as_of=None, k: int = 25) -> DataFrame:
    """Per grid of ``grids``: what the newest ``k`` ranked alerts say about it.

    The alerts are ranked once; their ``k`` rows travel as one value.
    """
    top = rank_alerts(alerts, k, as_of=as_of)
    listed = top.agg(F.collect_list(F.struct("grid_id", "severity")).alias("top")).scalar()
    mine = F.filter("top", lambda a: a["grid_id"] == F.col("grid_id"))
    return (
        grids.select("grid_id")
        .distinct()
        .withColumn("top", listed)
        .select(
            "grid_id",
            F.size("top").cast("bigint").alias("alerts_checked"),
            F.size(mine).cast("bigint").alias("matching_grid_alerts"),
            F.array_sort(F.array_distinct(F.array_compact(F.transform(mine, lambda a: a["severity"])))).alias(
                "matching_alert_types"
            ),
        )
    )


def evidence_parts(
    grids: DataFrame, parts: dict[str, DataFrame], shared: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row per grid with each part as a struct, NULL where the part has no row.

    Every part holds at most one row per grid, so the joins neither fan out nor skew.
    ``shared`` parts say the same of every grid, such as the hotspots or the status of
    the outputs: a top-k report each, carried as a list, NULL if it is empty.
    """
    out = grids.select("grid_id").distinct()
    for name, part in parts.items():
        value = F.struct(*[c for c in part.columns if c != "grid_id"])
        out = out.join(part.select("grid_id", value.alias(name)), "grid_id", "left")
    for name, report in (shared or {}).items():
        listed = report.agg(F.collect_list(F.struct("*")).alias(name)).scalar()
        out = out.withColumn(name, F.nullif(listed, F.slice(listed, 1, 0)))
    return out


def nearby_hotspots(nearby: DataFrame, hotspots: DataFrame) -> DataFrame:
    """Per grid its nearest cells in order, and which of them are among ``hotspots``; at most 20 cells a grid."""
    hot = hotspots.select(F.col("grid_id").alias("nearby_grid_id"), F.lit(True).alias("hot")).distinct()
    rows = nearby.join(hot, "nearby_grid_id", "left").withColumn("is_hotspot", F.coalesce("hot", F.lit(False)))
    cell = F.struct("position", "nearby_grid_id", "distance_degrees", "is_hotspot")
    return rows.groupBy("grid_id").agg(
        F.array_sort(F.collect_list(cell)).alias("nearby_cells"), F.count_if("is_hotspot").alias("nearby_hotspots")
    )


def evidence_gaps(
    evidence: DataFrame, sources: dict[str, str] | None = None, needs: dict[str, str] | None = None
) -> DataFrame:
    """Add ``gaps``: evidence, source and gap (the cause) of every part a grid lacks, in column order.

    ``sources`` names the table or answer behind a part (else the part itself);
    ``needs`` names the part without which another cannot be made.
    """
    sources, needs = sources or {}, needs or {}

    def gap(part: str) -> Column:
        cause = F.lit("no rows")
        if part in needs:
            cause = F.when(F.col(needs[part]).isNull(), f"skipped, {needs[part]} is missing").otherwise(cause)
        record = F.struct(
            F.lit(part).alias("evidence"), F.lit(sources.get(part, part)).alias("source"), cause.alias("gap")
        )
        return F.when(F.col(part).isNull(), record)

    parts = [c for c in evidence.columns if c != "grid_id"]
    return evidence.withColumn("gaps", F.array_compact(F.array(*[gap(c) for c in parts])))


def evidence_package(
    evidence: DataFrame,
    history: list[str],
    sources: dict[str, str] | None = None,
    needs: dict[str, str] | None = None,
) -> DataFrame:
    """One JSON package per grid: current evidence, history summaries and what is missing.

    ``history`` names the parts that summarise the past. NULL fields are kept in
    the text, so a missing value stays visible.
    """
    current = [c for c in evidence.columns if c not in ("grid_id", *history)]
    package = F.struct(
        "grid_id",
        F.struct(*current).alias("current_evidence"),
        F.struct(*history).alias("historical_evidence"),
        F.col("gaps").alias("uncertainty"),
    )
    text = F.to_json(package, {"ignoreNullFields": "false"})
    return evidence_gaps(evidence, sources, needs).select("grid_id", text.alias("package"), "gaps")


def evidence_dump(evidence: DataFrame) -> DataFrame:
    """All collected evidence of a grid as one JSON text."""
    return evidence.select("grid_id", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("package"))


def evidence_sufficient(rows: DataFrame, as_of, stale_hours: int = 24) -> DataFrame:
    """Whether a grid's evidence supports an assessment, with the first reason against it.

    ``rows`` has current_activity, baseline_activity, anomaly_score,
    evidence_timestamp and the six features. Stale means older than
    ``stale_hours``; inconsistent means the score's sign contradicts the activity.
    """
    end = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    current, baseline, score = F.col("current_activity"), F.col("baseline_activity"), F.col("anomaly_score")
    values = [current, F.col("evidence_timestamp"), *[F.col(c) for c in FEATURES]]
    missing = F.array_contains(F.array(*[v.isNull() for v in values]), True)
    limit = end - F.make_dt_interval(F.lit(0), F.lit(stale_hours))
    reason = (
        F.when(missing, "missing value")
        .when(baseline.isNull() | (baseline <= 0), "no baseline")
        .when(F.col("evidence_timestamp") < limit, "stale")
        .when(score.isNull(), "missing value")
        .when(F.signum(score) != F.signum(current - baseline), "inconsistent")
    )
    return rows.withColumns({"insufficiency_reason": reason, "evidence_sufficient": reason.isNull()})
