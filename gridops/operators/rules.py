"""Rule alerts and median-baseline anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.functions.scoring import alert_reason, anomaly_direction, anomaly_flag, anomaly_reason
from gridops.operators.aggregate import baseline_median
from gridops.operators.joins import compare_detectors, join_baseline
from gridops.operators.windows import leave_one_out_median, previous_in_day
from gridops.schema import (
    ACTIVITY_DROP,
    ACTIVITY_FLOOR,
    ACTIVITY_SPIKE,
    DROP_RATIO,
    HIGH_ACTIVITY,
    HIGH_RATIO,
    SPIKE_RATIO,
)


def rule_alerts(
    grid_hour: DataFrame,
    floor: float = ACTIVITY_FLOOR,
    high: float = HIGH_RATIO,
    spike: float = SPIKE_RATIO,
    drop: float = DROP_RATIO,
) -> DataFrame:
    """Up to three independent alerts per grid-hour at or above ``floor``.

    Ratios are compared by multiplication, so a zero baseline fires; a missing
    baseline or previous hour raises no alert.
    """
    rows = grid_hour.select("grid_id", "timestamp", F.to_date("timestamp").alias("date"), "total_activity")
    rows = leave_one_out_median(previous_in_day(rows)).where(F.col("total_activity") >= floor)
    current, baseline, previous = (F.col(c) for c in ("total_activity", "baseline_activity", "previous_activity"))

    def alert(condition, kind: str, base, ending: str):
        row = F.struct(F.lit(kind).alias("alert_type"), alert_reason(current, base, ending).alias("reason"))
        return F.when(condition, row)

    # Fixed wording of the three sentences; the drop sentence names the baseline its ratio uses.
    found = F.array_compact(
        F.array(
            alert(current >= baseline * high, HIGH_ACTIVITY, baseline, "the within baseline"),
            alert(current >= previous * spike, ACTIVITY_SPIKE, previous, "the previous activity"),
            alert(current <= baseline * drop, ACTIVITY_DROP, baseline, "less than the baseline activity"),
        )
    )
    return rows.withColumn("a", F.explode(found)).select(
        "grid_id",
        "timestamp",
        "a.alert_type",
        current.alias("current_activity"),
        "baseline_activity",
        "a.reason",
    )


def score_anomalies(hourly: DataFrame) -> DataFrame:
    """Hour-of-day baseline, deviation, percent score, flag, direction and reason per grid-hour.

    The baseline uses all history of the hour, later days included: this is a
    detector over stored data, not a model feature.
    """
    rows = hourly.select("grid_id", "timestamp", "total_activity")
    keyed = rows.withColumn("hour_of_day", F.hour("timestamp"))
    scored = join_baseline(rows, baseline_median(keyed, ["grid_id", "hour_of_day"]))
    return scored.select(
        "grid_id",
        "timestamp",
        "total_activity",
        "baseline_activity",
        "deviation",
        "anomaly_score",
        anomaly_flag("anomaly_score").alias("anomaly_flag"),
        anomaly_direction("anomaly_score").alias("direction"),
    ).withColumn("reason", anomaly_reason("anomaly_score", "direction"))


def detect_anomalies(
    hourly: DataFrame, predictions: DataFrame | None = None, alerts: DataFrame | None = None
) -> DataFrame:
    """Scored anomalies with the comparison to the other detectors: 13 columns."""
    return compare_detectors(score_anomalies(hourly), predictions, alerts).select(
        "grid_id",
        "timestamp",
        "total_activity",
        "baseline_activity",
        "deviation",
        "anomaly_score",
        "anomaly_flag",
        "direction",
        "reason",
        "prediction",
        "alert_flag",
        "ml3_anomaly_disagreement",
        "np3_anomaly_disagreement",
    )
