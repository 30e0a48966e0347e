"""As-of lookups: the newest fact at or before a probe's time, per grid.

Facts are indexed by (grid, day). A day's facts form an array that is bounded by
the fact table's key (24 hourly rows), and each day also carries the last fact of
any earlier day. A probe then needs one equi-join on (grid, day): the index holds
one row per key, so a key that most probes share can be split by AQE or met by a
broadcast, and no window ever spans the probes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.functions.scoring import percent_score
from gridops.schema import FEATURES


def as_of(probes: DataFrame, facts: DataFrame, fact_time: str, values: list[str], key: str = "grid_id") -> DataFrame:
    """Left as-of join of ``probes(grid_id, probe_timestamp)`` to ``facts``.

    ``facts`` has one row per (key, fact_time). A probe before the first fact, or
    for an unknown grid, gets NULLs.
    """
    fact = F.struct(F.col(fact_time).alias("at"), *values)
    days = facts.groupBy(key, F.to_date(fact_time).alias("_day")).agg(F.array_sort(F.collect_list(fact)).alias("_facts"))
    asked = probes.select(key, F.to_date("probe_timestamp").alias("_day")).distinct()
    before = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.try_element_at("_facts", F.lit(-1)), ignorenulls=True).over(before)
    index = asked.join(days, [key, "_day"], "full").withColumn("_carried", carried)
    found = probes.withColumn("_day", F.to_date("probe_timestamp")).join(index, [key, "_day"], "left")
    today = F.filter("_facts", lambda f: f["at"] <= F.col("probe_timestamp"))
    hit = F.coalesce(F.try_element_at(today, F.lit(-1)), "_carried")
    return found.withColumn("_hit", hit).select(
        *probes.columns, F.col("_hit.at").alias(fact_time), *[F.col(f"_hit.{v}").alias(v) for v in values]
    )


def _feature_quality(df: DataFrame) -> DataFrame:
    missing = F.array_contains(F.array(*[F.col(c).isNull() for c in FEATURES]), True)
    return df.withColumns(
        {"data_quality": F.when(missing, "invalid").otherwise("valid"), "feature_freshness": F.lit("current")}
    )


def features_as_of(features: DataFrame, probes: DataFrame | None = None) -> DataFrame:
    """Feature row in force at each probe, or each grid's latest row without probes.

    Probes that meet no feature row are left out. Rows with a missing feature are
    returned and marked ``invalid``.
    """
    if probes is None:
        newest = features.groupBy("grid_id").agg(F.max_by(F.struct("feature_timestamp", *FEATURES), "feature_timestamp").alias("f"))
        return _feature_quality(newest.select("grid_id", "f.*"))
    found = as_of(probes, features, "feature_timestamp", FEATURES)
    return _feature_quality(found.where(F.col("feature_timestamp").isNotNull()))


def anomaly_as_of(alerts: DataFrame, probes: DataFrame | None = None) -> DataFrame:
    """Alert in force at each probe (or each grid's latest) with its percent score.

    Of several alerts at one time the first by type counts.
    """
    values = ["alert_type", "current_activity", "baseline_activity", "reason"]
    one = (
        alerts.groupBy("grid_id", "timestamp")
        .agg(F.min(F.struct(*values)).alias("a"))
        .select("grid_id", "timestamp", "a.*")
    )
    if probes is None:
        newest = one.groupBy("grid_id").agg(F.max_by(F.struct("timestamp", *values), "timestamp").alias("a"))
        found = newest.select("grid_id", "a.*")
    else:
        found = as_of(probes, one, "timestamp", values).where(F.col("timestamp").isNotNull())
    return found.withColumn("anomaly_score", percent_score("current_activity", "baseline_activity"))
