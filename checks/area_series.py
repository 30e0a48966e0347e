"""Window functions, time expressions and as-of lookups."""

from pyspark.sql import functions as F

from checks.adapter import Tables, rounded
from checks.registry import query
from gridops.schema import FEATURES
from gridops.functions import time as tf
from gridops.operators import asof, windows


@query("min_history", "SELECT grid_id, timestamp, CAST(rn AS INTEGER) AS row_number FROM stats_24h WHERE rn >= 48")
def min_history(t: Tables):
    return windows.min_history(t.hourly.select("grid_id", "timestamp"))


def _register_trailing() -> None:
    source = {
        "trailing_mean": ("avg_activity", windows.trailing_mean),
        "trailing_peak_ratio": ("peak_ratio", windows.trailing_peak_ratio),
        "trailing_variability": ("variability", windows.trailing_variability),
        "trailing_internet_share": ("internet_share", windows.trailing_internet_share),
    }
    for name, (column, f) in source.items():
        sql = f"SELECT grid_id, timestamp, round({column}, 6) AS {column} FROM stats_24h"

        def run(t: Tables, f=f, column=column):
            return t.hourly.select("grid_id", "timestamp", F.round(f(windows.trailing()), 6).alias(column))

        query(name, sql)(run)


_register_trailing()


@query("trailing_active_hours", "SELECT grid_id, timestamp, CAST(active_hours AS BIGINT) AS active_hours FROM stats_24h")
def trailing_active_hours(t: Tables):
    active = windows.trailing_active_hours(windows.trailing())
    return t.hourly.select("grid_id", "timestamp", active.alias("active_hours"))


@query("activity_growth", "SELECT grid_id, timestamp, round(activity_growth, 6) AS activity_growth FROM stats_24h")
def activity_growth(t: Tables):
    recent = t.hourly.select("grid_id", "timestamp", F.sum("total_activity").over(windows.trailing()).alias("recent_activity"))
    return recent.select("grid_id", "timestamp", F.round(windows.activity_growth(), 6).alias("activity_growth"))


@query("build_features", "SELECT * FROM features")
def build_features(t: Tables):
    return t.features


@query(
    "build_features_time",
    "SELECT grid_id, timestamp AS feature_timestamp, round(avg(total_activity) OVER w, 6) AS avg_activity, "
    "CAST(sum(CASE WHEN total_activity > 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS active_hours, "
    "round(stddev_samp(total_activity) OVER w, 6) AS variability, "
    "round(CASE WHEN avg(total_activity) OVER w > 0 THEN max(total_activity) OVER w / avg(total_activity) OVER w ELSE 0 END, 6) "
    "AS peak_ratio, round(CASE WHEN sum(total_activity) OVER w > 0 THEN sum(internet) OVER w / sum(total_activity) OVER w ELSE 0 END, 6) "
    "AS internet_share, round(CASE WHEN sum(total_activity) OVER e > 0 THEN "
    "(sum(total_activity) OVER w - sum(total_activity) OVER e) / sum(total_activity) OVER e ELSE 0 END, 6) AS activity_growth "
    "FROM hourly WINDOW w AS (PARTITION BY grid_id ORDER BY timestamp RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW), "
    "e AS (PARTITION BY grid_id ORDER BY timestamp RANGE BETWEEN INTERVAL 47 HOUR PRECEDING AND INTERVAL 24 HOUR PRECEDING)",
)
def build_features_time(t: Tables):
    rows = windows.build_features(t.hourly, frame="time", min_rows=1)
    return rounded(rows, [f for f in FEATURES if f != "active_hours"], 6)


@query(
    "lead_activity",
    "SELECT grid_id, timestamp, round(lead(total_activity) OVER (PARTITION BY grid_id ORDER BY timestamp), 4) "
    "AS future_activity FROM hourly",
)
def lead_activity(t: Tables):
    return rounded(windows.lead_activity(t.hourly), ["future_activity"]).select("grid_id", "timestamp", "future_activity")


@query("previous_in_day", "SELECT grid_id, timestamp, round(previous_activity, 4) AS previous_activity FROM others")
def previous_in_day(t: Tables):
    rows = windows.previous_in_day(t.grid_hour)
    return rounded(rows, ["previous_activity"]).select("grid_id", "timestamp", "previous_activity")


@query("leave_one_out_median", "SELECT grid_id, timestamp, round(baseline_activity, 4) AS baseline_activity FROM others")
def leave_one_out_median(t: Tables):
    rows = windows.leave_one_out_median(t.grid_hour)
    return rounded(rows, ["baseline_activity"]).select("grid_id", "timestamp", "baseline_activity")


@query(
    "prior_median",
    "SELECT grid_id, timestamp, CASE WHEN n >= 6 THEN round(m, 4) END AS baseline_24h FROM (SELECT grid_id, timestamp, "
    "count(*) OVER w AS n, median(total_activity) OVER w AS m FROM hourly WINDOW w AS (PARTITION BY grid_id "
    "ORDER BY timestamp ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))",
)
def prior_median(t: Tables):
    return rounded(windows.prior_median(t.hourly), ["baseline_24h"]).select("grid_id", "timestamp", "baseline_24h")


@query("time_key", "SELECT ts, CAST(floor(epoch(ts)) AS BIGINT) AS time_key FROM events")
def time_key(t: Tables):
    return t.table("events").select("ts", tf.time_key("ts").alias("time_key"))


@query(
    "date_hour_to_ts",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 3 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) "
    "+ to_hours(CAST(o_custkey % 24 AS INTEGER)) END AS timestamp FROM orders",
)
def date_hour_to_ts(t: Tables):
    text = F.when(F.col("o_orderkey") % 10 != 3, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("2024-13-45")
    made = tf.date_hour_to_ts(text, (F.col("o_custkey") % 24).cast("int"))
    return t.table("orders").select("o_orderkey", made.alias("timestamp"))


@query("hours_before", "SELECT event_id, ts - INTERVAL 23 HOUR AS earlier FROM events")
def hours_before(t: Tables):
    return t.table("events").select("event_id", tf.hours_before("ts").alias("earlier"))


@query("strip_offset", "SELECT event_id, date_trunc('second', ts) AS wall FROM events")
def strip_offset(t: Tables):
    offset = F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 1, "+02:00").otherwise("")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset)
    return t.table("events").select("event_id", tf.strip_offset(iso).alias("wall"))


@query("day_floor", "SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events")
def day_floor(t: Tables):
    return t.table("events").select("event_id", tf.day_floor("ts").alias("day"))


@query(
    "file_date",
    "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) END AS day FROM events",
)
def file_date(t: Tables):
    tail = F.when(F.col("event_id") % 4 == 0, ".csv.bak").otherwise(".csv")
    name = F.concat(F.lit("sms-call-internet-mi-"), F.date_format("ts", "yyyy-MM-dd"), tail)
    return t.table("events").select("event_id", tf.file_date(name).alias("day"))


_QUALITY = "'valid' AS data_quality, 'current' AS feature_freshness"


@query(
    "features_as_of",
    f"SELECT p.grid_id, p.probe_timestamp, f.* EXCLUDE (grid_id), {_QUALITY} FROM probes p "
    "ASOF JOIN features f ON p.grid_id = f.grid_id AND p.probe_timestamp >= f.feature_timestamp",
)
def features_as_of(t: Tables):
    return asof.features_as_of(t.features, t.probes)


@query(
    "features_latest",
    f"SELECT * EXCLUDE (r), {_QUALITY} FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY feature_timestamp DESC) "
    "AS r FROM features) WHERE r = 1",
)
def features_latest(t: Tables):
    return asof.features_as_of(t.features)


_EVIDENCE = (
    "SELECT p.grid_id, p.probe_timestamp, a.timestamp, a.alert_type, round(a.current_activity, 4) AS current_activity, "
    "round(a.baseline_activity, 4) AS baseline_activity, a.reason, CASE WHEN a.baseline_activity > 0 THEN "
    "round((a.current_activity - a.baseline_activity) / a.baseline_activity * 100, 6) END AS anomaly_score FROM probes p "
    "ASOF JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grid_id, timestamp ORDER BY alert_type) AS r "
    "FROM alerts) WHERE r = 1) a ON p.grid_id = a.grid_id AND p.probe_timestamp >= a.timestamp"
)


@query("anomaly_as_of", _EVIDENCE)
def anomaly_as_of(t: Tables):
    rows = rounded(asof.anomaly_as_of(t.alerts, t.probes), ["current_activity", "baseline_activity"])
    return rounded(rows, ["anomaly_score"], 6)
