"""Registry of checked queries and the shared SQL building blocks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.adapter import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under ``name``, with its SQL if SQL can say it."""

    def register(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_blocks(sql)
        return f

    return register


def with_blocks(sql: str) -> str:
    """Prefix ``sql`` with the blocks it reads, and those they read, as WITH clauses."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in BLOCKS and name not in order:
                need(BLOCKS[name])
                order.append(name)

    need(sql)
    if not order:
        return sql
    clauses = ",\n".join(f"{name} AS MATERIALIZED ({BLOCKS[name]})" for name in order)
    return f"WITH {clauses}\n{sql}"


_CHANNEL = "CASE WHEN event_type = '{kind}' THEN CASE WHEN event_id % 199 = 0 THEN -value ELSE value END END AS {name}"
_CHANNELS = {"sms_in": "click", "sms_out": "view", "call_in": "purchase", "call_out": "signup", "internet": "error"}
_SUMS = ", ".join(f"round(sum({c}), 4) AS {c}" for c in _CHANNELS)
_NULL_CHANNEL = " OR ".join(f"{c} IS NULL" for c in _CHANNELS)
NEGATIVE = "(" + " OR ".join(f"coalesce({c}, 0) < 0" for c in _CHANNELS) + ")"
REJECTED = f"(grid_id IS NULL OR timestamp IS NULL OR {NEGATIVE})"
NULL_CHANNEL = f"({_NULL_CHANNEL})"
TOTALS = (
    "sms_in + sms_out AS total_sms, call_in + call_out AS total_calls, "
    "sms_in + sms_out + (call_in + call_out) + internet AS total_activity"
)
RATIO = "CASE WHEN {b} <> 0 THEN printf('%.2f', {c} / {b}) WHEN {c} = 0 THEN 'nan' WHEN {b} = 0 THEN 'inf' END"

#: The adapter of ``checks.adapter`` and the stages downstream of it, in SQL.
BLOCKS: dict[str, str] = {
    "raw_activity": (
        "SELECT CASE WHEN event_id % 223 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS timestamp, "
        "CASE WHEN event_id % 211 = 0 THEN NULL ELSE CAST(user_id + 1 AS INTEGER) END AS grid_id, "
        "CAST(CASE WHEN event_id % 10 < 7 THEN 39 ELSE event_id % 5 END AS INTEGER) AS country_code, "
        + ", ".join(_CHANNEL.format(kind=k, name=n) for n, k in _CHANNELS.items())
        + " FROM events"
    ),
    "kept": f"SELECT * FROM raw_activity WHERE NOT {REJECTED}",
    "clean": (
        f"SELECT *, {TOTALS}, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour, "
        "dayname(timestamp) AS day_of_week FROM (SELECT timestamp, grid_id, country_code, "
        + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _CHANNELS)
        + " FROM kept)"
    ),
    "hourly": f"SELECT *, {TOTALS} FROM (SELECT timestamp, grid_id, {_SUMS} FROM clean GROUP BY timestamp, grid_id)",
    "grid_hour": (
        "SELECT *, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour FROM hourly"
    ),
    "stats_24h": (
        "SELECT *, CASE WHEN earlier > 0 THEN (recent - earlier) / earlier ELSE 0 END AS activity_growth FROM "
        "(SELECT *, lag(recent, 24) OVER (PARTITION BY grid_id ORDER BY timestamp) AS earlier FROM "
        "(SELECT grid_id, timestamp, row_number() OVER s AS rn, avg(total_activity) OVER w AS avg_activity, "
        "sum(CASE WHEN total_activity > 0 THEN 1 ELSE 0 END) OVER w AS active_hours, "
        "CASE WHEN avg(total_activity) OVER w > 0 THEN max(total_activity) OVER w / avg(total_activity) OVER w "
        "ELSE 0 END AS peak_ratio, stddev_samp(total_activity) OVER w AS variability, "
        "CASE WHEN sum(total_activity) OVER w > 0 THEN sum(internet) OVER w / sum(total_activity) OVER w "
        "ELSE 0 END AS internet_share, sum(total_activity) OVER w AS recent FROM hourly "
        "WINDOW s AS (PARTITION BY grid_id ORDER BY timestamp), "
        "w AS (PARTITION BY grid_id ORDER BY timestamp ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)))"
    ),
    "features": (
        "SELECT grid_id, timestamp AS feature_timestamp, round(avg_activity, 6) AS avg_activity, "
        "round(activity_growth, 6) AS activity_growth, CAST(active_hours AS BIGINT) AS active_hours, "
        "round(peak_ratio, 6) AS peak_ratio, round(variability, 6) AS variability, "
        "round(internet_share, 6) AS internet_share FROM stats_24h WHERE rn >= 48"
    ),
    "day_values": (
        "SELECT date, grid_id, list_sort(list(total_activity)) AS vals FROM grid_hour GROUP BY date, grid_id"
    ),
    "others": (
        "SELECT *, CASE WHEN len(rest) > 0 THEN "
        "(rest[(len(rest) + 1) // 2] + rest[len(rest) // 2 + 1]) / 2 END AS baseline_activity FROM "
        "(SELECT g.grid_id, g.timestamp, g.date, g.total_activity, "
        "lag(g.total_activity) OVER (PARTITION BY g.date, g.grid_id ORDER BY g.timestamp) AS previous_activity, "
        "list_concat(vals[1:list_position(vals, g.total_activity) - 1], "
        "vals[list_position(vals, g.total_activity) + 1:]) AS rest "
        "FROM grid_hour g JOIN day_values v ON g.date = v.date AND g.grid_id = v.grid_id)"
    ),
    "alerts": (
        "SELECT grid_id, timestamp, alert_type, total_activity AS current_activity, baseline_activity, reason FROM ("
        "SELECT *, 'High Activity' AS alert_type, 'Current activity is ' || "
        + RATIO.format(c="total_activity", b="baseline_activity")
        + " || 'x times the within baseline' AS reason FROM others WHERE total_activity >= 1.5 * baseline_activity "
        "UNION ALL SELECT *, 'Activity Spike', 'Current activity is ' || "
        + RATIO.format(c="total_activity", b="previous_activity")
        + " || 'x times the previous activity' FROM others WHERE total_activity >= 1.5 * previous_activity "
        "UNION ALL SELECT *, 'Activity Drop', 'Current activity is ' || "
        + RATIO.format(c="total_activity", b="baseline_activity")
        + " || 'x times less than the baseline activity' FROM others WHERE total_activity <= 0.5 * baseline_activity"
        ") WHERE total_activity >= 20"
    ),
    "scored": (
        "SELECT *, total_activity - baseline_activity AS deviation, CASE WHEN baseline_activity > 0 THEN "
        "(total_activity - baseline_activity) / baseline_activity * 100 ELSE 0.0 END AS anomaly_score FROM "
        "(SELECT h.grid_id, h.timestamp, h.total_activity, b.baseline_activity FROM hourly h JOIN "
        "(SELECT grid_id, hour(timestamp) AS hh, quantile_disc(total_activity, 0.5) AS baseline_activity "
        "FROM hourly GROUP BY 1, 2) b ON h.grid_id = b.grid_id AND hour(h.timestamp) = b.hh)"
    ),
    "anomalies": (
        "SELECT *, CAST(abs(anomaly_score) >= 50 AS INTEGER) AS anomaly_flag, "
        "CASE WHEN anomaly_score >= 50 THEN 'HIGH' WHEN anomaly_score <= -50 THEN 'LOW' ELSE 'NORMAL' END AS direction, "
        "CASE WHEN abs(anomaly_score) >= 50 THEN 'Activity is ' || CAST(round(abs(anomaly_score), 2) AS VARCHAR) || '% ' "
        "|| CASE WHEN anomaly_score > 0 THEN 'above' ELSE 'below' END || ' the historical baseline' "
        "ELSE 'Activity is within the historical baseline range' END AS reason FROM scored"
    ),
    "boxes": (
        "SELECT CAST(c_custkey + 1 AS INTEGER) AS grid_id, 9.011 + 0.003 * (c_custkey % 100) AS w, "
        "9.011 + 0.003 * (c_custkey % 100 + 1) AS e, 45.356 + 0.0021 * (c_custkey // 100) AS s, "
        "45.356 + 0.0021 * (c_custkey // 100 + 1) AS n FROM customer"
    ),
    "geo": (
        "SELECT grid_id, CASE WHEN grid_id = 13 THEN NULL WHEN grid_id % 50 = 0 THEN "
        "'{\"type\":\"MultiPolygon\",\"coordinates\":[' || ring || ']}' ELSE "
        "'{\"type\":\"Polygon\",\"coordinates\":' || ring || '}' END AS geometry FROM (SELECT grid_id, "
        "printf('[[[%.4f,%.4f],[%.4f,%.4f],[%.4f,%.4f],[%.4f,%.4f],[%.4f,%.4f]]]', w, s, e, s, e, n, w, n, w, s) AS ring "
        "FROM boxes)"
    ),
    "rings": (
        "SELECT grid_id, geometry, json_extract_string(geometry, '$.type') AS kind, CAST(CASE "
        "json_extract_string(geometry, '$.type') WHEN 'Polygon' THEN json_extract(geometry, '$.coordinates[0]') "
        "WHEN 'MultiPolygon' THEN json_extract(geometry, '$.coordinates[0][0]') END AS DOUBLE[][]) AS ring FROM geo"
    ),
    "centroids": (
        "SELECT grid_id, list_sum(list_transform(ring, lambda p: p[1])) / len(ring) AS lon, "
        "list_sum(list_transform(ring, lambda p: p[2])) / len(ring) AS lat FROM rings"
    ),
    "relative": (
        "SELECT *, CAST(future_activity >= 1.5 * baseline_24h AS INTEGER) AS target FROM "
        "(SELECT *, (v[(len(v) + 1) // 2] + v[len(v) // 2 + 1]) / 2 AS baseline_24h FROM "
        "(SELECT grid_id, timestamp, total_activity, "
        "list_sort(list(total_activity) OVER (PARTITION BY grid_id ORDER BY timestamp "
        "ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)) AS v, "
        "lead(total_activity) OVER (PARTITION BY grid_id ORDER BY timestamp) AS future_activity FROM hourly) "
        "WHERE len(v) >= 6) WHERE baseline_24h > 0 AND future_activity IS NOT NULL"
    ),
    "labelled": (
        "SELECT f.*, n.future_activity, CAST(n.future_activity > 100 AS INTEGER) AS target FROM features f JOIN "
        "(SELECT grid_id, timestamp, lead(total_activity) OVER (PARTITION BY grid_id ORDER BY timestamp) AS future_activity "
        "FROM hourly) n ON f.grid_id = n.grid_id AND f.feature_timestamp = n.timestamp WHERE n.future_activity IS NOT NULL"
    ),
    "split": (
        "SELECT *, CASE WHEN upto <= 0.8 * n THEN 'train' ELSE 'test' END AS part FROM (SELECT *, count(*) OVER "
        "(ORDER BY feature_timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto, count(*) OVER () AS n FROM labelled)"
    ),
    "related": (
        "SELECT *, count(*) OVER (ORDER BY feature_timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 0.8 * count(*) OVER () AS late "
        "FROM (SELECT f.*, r.target FROM features f JOIN relative r ON f.grid_id = r.grid_id AND f.feature_timestamp = r.timestamp)"
    ),
    "probes": (
        "SELECT DISTINCT CAST(user_id + 1 + CASE WHEN event_id % 40 = 0 THEN 1000000 ELSE 0 END AS INTEGER) AS grid_id, date_trunc('minute', ts) AS probe_timestamp FROM events"
    ),
    "latest_alerts": (
        "SELECT * FROM alerts WHERE timestamp = (SELECT max(timestamp) FROM alerts)"
    ),
    "fact": (
        "SELECT grid_id, CAST(epoch(timestamp) AS BIGINT) AS time_key, sms_in, sms_out, call_in, call_out, internet, "
        "total_activity FROM hourly"
    ),
    "dim_time": (
        "SELECT DISTINCT CAST(epoch(timestamp) AS BIGINT) AS time_key, timestamp, CAST(timestamp AS DATE) AS date, "
        "CAST(hour(timestamp) AS INTEGER) AS hour, dayname(timestamp) AS day FROM hourly"
    ),
    "judged": (
        "SELECT a.grid_id, a.timestamp, l.target, a.anomaly_flag AS prediction FROM anomalies a JOIN "
        "(SELECT grid_id, timestamp, CAST(lead(total_activity) OVER (PARTITION BY grid_id ORDER BY timestamp) > 100 "
        "AS INTEGER) AS target FROM hourly) l ON a.grid_id = l.grid_id AND a.timestamp = l.timestamp "
        "WHERE l.target IS NOT NULL"
    ),
}
