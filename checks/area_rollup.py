"""Aggregations, top-k reports and set operations."""

from pyspark.sql import functions as F

from checks.adapter import Tables, rounded
from checks.registry import query
from gridops.operators import aggregate as a
from gridops.operators import ranking as r
from gridops.plans import serve
from gridops.schema import CHANNELS, TOTALS
from gridops.session import scratch_path
from gridops.sinks import tables as sink
from gridops.sinks.versioned import StoredTable

_R = ", ".join(f"round({x}, 4) AS {x}" for x in [*CHANNELS, *TOTALS])
_SUMS = ["total_calls", "total_sms", "total_activity", "internet"]
_SUM_SQL = ", ".join(f"round(sum({x}), 4) AS {x}" for x in _SUMS)


@query("hourly_grid_summary", f"SELECT timestamp, grid_id, {_R} FROM hourly")
def hourly_grid_summary(t: Tables):
    return rounded(a.hourly_grid_summary(t.clean), [*CHANNELS, *TOTALS])


@query("grid_time_summary", f"SELECT date, hour, grid_id, {_R} FROM grid_hour")
def grid_time_summary(t: Tables):
    return rounded(a.grid_time_summary(t.kept), [*CHANNELS, *TOTALS])


@query(
    "daily_grid_summary",
    "SELECT CAST(timestamp AS DATE) AS date, grid_id, round(sum(total_calls), 4) AS daily_total_calls, "
    "round(sum(total_sms), 4) AS daily_total_sms, round(sum(total_activity), 4) AS daily_total_activity, "
    "round(sum(internet), 4) AS daily_internet FROM hourly GROUP BY 1, 2",
)
def daily_grid_summary(t: Tables):
    sums = ["daily_total_calls", "daily_total_sms", "daily_total_activity", "daily_internet"]
    return rounded(a.daily_grid_summary(t.hourly), sums)


@query(
    "daily_network_summary",
    f"SELECT date, {_SUM_SQL}, count(DISTINCT grid_id) AS unique_grids FROM grid_hour GROUP BY date",
)
def daily_network_summary(t: Tables):
    return rounded(a.daily_network_summary(t.grid_hour), _SUMS)


@query("grid_kpis", f"SELECT grid_id, {_SUM_SQL}, count(DISTINCT hour) AS active_hours FROM grid_hour GROUP BY grid_id")
def grid_kpis(t: Tables):
    return rounded(a.grid_kpis(t.grid_hour), _SUMS)


@query(
    "grid_channel_totals",
    "SELECT grid_id, " + ", ".join(f"round(sum({x}), 4) AS {x}" for x in [*CHANNELS, *TOTALS]) + " FROM clean GROUP BY grid_id",
)
def grid_channel_totals(t: Tables):
    return rounded(a.grid_channel_totals(t.clean), [*CHANNELS, *TOTALS])


@query(
    "network_totals",
    "SELECT round(coalesce(sum(total_activity), 0), 4) AS total_activity, "
    "count(DISTINCT grid_id) FILTER (WHERE total_activity > 0) AS active_grids FROM hourly "
    "WHERE timestamp <= TIMESTAMP '2024-01-15 12:00:00'",
)
def network_totals(t: Tables):
    return rounded(a.network_totals(t.hourly, "2024-01-15 12:00:00"), ["total_activity"])


def _highest(key: str, where: str = "true") -> str:
    return (
        f"SELECT {key}, round(sum(total_activity), 4) AS total_activity FROM grid_hour WHERE {where} "
        f"GROUP BY {key} ORDER BY 2 DESC, 1 LIMIT 1"
    )


@query("peak_timestamp", _highest("timestamp"))
def peak_timestamp(t: Tables):
    return rounded(a.peak_timestamp(t.hourly), ["total_activity"])


@query("peak_hour_of_day", _highest("hour", "timestamp <= TIMESTAMP '2024-01-15 12:00:00'"))
def peak_hour_of_day(t: Tables):
    return rounded(a.peak_hour_of_day(t.hourly, "2024-01-15 12:00:00"), ["total_activity"])


@query("busiest_grid", _highest("grid_id"))
def busiest_grid(t: Tables):
    return rounded(a.busiest_grid(t.hourly), ["total_activity"])


@query(
    "baseline_median",
    "SELECT grid_id, hour, round(quantile_disc(total_activity, 0.5), 4) AS baseline_activity FROM grid_hour GROUP BY 1, 2",
)
def baseline_median(t: Tables):
    return rounded(a.baseline_median(t.grid_hour, ["grid_id", "hour"]), ["baseline_activity"])


@query(
    "baseline_median_exact",
    "SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS baseline_activity FROM lineitem GROUP BY 1",
)
def baseline_median_exact(t: Tables):
    return a.baseline_median(t.table("lineitem"), ["l_returnflag"], "l_extendedprice", exact=True)


@query("alert_counts_by_type", "SELECT alert_type, count(*) AS alerts FROM alerts GROUP BY 1")
def alert_counts_by_type(t: Tables):
    return a.alert_counts_by_type(t.alerts)


@query("alert_top_grids", "SELECT grid_id, count(*) AS alerts FROM alerts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def alert_top_grids(t: Tables):
    return a.alert_top_grids(t.alerts)


@query(
    "alert_proportion",
    "SELECT x AS alerted_grid_hours, n AS grid_hours, round(x / n, 6) AS proportion FROM "
    "(SELECT (SELECT count(*) FROM (SELECT DISTINCT grid_id, timestamp FROM alerts)) AS x, "
    "(SELECT count(*) FROM hourly) AS n)",
)
def alert_proportion(t: Tables):
    return rounded(a.alert_proportion(t.alerts, t.hourly), ["proportion"], 6)


@query(
    "history_summary",
    "SELECT grid_id, count(*) FILTER (WHERE r > 1) AS points_summarized, "
    "min(timestamp) FILTER (WHERE r > 1) AS oldest_timestamp, max(timestamp) FILTER (WHERE r > 1) AS newest_historical_timestamp, "
    "round(min(total_activity) FILTER (WHERE r > 1), 4) AS min_total_activity, "
    "round(max(total_activity) FILTER (WHERE r > 1), 4) AS max_total_activity, "
    "round(avg(total_activity) FILTER (WHERE r > 1), 2) AS avg_total_activity, "
    "CASE WHEN count(*) FILTER (WHERE r > 1) > 0 THEN CASE WHEN arg_max(total_activity, timestamp) FILTER (WHERE r > 1) > "
    "arg_min(total_activity, timestamp) FILTER (WHERE r > 1) THEN 'rising' ELSE 'falling_or_flat' END END AS trend_hint "
    "FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY timestamp DESC) AS r FROM hourly "
    "WHERE timestamp BETWEEN (SELECT max(timestamp) FROM hourly) - INTERVAL 23 HOUR AND (SELECT max(timestamp) FROM hourly)) "
    "GROUP BY grid_id",
)
def history_summary(t: Tables):
    return rounded(a.history_summary(t.hourly), ["min_total_activity", "max_total_activity"])


@query(
    "alert_history_summary",
    "SELECT g.grid_id, (SELECT count(*) FROM (SELECT 1 FROM latest_alerts LIMIT 25)) AS alerts_checked, "
    "coalesce(m.n, 0) AS matching_grid_alerts, coalesce(m.types, '') AS matching_alert_types FROM "
    "(SELECT DISTINCT grid_id FROM hourly) g LEFT JOIN (SELECT grid_id, count(*) AS n, "
    "string_agg(DISTINCT alert_type, '|' ORDER BY alert_type) AS types FROM (SELECT * FROM latest_alerts "
    "ORDER BY current_activity DESC, grid_id, alert_type LIMIT 25) GROUP BY grid_id) m ON g.grid_id = m.grid_id",
)
def alert_history_summary(t: Tables):
    rows = serve.alert_history_summary(t.alerts, t.hourly)
    return rows.withColumn("matching_alert_types", F.array_join("matching_alert_types", "|"))


@query(
    "top_daily_hotspots",
    "SELECT date, grid_id, round(sum(total_calls), 4) AS daily_total_calls, round(sum(total_sms), 4) AS daily_total_sms, "
    "round(sum(total_activity), 4) AS daily_total_activity, round(sum(internet), 4) AS daily_internet FROM grid_hour "
    "GROUP BY date, grid_id ORDER BY 5 DESC, 1, 2 LIMIT 10",
)
def top_daily_hotspots(t: Tables):
    sums = ["daily_total_calls", "daily_total_sms", "daily_total_activity", "daily_internet"]
    return rounded(r.top_daily_hotspots(t.hourly), sums)


@query("top_grids", "SELECT grid_id, round(sum(total_activity), 4) AS total_activity FROM hourly GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_grids(t: Tables):
    return rounded(r.top_grids(t.hourly), ["total_activity"])


@query(
    "top_grid_hours",
    "SELECT timestamp, grid_id, round(total_activity, 4) AS total_activity FROM hourly ORDER BY 3 DESC, 1, 2 LIMIT 10",
)
def top_grid_hours(t: Tables):
    return rounded(r.top_grid_hours(t.hourly), ["total_activity"])


@query(
    "top_grids_geo",
    "SELECT x.*, geo.geometry FROM (SELECT grid_id, round(sum(total_activity), 4) AS total_activity FROM hourly GROUP BY 1 "
    "ORDER BY 2 DESC, 1 LIMIT 10) x LEFT JOIN geo ON x.grid_id = geo.grid_id",
)
def top_grids_geo(t: Tables):
    return rounded(r.top_grids_geo(t.hourly, t.geo), ["total_activity"])


@query(
    "hotspots",
    "SELECT grid_id, timestamp, sms_in, sms_out, call_in, call_out, internet, round(total_activity, 4) AS total_activity, "
    "'High Activity' AS status FROM hourly WHERE timestamp = (SELECT max(timestamp) FROM hourly) "
    "ORDER BY 8 DESC, 1 LIMIT 10",
)
def hotspots(t: Tables):
    return rounded(r.hotspots(t.hourly), ["total_activity"])


@query(
    "hotspots_each_hour",
    "SELECT * FROM (SELECT timestamp, grid_id, round(total_activity, 4) AS total_activity, CAST(row_number() OVER "
    "(PARTITION BY timestamp ORDER BY round(total_activity, 4) DESC, grid_id) AS INTEGER) AS position FROM hourly) "
    "WHERE position <= 3",
)
def hotspots_each_hour(t: Tables):
    return rounded(r.hotspots_each_hour(t.hourly, 3), ["total_activity"])


_ZEROS = ", ".join(f"CAST(0 AS DOUBLE) AS {x}" for x in CHANNELS)


@query(
    "rank_alerts",
    f"SELECT grid_id, timestamp, {_ZEROS}, round(current_activity, 4) AS total_activity, alert_type AS status, "
    "alert_type AS severity, reason FROM (SELECT * FROM latest_alerts ORDER BY current_activity DESC, grid_id, alert_type LIMIT 10)",
)
def rank_alerts(t: Tables):
    return rounded(r.rank_alerts(t.alerts, 10), ["total_activity"])


@query(
    "highest_anomaly_scores",
    "SELECT grid_id, timestamp, round(current_activity, 4) AS current_activity, alert_type AS severity, "
    "round((TRY_CAST(regexp_extract(reason, '(\\S+?)\\s*x times', 1) AS DOUBLE) - 1) * 100, 4) AS anomaly_score_percent "
    "FROM (SELECT * FROM latest_alerts ORDER BY current_activity DESC, grid_id, alert_type LIMIT 10)",
)
def highest_anomaly_scores(t: Tables):
    return rounded(r.highest_anomaly_scores(t.alerts, 10), ["current_activity"])


@query(
    "order_series",
    "SELECT grid_id, timestamp, round(total_activity, 4) AS total_activity FROM hourly ORDER BY 1, 2",
)
def order_series(t: Tables):
    return r.order_series(rounded(t.hourly, ["total_activity"]).select("grid_id", "timestamp", "total_activity"))


@query("sample_rows", "SELECT least(count(*), 10) AS rows, least(count(*), 10) AS known FROM clean")
def sample_rows(t: Tables):
    """How many rows the sample has, and how many of them are rows of the table."""
    rows = r.sample_rows(t.clean, 10)
    same = F.xxhash64(*t.clean.columns).alias("h")
    known = rows.select(same).join(t.clean.select(same).distinct().withColumn("k", F.lit(1)), "h", "left")
    return known.agg(F.count("*").alias("rows"), F.count("k").alias("known"))


@query(
    "watchlist",
    "SELECT CAST(row_number() OVER (ORDER BY total_activity DESC, grid_id, label) AS INTEGER) AS position, grid_id, timestamp, "
    "total_activity, CASE WHEN contains(upper(label), 'HIGH') THEN 'HIGH' ELSE 'NORMAL' END AS status FROM "
    "(SELECT * FROM (SELECT * FROM (SELECT grid_id, timestamp, round(total_activity, 4) AS total_activity, 'High Activity' AS label "
    "FROM hourly WHERE timestamp = (SELECT max(timestamp) FROM hourly) ORDER BY 3 DESC, 1 LIMIT 10) "
    "UNION ALL SELECT * FROM (SELECT grid_id, timestamp, round(current_activity, 4), alert_type FROM latest_alerts "
    "ORDER BY 3 DESC, 1, 4 LIMIT 10)) ORDER BY total_activity DESC, grid_id, label LIMIT 12)",
)
def watchlist(t: Tables):
    found = r.watchlist(r.hotspots(t.hourly), r.rank_alerts(t.alerts, 10), 12)
    return rounded(found, ["total_activity"])


@query(
    "network_summary",
    "SELECT round(sum(total_activity), 4) AS total_activity, "
    "count(DISTINCT grid_id) FILTER (WHERE total_activity > 0) AS active_grids, "
    "(SELECT hour FROM grid_hour GROUP BY hour ORDER BY round(sum(total_activity), 4) DESC, hour LIMIT 1) AS peak_hour, "
    "(SELECT grid_id FROM grid_hour GROUP BY grid_id ORDER BY round(sum(total_activity), 4) DESC, grid_id LIMIT 1) AS top_grid, "
    "max(timestamp) AS as_of FROM hourly",
)
def network_summary(t: Tables):
    return rounded(serve.network_summary(t.hourly), ["total_activity"])


@query("build_dim_time", "SELECT * FROM dim_time")
def build_dim_time(t: Tables):
    return sink.build_dim_time(t.hourly)


_FACT = "grid_id, time_key, " + ", ".join(CHANNELS) + ", round(total_activity, 4) AS total_activity"


@query("build_fact", f"SELECT {_FACT} FROM fact")
def build_fact(t: Tables):
    return rounded(sink.build_fact(t.hourly), ["total_activity"])


_OLD = "(SELECT * FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, o_orderpriority, " \
    "row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_totalprice, o_orderpriority) AS r FROM orders " \
    "WHERE o_orderstatus = 'F') WHERE r = 1)"


def _orders(t: Tables, status: str):
    rows = t.table("orders").where(status)
    return rows.select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice", "o_orderpriority")


def _stored(t: Tables) -> StoredTable:
    """Finished orders (one per customer and day), a part per month."""
    table = StoredTable(t.spark, scratch_path(t.spark, "merge"), ["o_custkey", "day"], place=F.date_format("day", "yyyy-MM"))
    table.insert_ignore(_orders(t, "o_orderstatus = 'F'"), ["o_totalprice"])
    return table


_NEW = "(SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F')"
_MERGE = "o_custkey, day, o_totalprice, o_orderpriority"


@query(
    "insert_ignore",
    f"SELECT {_MERGE} FROM {_OLD} UNION ALL SELECT {_MERGE} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, day "
    f"ORDER BY o_totalprice, o_orderpriority) AS r FROM {_NEW}) n WHERE r = 1 AND NOT EXISTS "
    f"(SELECT 1 FROM {_OLD} o WHERE o.o_custkey = n.o_custkey AND o.day = n.day)",
)
def insert_ignore(t: Tables):
    table = _stored(t)
    table.insert_ignore(_orders(t, "o_orderstatus <> 'F'"), ["o_totalprice"])
    return table.read()


@query(
    "upsert",
    f"SELECT {_MERGE} FROM {_OLD} o WHERE NOT EXISTS (SELECT 1 FROM {_NEW} n WHERE o.o_custkey = n.o_custkey AND o.day = n.day) "
    f"UNION ALL SELECT {_MERGE} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, day "
    f"ORDER BY o_totalprice DESC, o_orderpriority DESC) AS r FROM {_NEW}) n WHERE r = 1",
)
def upsert(t: Tables):
    table = _stored(t)
    table.upsert(_orders(t, "o_orderstatus <> 'F'"), ["o_totalprice"])
    return table.read()


@query(
    "merge_rewrites",
    "SELECT month, count(*) AS rows, bool_or(o_orderstatus = 'P') AS rewritten, false AS rewritten_again FROM "
    "(SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month, * FROM orders WHERE o_orderstatus <> 'O') GROUP BY month",
)
def merge_rewrites(t: Tables):
    """Which months an upsert of open orders into the finished ones writes anew, and whether its repetition does."""
    key = F.xxhash64("o_orderkey", "o_custkey")
    rows = t.table("orders").select(key.alias("id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus")
    table = StoredTable(t.spark, scratch_path(t.spark, "rewrites"), ["id", "month"], place=F.col("month"))
    table.replace(rows.where("o_orderstatus = 'F'"))
    folders = [table.manifest()["places"]]
    for _ in range(2):
        table.upsert(rows.where("o_orderstatus = 'P'"))
        folders.append(table.manifest()["places"])
    # One name per month reaches the plan.
    moved = [(m, folders[0].get(m) != f, folders[1][m] != f) for m, f in folders[2].items()]
    told = t.spark.createDataFrame([(m, first, again) for m, first, again in moved], "month string, rewritten boolean, rewritten_again boolean")
    return table.read().groupBy("month").agg(F.count("*").alias("rows")).join(told, "month").select("month", "rows", "rewritten", "rewritten_again")
