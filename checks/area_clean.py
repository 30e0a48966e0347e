"""Projections, filters, predicates and profiles."""

from pyspark.sql import functions as F

from checks.adapter import Tables, rounded
from checks.registry import NEGATIVE, NULL_CHANNEL, REJECTED, query
from gridops.functions.time import hours_before
from gridops.operators import clean as c
from gridops.operators import profile as p
from gridops.operators import ranking as r
from gridops.schema import BLOCKED_PHRASES, CHANNELS

_RAW = "timestamp, grid_id, country_code, sms_in, sms_out, call_in, call_out, internet"


@query(
    "rename_columns",
    "SELECT coalesce(strftime(timestamp, '%Y-%m-%d %H:%M:%S'), 'malformed') AS timestamp, grid_id, country_code, "
    "sms_in, sms_out, call_in, call_out, internet FROM raw_activity",
)
def rename_columns(t: Tables):
    return c.rename_columns(t.raw_file)


@query("coerce_types", f"SELECT {_RAW} FROM raw_activity")
def coerce_types(t: Tables):
    return c.coerce_types(c.rename_columns(t.raw_file))


@query(
    "quarantine",
    f"SELECT {_RAW}, CASE WHEN {REJECTED} THEN concat_ws(',', CASE WHEN grid_id IS NULL THEN 'null_grid' END, "
    f"CASE WHEN timestamp IS NULL THEN 'null_timestamp' END, CASE WHEN {NEGATIVE} THEN 'negative_activity' END) END "
    "AS reason FROM raw_activity",
)
def quarantine(t: Tables):
    rejected, kept = c.quarantine(t.raw)
    return rejected.unionByName(kept.withColumn("reason", F.lit(None).cast("string")))


@query("null_activity_rows", f"SELECT {_RAW} FROM raw_activity WHERE {NULL_CHANNEL}")
def null_activity_rows(t: Tables):
    return c.null_activity_rows(t.raw)


@query(
    "impute_zero",
    "SELECT timestamp, grid_id, country_code, " + ", ".join(f"coalesce({x}, 0.0) AS {x}" for x in CHANNELS) + " FROM kept",
)
def impute_zero(t: Tables):
    return c.impute_zero(t.kept)


@query("derive_totals", f"SELECT {_RAW}, round(total_sms, 4) AS total_sms, round(total_calls, 4) AS total_calls, "
       "round(total_activity, 4) AS total_activity FROM clean")
def derive_totals(t: Tables):
    return rounded(c.derive_totals(c.impute_zero(t.kept)), ["total_sms", "total_calls", "total_activity"])


@query("derive_calendar", "SELECT timestamp, grid_id, date, hour, day_of_week FROM clean")
def derive_calendar(t: Tables):
    return c.derive_calendar(t.kept.select("timestamp", "grid_id"))


@query(
    "internet_share",
    "SELECT grid_id, timestamp, round(internet / nullif(total_activity, 0), 6) AS internet_share FROM hourly",
)
def internet_share(t: Tables):
    return rounded(c.internet_share(t.hourly), ["internet_share"], 6).select("grid_id", "timestamp", "internet_share")


@query("select_columns", "SELECT timestamp, grid_id, internet FROM raw_activity")
def select_columns(t: Tables):
    return c.select_columns(t.raw, ["timestamp", "grid_id", "internet"])


@query("filter_compare", f"SELECT {_RAW} FROM raw_activity WHERE internet > 30")
def filter_compare(t: Tables):
    return c.filter_compare(t.raw, "internet", ">", 30)


@query("filter_isin", f"SELECT {_RAW} FROM raw_activity WHERE country_code IN (39, 1)")
def filter_isin(t: Tables):
    return c.filter_isin(t.raw, "country_code", [39, 1])


@query("require_columns", f"SELECT {_RAW} FROM raw_activity")
def require_columns(t: Tables):
    return c.require_columns(t.raw, ["timestamp", "grid_id", *CHANNELS])


@query("reject_negative", f"SELECT {_RAW} FROM kept")
def reject_negative(t: Tables):
    return c.reject_negative(t.kept)


@query("reject_negative_count", f"SELECT count(*) AS rows FROM raw_activity WHERE {NEGATIVE}")
def reject_negative_count(t: Tables):
    """Over rows that hold negative values: the number that the error names."""
    try:
        c.reject_negative(t.raw)
    except ValueError as error:
        return t.spark.createDataFrame([(int(str(error).split()[0]),)], "rows bigint")
    return t.spark.createDataFrame([(0,)], "rows bigint")


@query("drop_null_keys", f"SELECT {_RAW} FROM raw_activity WHERE grid_id IS NOT NULL AND timestamp IS NOT NULL")
def drop_null_keys(t: Tables):
    return c.drop_null_keys(t.raw)


@query(
    "null_key_count",
    "SELECT count(*) FILTER (WHERE grid_id IS NULL OR timestamp IS NULL) AS dropped, "
    "count(*) FILTER (WHERE grid_id IS NOT NULL AND timestamp IS NOT NULL) AS kept FROM raw_activity",
)
def null_key_count(t: Tables):
    return c.null_key_count(t.raw)


@query("valid_grid", "SELECT grid_id, probe_timestamp FROM probes WHERE grid_id BETWEEN 1 AND 10000")
def valid_grid(t: Tables):
    return c.valid_grid(t.probes)


_HOUR = "timestamp, grid_id, sms_in, sms_out, call_in, call_out, internet, round(total_sms, 4) AS total_sms, " \
    "round(total_calls, 4) AS total_calls, round(total_activity, 4) AS total_activity"


_LAST_DAY = "timestamp BETWEEN (SELECT max(timestamp) FROM hourly) - INTERVAL 23 HOUR AND (SELECT max(timestamp) FROM hourly)"
_MORNING = "timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 09:00:00'"


@query(
    "activity_window",
    f"SELECT {_HOUR} FROM hourly WHERE {_LAST_DAY} AND grid_id = (SELECT grid_id FROM hourly WHERE {_LAST_DAY} "
    "GROUP BY grid_id ORDER BY count(*) DESC, grid_id LIMIT 1)",
)
def activity_window(t: Tables):
    """The last day of the grid that reported most often in it."""
    end = t.hourly.agg(F.max("timestamp")).scalar()
    often = t.hourly.where(F.col("timestamp").between(hours_before(end), end)).groupBy("grid_id").count()
    grid = often.orderBy(F.desc("count"), "grid_id").first()["grid_id"]
    return rounded(c.activity_window(t.hourly, grid, last_grid=t.last_grid), ["total_sms", "total_calls", "total_activity"])


@query(
    "activity_window_hour",
    f"SELECT {_HOUR} FROM hourly WHERE (timestamp, grid_id) IN (SELECT timestamp, grid_id FROM hourly WHERE {_MORNING} ORDER BY timestamp, grid_id LIMIT 1)",
)
def activity_window_hour(t: Tables):
    """One hour of one grid: the first that reported on a morning."""
    start, end = (F.lit(f"2024-01-10 0{h}:00:00").cast("timestamp_ntz") for h in (0, 9))
    first = t.hourly.where(F.col("timestamp").between(start, end)).agg(F.min(F.struct("timestamp", "grid_id"))).first()[0]
    hour = first["timestamp"].hour
    rows = c.activity_window(t.hourly, first["grid_id"], as_of="2024-01-10 09:00:00", date="2024-01-10", hour=hour, last_grid=t.last_grid)
    return rounded(rows, ["total_sms", "total_calls", "total_activity"])


_ALERT = "grid_id, timestamp, alert_type, round(current_activity, 4) AS current_activity, " \
    "round(baseline_activity, 4) AS baseline_activity, reason"


@query("filter_alerts", f"SELECT {_ALERT} FROM latest_alerts")
def filter_alerts(t: Tables):
    return rounded(c.filter_alerts(t.alerts, severity="all"), ["current_activity", "baseline_activity"])


@query(
    "filter_alerts_severity",
    f"SELECT {_ALERT} FROM alerts WHERE timestamp = TIMESTAMP '2024-01-10 12:00:00' AND alert_type = 'High Activity'",
)
def filter_alerts_severity(t: Tables):
    rows = c.filter_alerts(t.alerts, as_of="2024-01-10 12:00:00", severity="HIGH")
    return rounded(rows, ["current_activity", "baseline_activity"])


@query(
    "status_label",
    "SELECT o_orderkey, CASE WHEN contains(upper(o_orderpriority), 'HIGH') THEN 'HIGH' "
    "WHEN contains(upper(o_orderpriority), 'MEDIUM') THEN 'ATTENTION' ELSE 'NORMAL' END AS status FROM orders",
)
def status_label(t: Tables):
    return c.with_status(t.table("orders"), "o_orderpriority").select("o_orderkey", "status")


#: Everyday phrases beside the blocked ones, so that the check meets hits.
PHRASES = [*BLOCKED_PHRASES, "license", "of the", "by the"]


@query(
    "blocked_phrases",
    "SELECT doc_id, array_to_string(list_filter(["
    + ", ".join(f"'{x}'" for x in PHRASES)
    + "], lambda p: contains(lower(text), p)), '|') AS phrases FROM documents",
)
def blocked_phrases(t: Tables):
    found = c.blocked_phrases(t.table("documents"), "text", PHRASES)
    return found.select("doc_id", F.array_join("phrases", "|").alias("phrases"))


@query(
    "validate_feature_ranges",
    "SELECT grid_id, feature_timestamp, concat_ws('|', "
    "CASE WHEN grid_id NOT BETWEEN 1 AND 10000 THEN 'grid_id' END, CASE WHEN avg_activity < 0 THEN 'avg_activity' END, "
    "CASE WHEN active_hours NOT BETWEEN 0 AND 24 THEN 'active_hours' END, "
    "CASE WHEN peak_ratio < 0 THEN 'peak_ratio' END, CASE WHEN variability < 0 THEN 'variability' END, "
    "CASE WHEN internet_share NOT BETWEEN 0 AND 1 THEN 'internet_share' END) AS violations FROM "
    "(SELECT grid_id, feature_timestamp, avg_activity - 50 AS avg_activity, active_hours + 1 AS active_hours, "
    "peak_ratio, variability, internet_share * 4 AS internet_share FROM features)",
)
def validate_feature_ranges(t: Tables):
    # Features are shifted so that several of the rules fire.
    shifted = t.features.withColumns(
        {
            "avg_activity": F.col("avg_activity") - 50,
            "active_hours": F.col("active_hours") + 1,
            "internet_share": F.col("internet_share") * 4,
        }
    )
    checked = c.validate_feature_ranges(shifted)
    return checked.select("grid_id", "feature_timestamp", F.array_join("violations", "|").alias("violations"))


_COLUMNS = ["timestamp", "grid_id", "country_code", *CHANNELS]


def _each(select: str, columns: list[str]) -> str:
    return " UNION ALL ".join(select.format(c=x) for x in columns)


@query(
    "distinct_profile",
    _each(
        "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, "
        "count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_with_null FROM raw_activity",
        _COLUMNS,
    ),
)
def distinct_profile(t: Tables):
    return p.distinct_profile(t.raw)


@query("distinct_profile_approx")
def distinct_profile_approx(t: Tables):
    return p.distinct_profile(t.raw, approximate=True)


@query(
    "distinct_sketches",
    _each("SELECT '{c}' AS column_name, count(DISTINCT coalesce(CAST(timestamp AS DATE), DATE '1970-01-01')) AS sketches, true AS within_bound FROM raw_activity", _COLUMNS),
)
def distinct_sketches(t: Tables):
    """Sketches per date, merged: whether their estimate is within six standard deviations of the exact number."""
    dated = t.raw.withColumn("date", F.coalesce(F.to_date("timestamp"), F.lit("1970-01-01").cast("date")))
    sketches = p.distinct_sketches(dated, "date")
    told = p.sketched_profile(sketches).join(p.distinct_profile(t.raw).withColumnsRenamed({"distinct_values": "exact", "distinct_with_null": "exact_null"}), "column_name")
    room = 6 * 0.83 / 2 ** (p.SKETCH_BITS / 2)
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * room
    counts = sketches.groupBy("column_name").agg(F.count("*").alias("sketches"))
    fits = close("distinct_values", "exact") & close("distinct_with_null", "exact_null")
    return told.join(counts, "column_name").select("column_name", "sketches", fits.alias("within_bound"))


@query("time_bounds", "SELECT min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp FROM raw_activity")
def time_bounds(t: Tables):
    return p.time_bounds(t.raw)


@query("null_profile", _each("SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM raw_activity", _COLUMNS))
def null_profile(t: Tables):
    return p.null_profile(t.raw)


@query(
    "negative_profile",
    _each("SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < 0) AS negatives FROM raw_activity", _COLUMNS[1:]),
)
def negative_profile(t: Tables):
    return p.negative_profile(t.raw)


@query(
    "duplicate_rows",
    f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM raw_activity GROUP BY {_RAW})",
)
def duplicate_rows(t: Tables):
    return p.duplicate_rows(t.raw)


@query(
    "duplicate_grain",
    "SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_grain_rows FROM "
    "(SELECT count(*) AS n FROM raw_activity GROUP BY timestamp, grid_id, country_code)",
)
def duplicate_grain(t: Tables):
    return p.duplicate_grain(t.raw)


@query(
    "country_by_hour",
    "SELECT country_code, CAST(hour(timestamp) AS INTEGER) AS hour, count(DISTINCT country_code) AS countries "
    "FROM raw_activity GROUP BY 1, 2",
)
def country_by_hour(t: Tables):
    return p.country_by_hour(t.raw)


@query(
    "cadence_files",
    "SELECT count(DISTINCT CAST(timestamp AS DATE)) AS sources, count(DISTINCT timestamp) AS timestamps, "
    "count(DISTINCT CAST(timestamp AS DATE)) * 24 = count(DISTINCT timestamp) AS complete FROM raw_activity",
)
def cadence_files(t: Tables):
    return p.cadence_files(t.raw, F.to_date("timestamp"))


_STEPS = (
    "(SELECT timestamp, CAST(timestamp AS DATE) AS date, epoch(timestamp) - epoch(lag(timestamp) OVER "
    "(PARTITION BY CAST(timestamp AS DATE) ORDER BY timestamp)) AS step FROM "
    "(SELECT DISTINCT timestamp FROM raw_activity WHERE timestamp IS NOT NULL))"
)


@query(
    "cadence_gaps",
    "SELECT date, count(*) AS stamps, count(*) FILTER (WHERE step = 3600) AS hour_steps, "
    f"count(*) = 24 AND count(*) FILTER (WHERE step = 3600) = 23 AS complete FROM {_STEPS} GROUP BY date",
)
def cadence_gaps(t: Tables):
    return p.cadence_gaps(t.raw)


@query(
    "timestamp_gaps",
    "SELECT timestamp, previous, CAST(epoch(timestamp) - epoch(previous) AS BIGINT) AS gap_seconds FROM "
    "(SELECT timestamp, lag(timestamp) OVER (ORDER BY timestamp) AS previous FROM "
    "(SELECT DISTINCT timestamp FROM raw_activity WHERE timestamp IS NOT NULL))",
)
def timestamp_gaps(t: Tables):
    return p.timestamp_gaps(t.raw)


@query(
    "cleaning_report",
    f"SELECT count(*) AS rows_before, count(*) FILTER (WHERE NOT {REJECTED}) AS rows_after, "
    f"count(*) FILTER (WHERE {REJECTED}) AS rejected, count(*) FILTER (WHERE {NULL_CHANNEL}) AS null_activity FROM raw_activity",
)
def cleaning_report(t: Tables):
    return p.cleaning_report(t.raw)


@query(
    "check_unique_key",
    "SELECT timestamp, grid_id, country_code, count(*) AS n FROM raw_activity "
    "GROUP BY timestamp, grid_id, country_code HAVING count(*) > 1",
)
def check_unique_key(t: Tables):
    return p.check_unique_key(t.raw, ["timestamp", "grid_id", "country_code"])


@query("check_unique_key_hourly", "SELECT timestamp, grid_id, count(*) AS n FROM hourly GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique_key_hourly(t: Tables):
    return p.check_unique_key(t.hourly, ["timestamp", "grid_id"])


@query("distinct_rows", "SELECT DISTINCT grid_id, country_code FROM raw_activity")
def distinct_rows(t: Tables):
    return r.distinct_rows(t.raw, ["grid_id", "country_code"])
