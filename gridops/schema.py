"""Column names, schemas and thresholds shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and limits that results depend on.
RAW_COLUMNS = ["datetime", "CellID", "countrycode", "smsin", "smsout", "callin", "callout", "internet"]
ID_COLUMNS = ["CellID", "countrycode"]
RENAMES = {
    "datetime": "timestamp",
    "CellID": "grid_id",
    "countrycode": "country_code",
    "smsin": "sms_in",
    "smsout": "sms_out",
    "callin": "call_in",
    "callout": "call_out",
}
CHANNELS = ["sms_in", "sms_out", "call_in", "call_out", "internet"]
TOTALS = ["total_sms", "total_calls", "total_activity"]
FEATURES = ["avg_activity", "activity_growth", "active_hours", "peak_ratio", "variability", "internet_share"]
FILE_PATTERN = r"^sms-call-internet-mi-(\d{4}-\d{2}-\d{2})\.csv$"
BLOCKED_PHRASES = ["confirmed congestion", "traffic volume in mb", "number of users", "root cause is"]
HIGH_ACTIVITY, ACTIVITY_SPIKE, ACTIVITY_DROP = "High Activity", "Activity Spike", "Activity Drop"
GRID_MIN, GRID_MAX = 1, 10000
WINDOW_ROWS = 24
MIN_HISTORY_ROWS = 48
ACTIVITY_FLOOR = 100.0
HIGH_RATIO, SPIKE_RATIO, DROP_RATIO = 1.5, 1.5, 0.5
ANOMALY_PERCENT = 50.0
RISK_HIGH, RISK_MEDIUM = 0.70, 0.40
LABEL_THRESHOLD = 100.0
MODEL_VERSION = "decision-tree-v1"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("datetime", T.StringType()),
        T.StructField("CellID", T.IntegerType()),
        T.StructField("countrycode", T.IntegerType()),
        T.StructField("smsin", T.DoubleType()),
        T.StructField("smsout", T.DoubleType()),
        T.StructField("callin", T.DoubleType()),
        T.StructField("callout", T.DoubleType()),
        T.StructField("internet", T.DoubleType()),
    ]
)
AUDIT_SCHEMA = "filename string, status string, row_count bigint, reason string, processed_at string"
