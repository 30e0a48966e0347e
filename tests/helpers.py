"""Small literal frames."""

from datetime import datetime, timedelta

CLEAN = "timestamp timestamp_ntz, grid_id int, country_code int, sms_in double, sms_out double, call_in double, call_out double, internet double"
HOURLY = "grid_id int, timestamp timestamp_ntz, total_activity double, internet double"
START = datetime(2024, 1, 1)


def at(hours: float) -> datetime:
    return START + timedelta(hours=hours)


def hourly(spark, rows):
    """rows of (grid, hour offset, activity); internet is half of it."""
    data = [(g, at(h), None if v is None else float(v), 0.0 if v is None else v / 2) for g, h, v in rows]
    return spark.createDataFrame(data, HOURLY)


def raw(spark, rows):
    return spark.createDataFrame(rows, CLEAN)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
