"""Projections, filters and predicates on activity rows."""

from __future__ import annotations

from functools import reduce

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridops.functions.scoring import share, status_label
from gridops.functions.time import hours_before, parse_timestamp
from gridops.schema import BLOCKED_PHRASES, CHANNELS, GRID_MAX, GRID_MIN, RENAMES


def rename_columns(df: DataFrame, mapping: dict[str, str] = RENAMES) -> DataFrame:
    """Rename the columns that are known and keep the others."""
    return df.withColumnsRenamed(mapping)


def coerce_types(df: DataFrame) -> DataFrame:
    """Channels to DOUBLE and timestamp to TIMESTAMP_NTZ; what does not parse becomes NULL."""
    casts = {c: F.col(c).try_cast("double") for c in CHANNELS if c in df.columns}
    return df.withColumns({**casts, "timestamp": parse_timestamp("timestamp")})


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def negative_activity() -> Column:
    """True if a channel is present and below zero; never NULL."""
    return _any(F.col(c).isNotNull() & (F.col(c) < 0) for c in CHANNELS)


def is_rejected() -> Column:
    """True for a row without grid or timestamp, or with negative activity; never NULL."""
    return F.col("grid_id").isNull() | F.col("timestamp").isNull() | negative_activity()


def has_null_activity() -> Column:
    return _any(F.col(c).isNull() for c in CHANNELS)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rejected with a ``reason``, kept): an exact partition of the input rows."""
    reason = F.concat_ws(
        ",",
        F.when(F.col("grid_id").isNull(), "null_grid"),
        F.when(F.col("timestamp").isNull(), "null_timestamp"),
        F.when(negative_activity(), "negative_activity"),
    )
    return df.where(is_rejected()).withColumn("reason", reason), df.where(~is_rejected())


def null_activity_rows(df: DataFrame) -> DataFrame:
    """Rows with a missing channel; measure it before :func:`quarantine`."""
    return df.where(has_null_activity())


def impute_zero(df: DataFrame) -> DataFrame:
    return df.fillna(0.0, CHANNELS)


def derive_totals(df: DataFrame) -> DataFrame:
    """total_sms, total_calls and total_activity; a missing channel counts as 0."""
    v = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in CHANNELS}
    sms, calls = v["sms_in"] + v["sms_out"], v["call_in"] + v["call_out"]
    return df.withColumns({"total_sms": sms, "total_calls": calls, "total_activity": sms + calls + v["internet"]})


def derive_calendar(df: DataFrame) -> DataFrame:
    """date, hour and English day name of the timestamp."""
    return df.withColumns(
        {
            "date": F.to_date("timestamp"),
            "hour": F.hour("timestamp"),
            "day_of_week": F.date_format("timestamp", "EEEE"),
        }
    )


def clean(raw: DataFrame) -> DataFrame:
    """Raw file columns to clean activity: rename, coerce, quarantine, impute, derive."""
    _, kept = quarantine(coerce_types(rename_columns(raw)))
    return derive_calendar(derive_totals(impute_zero(kept)))


def internet_share(df: DataFrame) -> DataFrame:
    return df.withColumn("internet_share", share("internet", "total_activity"))


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


_COMPARE = {
    "=": Column.__eq__,
    "!=": Column.__ne__,
    "<": Column.__lt__,
    "<=": Column.__le__,
    ">": Column.__gt__,
    ">=": Column.__ge__,
}


def filter_compare(df: DataFrame, column: str, op: str, value) -> DataFrame:
    """Rows where ``column op value``; ``op`` is one of = != < <= > >=."""
    return df.where(_COMPARE[op](F.col(column), F.lit(value)))


def filter_isin(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values))


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` itself, or ValueError naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def reject_negative(df: DataFrame) -> DataFrame:
    """Strict mode: ``df`` itself, or ValueError with the number of rows that hold one."""
    columns = ["grid_id", "country_code", *CHANNELS]
    any_negative = reduce(lambda a, b: a | b, (F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns))
    total = df.agg(F.count_if(any_negative).alias("n")).first()["n"]
    if total:
        raise ValueError(f"{total} rows with negative values")
    return df


def drop_null_keys(df: DataFrame) -> DataFrame:
    """Rows with grid and timestamp; :func:`null_key_count` reports how many were dropped."""
    return df.na.drop(subset=["grid_id", "timestamp"])


def null_key_count(df: DataFrame) -> DataFrame:
    dropped = F.col("grid_id").isNull() | F.col("timestamp").isNull()
    return df.agg(F.count_if(dropped).alias("dropped"), F.count_if(~dropped).alias("kept"))


def valid_grid(df: DataFrame) -> DataFrame:
    """Rows whose grid id lies in the city grid."""
    return df.where(F.col("grid_id").between(GRID_MIN, GRID_MAX))


def latest(df: DataFrame, as_of=None, column: str = "timestamp") -> Column:
    """``as_of`` as a timestamp, or the newest one in ``df`` as a scalar subquery of the same plan."""
    if as_of is None:
        return df.agg(F.max(column).alias("latest")).scalar()
    return F.lit(as_of).cast("timestamp_ntz")


def activity_window(
    hourly: DataFrame, grid_id: int, as_of=None, date=None, hour: int | None = None, last_grid: int = GRID_MAX
) -> DataFrame:
    """Rows of one grid in the 24 hours that end at ``as_of`` (both ends in), by time.

    A grid outside of the city, an hour that is none, or a date that is none, is an error before anything is read.
    ``last_grid`` is the highest grid of the city, for tables of a larger one.
    """
    if not GRID_MIN <= grid_id <= last_grid:
        raise ValueError(f"grid_id must be between {GRID_MIN} and {last_grid}, not {grid_id}")
    if hour is not None and not 0 <= hour <= 23:
        raise ValueError(f"hour must be between 0 and 23, not {hour}")
    if isinstance(date, str):
        datetime.strptime(date, "%Y-%m-%d")
    end = latest(hourly, as_of)
    rows = hourly.where((F.col("grid_id") == grid_id) & F.col("timestamp").between(hours_before(end), end))
    if date is not None:
        rows = rows.where(F.to_date("timestamp") == F.lit(date).cast("date"))
    if hour is not None:
        rows = rows.where(F.hour("timestamp") == hour)
    return rows.orderBy("timestamp")


def filter_alerts(alerts: DataFrame, as_of=None, severity: str | None = None) -> DataFrame:
    """Alerts at exactly ``as_of`` (default: the newest alert).

    ``severity`` is an alert type or a status label (HIGH, ATTENTION); ``ALL`` in
    any case, or none, keeps every alert.
    """
    rows = alerts.where(F.col("timestamp") == latest(alerts, as_of))
    if severity is None or severity.upper() == "ALL":
        return rows
    return rows.where((F.col("alert_type") == severity) | (status_label("alert_type") == severity))


def with_status(df: DataFrame, text_column: str) -> DataFrame:
    return df.withColumn("status", status_label(text_column))


def blocked_phrases(df: DataFrame, text_column: str, phrases: list[str] = BLOCKED_PHRASES) -> DataFrame:
    """Add ``phrases``: which of the given phrases the whole text contains, case ignored."""
    lowered = F.lower(F.col(text_column))
    found = F.array_compact(F.array(*[F.when(F.contains(lowered, F.lit(p.lower())), p) for p in phrases]))
    return df.withColumn("phrases", found)


def validate_feature_ranges(features: DataFrame) -> DataFrame:
    """Add ``violations``: names of the columns missing or outside their allowed range."""
    # Inclusive bounds, None means open.
    bounds = {
        "grid_id": (GRID_MIN, GRID_MAX),
        "avg_activity": (0, None),
        "active_hours": (0, 24),
        "peak_ratio": (0, None),
        "variability": (0, None),
        "internet_share": (0, 1),
    }
    checks = []
    for name, (low, high) in bounds.items():
        bad = F.col(name).isNull() | (F.col(name) < low)
        if high is not None:
            bad = bad | (F.col(name) > high)
        checks.append(F.when(bad, name))
    checks.append(F.when(F.col("activity_growth").isNull(), "activity_growth"))
    return features.withColumn("violations", F.array_compact(F.array(*checks)))
