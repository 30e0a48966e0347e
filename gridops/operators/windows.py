"""Per-grid window functions.

The hourly table holds one row per (grid, hour), so a grid's series is bounded by
the hours of history (8,760 rows a year) however much raw activity the grid had:
a busy grid is no bigger a window partition than a quiet one. Spark streams row
frames over the sorted partition and spills, so memory stays flat. Windows that
share a partitioning share one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridops.functions.time import epoch_seconds
from gridops.schema import FEATURES, MIN_HISTORY_ROWS, WINDOW_ROWS


def series() -> WindowSpec:
    """A grid's rows by time."""
    return Window.partitionBy("grid_id").orderBy("timestamp")


def in_day() -> WindowSpec:
    """A grid's rows of one date by time."""
    return Window.partitionBy("date", "grid_id").orderBy("timestamp")


def trailing(frame: str = "rows", size: int = WINDOW_ROWS) -> WindowSpec:
    """The current row and the 23 before it (``rows``), or the last 24 hours (``time``)."""
    if frame == "rows":
        return series().rowsBetween(-(size - 1), 0)
    if frame == "time":
        by_clock = Window.partitionBy("grid_id").orderBy(epoch_seconds("timestamp"))
        return by_clock.rangeBetween(-(size - 1) * 3600, 0)
    raise ValueError(f"frame must be 'rows' or 'time', not {frame!r}")


def trailing_mean(w: WindowSpec) -> Column:
    return F.avg("total_activity").over(w)


def trailing_active_hours(w: WindowSpec) -> Column:
    return F.sum(F.when(F.col("total_activity") > 0, 1).otherwise(0)).over(w)


def trailing_peak_ratio(w: WindowSpec) -> Column:
    mean = trailing_mean(w)
    return F.when(mean > 0, F.max("total_activity").over(w) / mean).otherwise(0.0)


def trailing_variability(w: WindowSpec) -> Column:
    return F.stddev_samp("total_activity").over(w)


def trailing_internet_share(w: WindowSpec) -> Column:
    total = F.sum("total_activity").over(w)
    return F.when(total > 0, F.sum("internet").over(w) / total).otherwise(0.0)


def day_before(size: int = WINDOW_ROWS) -> WindowSpec:
    """The 24 hours before the last 24 hours."""
    by_clock = Window.partitionBy("grid_id").orderBy(epoch_seconds("timestamp"))
    return by_clock.rangeBetween(-(2 * size - 1) * 3600, -size * 3600)


def activity_growth(recent: str = "recent_activity", lag: int = WINDOW_ROWS, frame: str = "rows") -> Column:
    """Trailing sum against the one ``lag`` rows, or in a ``time`` frame hours, earlier; 0 without a positive one."""
    earlier = F.sum("total_activity").over(day_before(lag)) if frame == "time" else F.lag(recent, lag).over(series())
    return F.when(earlier > 0, (F.col(recent) - earlier) / earlier).otherwise(0.0)


def min_history(df: DataFrame, rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Number the rows of each grid by time and keep those from number ``rows`` on."""
    return df.withColumn("row_number", F.row_number().over(series())).where(F.col("row_number") >= rows)


def trailing_stats(hourly: DataFrame, frame: str = "rows") -> DataFrame:
    """Add every trailing measure and the row number; one exchange, one sort."""
    w = trailing(frame)
    stats = hourly.withColumns(
        {
            "row_number": F.row_number().over(series()),
            "avg_activity": trailing_mean(w),
            "active_hours": trailing_active_hours(w),
            "peak_ratio": trailing_peak_ratio(w),
            "variability": trailing_variability(w),
            "internet_share": trailing_internet_share(w),
            "recent_activity": F.sum("total_activity").over(w),
        }
    )
    return stats.withColumn("activity_growth", activity_growth(frame=frame))


def build_features(hourly: DataFrame, frame: str = "rows", min_rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Feature table keyed by (grid_id, feature_timestamp), rows with enough history only."""
    narrow = hourly.select("grid_id", "timestamp", "internet", "total_activity")
    rows = trailing_stats(narrow, frame).where(F.col("row_number") >= min_rows)
    return rows.select("grid_id", F.col("timestamp").alias("feature_timestamp"), *FEATURES)


def lead_activity(hourly: DataFrame) -> DataFrame:
    """Add ``future_activity``: the grid's next row."""
    return hourly.withColumn("future_activity", F.lead("total_activity", 1).over(series()))


def previous_in_day(df: DataFrame) -> DataFrame:
    """Add ``previous_activity``: the row before within the same date and grid."""
    return df.withColumn("previous_activity", F.lag("total_activity").over(in_day()))


def leave_one_out_median(df: DataFrame) -> DataFrame:
    """Add ``baseline_activity``: median of the *other* rows of the same date and grid.

    Leaving one row out moves the median by at most one place, so three values
    around the middle of the sorted group and the row's own rank decide it. No
    group is ever collected; the windows stream over one sort of (date, grid, value).
    """
    group = Window.partitionBy("date", "grid_id")
    value = F.col("total_activity")
    rank = F.row_number().over(group.orderBy(F.asc_nulls_last("total_activity")))
    ranked = df.withColumns({"_rank": rank, "_n": F.count(value).over(group)})
    n, r = F.col("_n"), F.when(value.isNotNull(), F.col("_rank"))
    half = F.floor(n / 2)

    def ranked_value(k) -> Column:
        return F.max(F.when(F.col("_rank") == k, value)).over(group)

    middle = ranked.withColumns({"_a": ranked_value(half), "_b": ranked_value(half + 1), "_c": ranked_value(half + 2)})
    a, b, c = F.col("_a"), F.col("_b"), F.col("_c")
    even = F.when(r <= half, b).when(r > half, a).otherwise((a + b) / 2)
    odd = F.when(r <= half, (b + c) / 2).when(r == half + 1, (a + c) / 2).when(r > half + 1, (a + b) / 2).otherwise(b)
    median = F.when(n % 2 == 0, even).otherwise(odd)
    return middle.withColumn("baseline_activity", median).drop("_rank", "_n", "_a", "_b", "_c")


def prior_median(hourly: DataFrame, rows: int = WINDOW_ROWS, at_least: int = 6) -> DataFrame:
    """Add ``baseline_24h``: median of the 24 rows before, if at least 6 exist."""
    w = series().rowsBetween(-rows, -1)
    median = F.when(F.count("total_activity").over(w) >= at_least, F.percentile("total_activity", 0.5).over(w))
    return hourly.withColumn("baseline_24h", median)
