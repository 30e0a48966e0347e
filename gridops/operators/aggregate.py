"""Roll-ups of activity. Every one is a partial/final hash aggregate, so a hot
grid, hour or day collapses on the map side before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridops.functions.time import hours_before
from gridops.operators.clean import derive_totals, latest
from gridops.schema import CHANNELS
from gridops.session import scratch_path

_SUMS = ["total_calls", "total_sms", "total_activity", "internet"]


def hourly_grid_summary(clean: DataFrame) -> DataFrame:
    """The hub table: channels summed per (timestamp, grid), countries collapsed, plus totals."""
    return derive_totals(clean.groupBy("timestamp", "grid_id").agg(*[F.sum(c).alias(c) for c in CHANNELS]))


def grid_time_summary(df: DataFrame) -> DataFrame:
    """Channel sums per (date, hour, grid); a group of NULLs sums to 0."""
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in CHANNELS]
    keyed = df.select(F.to_date("timestamp").alias("date"), F.hour("timestamp").alias("hour"), "grid_id", *CHANNELS)
    return derive_totals(keyed.groupBy("date", "hour", "grid_id").agg(*sums))


def daily_grid_summary(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(F.to_date("timestamp").alias("date"), "grid_id").agg(
        F.sum("total_calls").alias("daily_total_calls"),
        F.sum("total_sms").alias("daily_total_sms"),
        F.sum("total_activity").alias("daily_total_activity"),
        F.sum("internet").alias("daily_internet"),
    )


def daily_network_summary(grid_hour: DataFrame) -> DataFrame:
    """Per date: four sums and the number of grids, rolled up per (date, grid) first."""
    per_grid = grid_hour.groupBy("date", "grid_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return per_grid.groupBy("date").agg(*[F.sum(c).alias(c) for c in _SUMS], F.count("grid_id").alias("unique_grids"))


def grid_kpis(grid_hour: DataFrame) -> DataFrame:
    """Per grid: four sums and the distinct hours of day it reported in (at most 24)."""
    per_hour = grid_hour.groupBy("grid_id", "hour").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return per_hour.groupBy("grid_id").agg(*[F.sum(c).alias(c) for c in _SUMS], F.count("hour").alias("active_hours"))


def grid_channel_totals(clean: DataFrame) -> DataFrame:
    return derive_totals(clean.groupBy("grid_id").agg(*[F.sum(c).alias(c) for c in CHANNELS]))


def network_totals(hourly: DataFrame, as_of=None) -> DataFrame:
    """Activity up to ``as_of`` (0 if none) and the number of grids with any."""
    rows = hourly.where(F.col("timestamp") <= latest(hourly, as_of))
    per_grid = rows.groupBy("grid_id").agg(
        F.sum("total_activity").alias("activity"), F.max("total_activity").alias("peak")
    )
    return per_grid.agg(
        F.coalesce(F.sum("activity"), F.lit(0.0)).alias("total_activity"),
        F.count_if((F.col("peak") > 0) & F.col("grid_id").isNotNull()).alias("active_grids"),
    )


def _highest(df: DataFrame, key: str | Column, name: str) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    sums = df.groupBy(key.alias(name)).agg(F.sum("total_activity").alias("total_activity"))
    # Sort on the rounded sum: equal sums must tie whatever order they were added in.
    return sums.orderBy(F.round("total_activity", 4).desc(), name).limit(1)


def peak_timestamp(hourly: DataFrame) -> DataFrame:
    return _highest(hourly, "timestamp", "timestamp")


def peak_hour_of_day(hourly: DataFrame, as_of=None) -> DataFrame:
    rows = hourly.where(F.col("timestamp") <= latest(hourly, as_of))
    return _highest(rows, F.hour("timestamp"), "hour")


def busiest_grid(hourly: DataFrame, as_of=None) -> DataFrame:
    return _highest(hourly.where(F.col("timestamp") <= latest(hourly, as_of)), "grid_id", "grid_id")


def exact_quantiles(df: DataFrame, keys: list[str], column: str, q: float, cells: int = 1024) -> DataFrame:
    """Per group ``cut``: the smallest value with a share of at least ``q`` of the non-null values at or below it.

    Every group starts from its own smallest and largest value. A round cuts that range into equal cells, counts
    the values in each and goes on with the cell that the rank falls into, cut to the values it
    has, until that is one value: values that spread evenly take two or three rounds. Only counts per
    cell are shuffled, summed up before; no step holds, sorts or windows the values of a group, and what a
    window runs over are the ``cells`` counts of one group. Ranges are written tables, one row per group.
    """
    number = F.col(column).cast("double")
    values = df.where(F.col(column).isNotNull() & ~F.isnan(number)).select(*keys, F.col(column).alias("cut"))
    names = [f"__{k}" for k in keys]
    ranges = values.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(
        F.min("cut").alias("low"), F.max("cut").alias("high"), F.greatest(F.ceil(F.count("*") * q), F.lit(1)).alias("rank")
    )
    ranges = _written(ranges, "ranges")
    found = ranges.where(F.col("low").eqNullSafe(F.col("high")))
    open_ = ranges.where(F.col("low") < F.col("high"))
    half = lambda c: F.col(c).cast("double") / 2  # noqa: E731  # the width of a range may be beyond a double
    while not open_.isEmpty():
        here = F.col("cut").between(F.col("low"), F.col("high"))
        for k, n in zip(keys, names, strict=True):
            here = here & F.col(k).eqNullSafe(F.col(n))
        share = F.try_divide(half("cut") - half("low"), half("high") - half("low"))
        cell = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * cells), F.lit(cells - 1))
        if keys:
            inside = values.join(open_, here)
        else:  # one range: its ends are scalars of the plan
            inside = values.withColumns({c: open_.agg(F.max(c)).scalar() for c in ("low", "high", "rank")}).where(here)
        counts = inside.groupBy(*names, "rank", cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min("cut").alias("low"), F.max("cut").alias("high")
        )
        upto = F.sum("n").over(Window.partitionBy(*names).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
        reached = counts.withColumn("upto", upto).where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        ranges = _written(reached.select(*names, "low", "high", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")), "ranges")
        found = found.union(ranges.where(F.col("low") == F.col("high")))
        open_ = ranges.where(F.col("low") < F.col("high"))
    return found.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], F.col("low").alias("cut"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def baseline_median(df: DataFrame, keys: list[str], column: str = "total_activity", exact: bool = False) -> DataFrame:
    """Discrete median per group over all history; the result is a value that occurs.

    ``percentile_approx`` merges bounded sketches and is off by at most a
    10,000th of the group in rank, which is nothing for the days of one hour and
    grid. ``exact`` narrows the range of each group by counts instead, for groups of any size.
    """
    if exact:
        return exact_quantiles(df, keys, column, 0.5).withColumnRenamed("cut", "baseline_activity")
    return df.groupBy(*keys).agg(F.percentile_approx(column, 0.5).alias("baseline_activity"))


def alert_counts_by_type(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_type").agg(F.count("*").alias("alerts"))


def alert_top_grids(alerts: DataFrame, k: int = 10) -> DataFrame:
    counts = alerts.groupBy("grid_id").agg(F.count("*").alias("alerts"))
    return counts.orderBy(F.desc("alerts"), "grid_id").limit(k)


def alert_proportion(alerts: DataFrame, grid_hour: DataFrame) -> DataFrame:
    """Distinct alerted grid-hours over all grid-hours; NULL without any grid-hour."""
    alerted = alerts.select("grid_id", "timestamp").distinct().select(F.lit(1).alias("a"), F.lit(0).alias("t"))
    rows = grid_hour.select(F.lit(0).alias("a"), F.lit(1).alias("t"))
    return alerted.unionAll(rows).agg(
        F.sum("a").alias("alerted_grid_hours"),
        F.sum("t").alias("grid_hours"),
        F.try_divide(F.sum("a"), F.sum("t")).alias("proportion"),
    )


def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    """Rows and share per class; the total is a scalar subquery, not a one-task window."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def history_summary(hourly: DataFrame, as_of=None) -> DataFrame:
    """Per grid: all but the newest row of the 24 hours that end at ``as_of``, summarised.

    A grid with a single row in the window gets NULLs.
    """
    end = latest(hourly, as_of)
    rows = hourly.where(F.col("timestamp").between(hours_before(end), end))
    newest = F.row_number().over(Window.partitionBy("grid_id").orderBy(F.desc("timestamp"))) == 1
    older = rows.withColumn("older", ~newest)
    value = F.when(F.col("older"), F.col("total_activity"))
    stamp = F.when(F.col("older"), F.col("timestamp"))
    first, last = F.min_by("total_activity", stamp), F.max_by("total_activity", stamp)
    return older.groupBy("grid_id").agg(
        F.count_if("older").alias("points_summarized"),
        F.min(stamp).alias("oldest_timestamp"),
        F.max(stamp).alias("newest_historical_timestamp"),
        F.min(value).alias("min_total_activity"),
        F.max(value).alias("max_total_activity"),
        # Scaled first: a tie of the decimal text is not one of the binary value.
        (F.round(F.avg(value) * 100) / 100).alias("avg_total_activity"),
        F.when(last > first, "rising").when(F.max(stamp).isNotNull(), "falling_or_flat").alias("trend_hint"),
    )
