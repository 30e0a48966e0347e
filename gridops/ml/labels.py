"""Targets, class weights and time-ordered splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.operators.aggregate import exact_quantiles
from gridops.operators.windows import lead_activity, prior_median
from gridops.schema import HIGH_RATIO, LABEL_THRESHOLD


def label_threshold(hourly: DataFrame, threshold: float = LABEL_THRESHOLD) -> DataFrame:
    """Rows with a next hour; target = 1 if its activity is above ``threshold``."""
    rows = lead_activity(hourly).where(F.col("future_activity").isNotNull())
    return rows.withColumn("target", (F.col("future_activity") > threshold).cast("int"))


def label_percentile(hourly: DataFrame, train_until, q: float = 0.9) -> DataFrame:
    """Target = next hour above the ``q`` quantile of activity up to ``train_until`` only.

    The quantile is exact at any size, see :func:`exact_quantiles`.
    """
    end = F.lit(train_until).cast("timestamp_ntz") if isinstance(train_until, str) else train_until
    cut = exact_quantiles(hourly.where(F.col("timestamp") <= end), [], "total_activity", q).agg(F.max("cut")).scalar()
    rows = lead_activity(hourly).where(F.col("future_activity").isNotNull())
    return rows.withColumn("target", (F.col("future_activity") > cut).cast("int"))


def label_relative(hourly: DataFrame, ratio: float = HIGH_RATIO) -> DataFrame:
    """Rows with a positive prior median and a next hour; target = next hour at or above ``ratio`` x median."""
    rows = lead_activity(prior_median(hourly))
    usable = rows.where((F.col("baseline_24h") > 0) & F.col("future_activity").isNotNull())
    return usable.withColumn("target", (F.col("future_activity") >= F.col("baseline_24h") * ratio).cast("int"))


def chronological_cut(df: DataFrame, fraction: float = 0.8, column: str = "feature_timestamp") -> DataFrame:
    """One row ``cut``: the last timestamp of the first ``fraction`` of rows.

    Rows are counted per timestamp, those counts run within a day, and days run
    over a per-day summary: no task sees more than the days or one day's stamps.
    """
    stamps = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("at")).agg(F.count("*").alias("n"))
    stamps = stamps.withColumn("day", F.to_date("at"))
    days = stamps.groupBy("day").agg(F.sum("n").alias("n"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    before = days.select("day", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    in_day = Window.partitionBy("day").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    running = stamps.withColumn("in_day", F.sum("n").over(in_day)).join(before, "day")
    total = df.agg(F.count("*").alias("n")).scalar()
    kept = running.where(F.col("before") + F.col("in_day") <= F.lit(fraction) * total)
    return kept.agg(F.max("at").alias("cut"))


def split_chronological(
    df: DataFrame, fraction: float = 0.8, column: str = "feature_timestamp"
) -> tuple[DataFrame, DataFrame]:
    """(train, test): the first ``fraction`` of rows by time, rows of one time kept together."""
    early = F.coalesce(F.col(column) <= chronological_cut(df, fraction, column).scalar(), F.lit(False))
    return df.where(early), df.where(~early)


def split_by_date(
    df: DataFrame, train_dates: int = 4, expected_dates: int | None = None, column: str = "feature_timestamp"
) -> tuple[DataFrame, DataFrame]:
    """(train, test): the first ``train_dates`` distinct dates, and the later ones.

    With ``expected_dates`` a different number of dates is an error.
    """
    day = F.to_date(column)
    dates = df.select(day.alias("day")).where(F.col("day").isNotNull()).distinct()
    if expected_dates is not None:
        found = dates.count()
        if found != expected_dates:
            raise ValueError(f"expected {expected_dates} dates, found {found}")
    cut = dates.orderBy("day").limit(train_dates).agg(F.max("day").alias("cut")).scalar()
    return df.where(day <= cut), df.where(day > cut)


def class_weight(df: DataFrame, target: str = "target") -> DataFrame:
    """Negatives, positives and their ratio; NULL ratio without positives."""
    positive, negative = F.count_if(F.col(target) == 1), F.count_if(F.col(target) == 0)
    return df.agg(
        positive.alias("positives"), negative.alias("negatives"), F.try_divide(negative, positive).alias("weight")
    )


def with_class_weight(df: DataFrame, target: str = "target") -> DataFrame:
    """Add ``weight``: the class ratio for positives, 1.0 for negatives."""
    ratio = class_weight(df, target).select("weight").scalar()
    return df.withColumn("weight", F.when(F.col(target) == 1, ratio).otherwise(1.0))
