"""Data-quality profiles: one aggregate pass each, results as small tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from gridops.functions.time import epoch_seconds
from gridops.operators.clean import has_null_activity, is_rejected

GRAIN = ["timestamp", "grid_id", "country_code"]


def _per_column(df: DataFrame, columns: list[str], measures: dict[str, callable]) -> DataFrame:
    """One row per column from a single wide aggregate."""
    wide = df.agg(
        *[f(F.col(c)).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def distinct_profile(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values per column, without NULL and with NULL counted as a value.

    The exact form is one distinct per column over that column alone, so no row is expanded and each scan reads one
    column; ``approximate`` keeps a sketch per column in one pass.
    """
    columns = columns or df.columns
    if not approximate:
        parts = [
            df.select(F.col(c).alias("value")).distinct().agg(
                F.lit(c).alias("column_name"), F.count("value").alias("distinct_values"), F.count("*").alias("distinct_with_null")
            )
            for c in columns
        ]
        return reduce(DataFrame.unionByName, parts)
    profile = _per_column(
        df, columns, {"distinct_values": F.approx_count_distinct, "has_null": lambda c: F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))}
    )
    return profile.select(
        "column_name",
        "distinct_values",
        (F.col("distinct_values") + F.col("has_null")).alias("distinct_with_null"),
    )


#: Registers of a sketch as a power of two: estimates are off by 0.83 / sqrt(2**12) = 1.3 % in standard deviation.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, by: str, columns: list[str] | None = None) -> DataFrame:
    """``by, column_name, sketch, has_null``: a sketch of the distinct values of each column for every value of ``by`` (a date, say).

    Sketches merge: keep them per date, add those of new dates, and ask for any range of dates
    (:func:`sketched_profile`) without a look at the rows. A sketch has a few kilobytes whatever it has seen.
    """
    columns = [c for c in (columns or df.columns) if c != by]
    value = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(c))
    wide = df.groupBy(by).agg(
        *(F.hll_sketch_agg(value(c), SKETCH_BITS).alias(f"s{i}") for i, c in enumerate(columns)),
        *(F.max(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)),
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("sketch"), F.col(f"n{i}").alias("has_null")) for i, c in enumerate(columns)]
    return wide.select(by, F.inline(F.array(*rows)))


def sketched_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all rows behind the given sketches, estimated."""
    merged = sketches.groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"), F.max(F.col("has_null").cast("int")).alias("has_null")
    )
    return merged.select("column_name", "distinct_values", (F.col("distinct_values") + F.col("has_null")).alias("distinct_with_null"))


def time_bounds(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.agg(F.min(column).alias("first_timestamp"), F.max(column).alias("last_timestamp"))


def null_profile(df: DataFrame) -> DataFrame:
    return _per_column(df, df.columns, {"nulls": lambda c: F.count_if(c.isNull())})


def negative_profile(df: DataFrame) -> DataFrame:
    """Negative values per numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return _per_column(df, numeric, {"negatives": lambda c: F.count_if(c < 0)})


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier row in every column."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def duplicate_grain(df: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """Number of rows whose grain occurs more than once; NULL keys form groups too."""
    groups = df.groupBy(*grain).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_grain_rows"))


def country_by_hour(df: DataFrame) -> DataFrame:
    """Distinct country per (country, hour); 0 for the NULL country."""
    return df.groupBy("country_code", F.hour("timestamp").alias("hour")).agg(
        F.count_distinct("country_code").alias("countries")
    )


def cadence_files(df: DataFrame, source: str | Column) -> DataFrame:
    """Whether the distinct sources (files or dates) account for 24 timestamps each."""
    source = F.col(source) if isinstance(source, str) else source
    counts = df.agg(F.count_distinct(source).alias("sources"), F.count_distinct("timestamp").alias("timestamps"))
    return counts.withColumn("complete", F.col("sources") * 24 == F.col("timestamps"))


def _stamps(df: DataFrame) -> DataFrame:
    stamps = df.select("timestamp").where(F.col("timestamp").isNotNull()).distinct()
    return stamps.withColumn("date", F.to_date("timestamp"))


def cadence_gaps(df: DataFrame) -> DataFrame:
    """Per day: distinct stamps, one-hour steps, and whether they make 24 and 23."""
    day = Window.partitionBy("date").orderBy("timestamp")
    step = epoch_seconds("timestamp") - epoch_seconds(F.lag("timestamp").over(day))
    steps = _stamps(df).withColumn("step", step)
    daily = steps.groupBy("date").agg(
        F.count("*").alias("stamps"), F.count_if(F.col("step") == 3600).alias("hour_steps")
    )
    return daily.withColumn("complete", (F.col("stamps") == 24) & (F.col("hour_steps") == 23))


def timestamp_gaps(df: DataFrame) -> DataFrame:
    """Distance in seconds from each distinct stamp to the one before it.

    Within a day by window; the first stamp of a day looks back to the last stamp
    of the previous day present. Only the per-day summary meets in one task.
    """
    stamps = _stamps(df)
    ends = stamps.groupBy("date").agg(F.max("timestamp").alias("last_stamp"))
    before = ends.select("date", F.lag("last_stamp").over(Window.orderBy("date")).alias("day_before"))
    in_day = F.lag("timestamp").over(Window.partitionBy("date").orderBy("timestamp"))
    return (
        stamps.withColumn("previous", in_day)
        .join(before, "date")
        .withColumn("previous", F.coalesce("previous", "day_before"))
        .select(
            "timestamp", "previous", (epoch_seconds("timestamp") - epoch_seconds("previous")).alias("gap_seconds")
        )
    )


def cleaning_report(raw: DataFrame) -> DataFrame:
    """Rows before, after, rejected, and with a missing channel, in one pass over coerced rows."""
    return raw.agg(
        F.count("*").alias("rows_before"),
        F.count_if(~is_rejected()).alias("rows_after"),
        F.count_if(is_rejected()).alias("rejected"),
        F.count_if(has_null_activity()).alias("null_activity"),
    )


def check_unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; empty when the key holds."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
