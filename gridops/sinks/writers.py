"""Stage outputs: write, check and describe them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.session import path_exists


def write_partitioned(df: DataFrame, path: str, column: str = "date") -> None:
    """Overwrite Parquet with one directory per value of ``column``.

    ``rebalance`` groups the rows of a value and lets AQE split a value that holds
    most rows over several tasks and merge small ones, so file sizes stay even.
    """
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_outputs(clean: DataFrame, hourly: DataFrame, top: DataFrame, enriched: DataFrame, path: str) -> dict[str, str]:
    """Write the four stage outputs under ``path`` and return where each went."""
    out = {name: f"{path.rstrip('/')}/{name}" for name in ("clean", "hourly_grid_summary", "dashboard", "enriched")}
    write_partitioned(clean, out["clean"])
    write_parquet(hourly, out["hourly_grid_summary"])
    write_csv(top, out["dashboard"])
    write_parquet(enriched, out["enriched"])
    return out


def _fingerprint(df: DataFrame, side: str, columns: list[str]) -> DataFrame:
    row_hash = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(row_hash).alias("h")).withColumn("side", F.lit(side))


def verify_round_trip(df: DataFrame, path: str) -> DataFrame:
    """Compare a frame with its written Parquet copy: counts and an order-free content hash."""
    columns = sorted(df.columns)
    written = df.sparkSession.read.parquet(path).select(*columns)
    both = _fingerprint(df, "before", columns).unionByName(_fingerprint(written, "after", columns))
    pick = lambda value, side: F.max(F.when(F.col("side") == side, F.col(value)))
    return both.agg(
        pick("n", "before").alias("rows_before"),
        pick("n", "after").alias("rows_after"),
        (pick("n", "before") == pick("n", "after")).alias("rows_match"),
        pick("h", "before").eqNullSafe(pick("h", "after")).alias("content_match"),
    )


def output_size(spark: SparkSession, path: str) -> DataFrame:
    """Number of data files under an output and their bytes, partitions included."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def output_status(spark: SparkSession, outputs: dict[str, str]) -> DataFrame:
    """Per named output: completed or not, last modified; plus the overall status.

    The loop runs over the handful of named outputs, not over data.
    """
    present = {name: path_exists(spark, f"{path.rstrip('/')}/_SUCCESS") for name, path in outputs.items()}
    overall = "healthy" if all(present.values()) else "partial"

    def check(name: str, path: str) -> DataFrame:
        if present[name]:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            row = files.agg(F.max("modificationTime").alias("last_modified"))
        else:
            row = spark.range(1).select(F.lit(None).cast("timestamp").alias("last_modified"))
        return row.select(
            F.lit(name).alias("output"),
            F.lit(present[name]).alias("available"),
            "last_modified",
            F.lit(overall).alias("status"),
        )

    return reduce(DataFrame.unionByName, [check(name, path) for name, path in outputs.items()])

