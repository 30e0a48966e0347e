"""Caching, partitioning and plan text."""

from __future__ import annotations

import io
import time
from contextlib import contextmanager, redirect_stdout

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """``df`` kept for the block and released after it, the very frame that was kept."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def cache_timings(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and seconds of the same count without a cache, filling it, and from it."""

    def timed(frame: DataFrame, run: str) -> tuple[str, int, float]:
        start = time.perf_counter()
        return run, frame.count(), time.perf_counter() - start

    narrow = df.select(*columns)
    runs = [timed(narrow, "uncached")]
    with cached(narrow) as kept:
        runs += [timed(kept, "filling"), timed(kept, "cached")]
    return df.sparkSession.createDataFrame(runs, "run string, rows bigint, seconds double")


def repartition_by_date(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows of a date together, in tasks of even size.

    ``rebalance`` lets AQE give a date that holds most of the rows as many tasks as
    its size asks for, equal rows included, and merge small dates.
    """
    return df.hint("rebalance", partitions, "date") if partitions else df.hint("rebalance", "date")


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition as Spark lays the frame out."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def explain_plan(df: DataFrame) -> str:
    """Formatted physical plan as text."""
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
