"""Helpers that read the caller's session; none of them creates or changes one."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table, under ``spark.checkpoint.dir``.

    Executors must all reach it, so a machine-local folder is used only by a
    local session that names no shared folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/gridops-{label}-{uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if a file or folder exists; asks its file system for this one path and lists nothing."""
    system, own = file_system(spark, path)
    return system.exists(own)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path as it spells it: with scheme, without ``.`` or doubled slashes."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = plain.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(plain)


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Row count and summed JSON width of ``df``, one aggregate over it."""
    row = df.agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("b"),
    ).first()
    return row["n"], row["b"] or 0


def bounded_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """``broadcast(df)`` when its measured size is inside both bounds, else ``df``.

    Beyond the bounds the join is an ordinary shuffle join, which AQE may split
    on skew. The measurement is one partial aggregate over the small side.
    """
    rows, size = measured_size(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
