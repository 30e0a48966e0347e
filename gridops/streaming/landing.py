"""Incremental arrival of landing files with Structured Streaming.

A file-source stream remembers in its checkpoint which files it has seen; each batch of new ones
is validated, routed and logged as a whole. What is logged for a batch stands in a partition of
its number, so a batch that Spark repeats after a failure is told by its partition, and no
run reads what earlier ones have logged or ingested: work follows the new files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.plans.landing import routed_files
from gridops.schema import FILE_PATTERN
from gridops.session import path_exists
from gridops.sources.files import list_files

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_DECISION = "filename string, status string, row_count bigint, reason string, processed_at string"


def _log(spark: SparkSession, files: DataFrame, raw: str, rejected: str, folder: str, processed_at: str) -> None:
    """Ingest ``files`` and write their decisions to ``folder``, last and at once."""
    none = files.where("false")
    with routed_files(spark, files, none, raw, rejected) as results:
        rows = results.select("filename", "status", "row_count", "reason", F.lit(processed_at).alias("processed_at"))
        rows.write.mode("overwrite").parquet(folder)


def ingest_arrivals(
    spark: SparkSession,
    landing: str,
    raw: str,
    rejected: str,
    audit: str,
    checkpoint: str,
    processed_at: str,
    pattern: str = FILE_PATTERN,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Ingest the files that came since the last call; filename, status, row_count and reason of these.

    ``audit`` has a partition ``batch`` per batch of the stream. A batch whose partition is complete is not done
    again; one that died before is, and replaces what it had written (``raw`` and ``rejected`` are
    partitioned by file). A file that changes later is new. ``files_per_batch`` bounds a batch.
    """
    root, done = audit.rstrip("/"), []

    def ingest(files: DataFrame, number: int) -> None:
        folder = f"{root}/batch={number}"
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            _log(spark, spark.createDataFrame(files.select("path", "file_name").toArrow()), raw, rejected, folder, processed_at)
        done.append(str(number))

    stream = spark.readStream.format("binaryFile").schema(_FILES)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    named = stream.load(landing).select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    query = (
        named.where(F.col("file_name").rlike(pattern))
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    done += _ingest_empty(spark, landing, raw, rejected, root, processed_at, pattern)
    if not done:
        return spark.createDataFrame([], _DECISION).drop("processed_at")
    logged = spark.read.schema(_DECISION).parquet(*(f"{root}/batch={b}" for b in done))
    return logged.drop("processed_at")


def _ingest_empty(spark: SparkSession, landing: str, raw: str, rejected: str, root: str, processed_at: str, pattern: str) -> list[str]:
    """Log files without content, which no stream has a row for; only names of such files are remembered here."""
    files = list_files(spark, landing).where(F.col("file_name").rlike(pattern) & (F.col("length") == 0)).select("path", "file_name")
    names = [r["file_name"] for r in files.collect()]
    known = [n for n in names if path_exists(spark, f"{root}/batch=empty-{n}/_SUCCESS")]
    fresh = [n for n in names if n not in set(known)]
    for name in fresh:
        _log(spark, files.where(F.col("file_name") == name), raw, rejected, f"{root}/batch=empty-{name}", processed_at)
    return [f"empty-{n}" for n in fresh]
