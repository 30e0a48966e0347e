"""File readers: daily CSVs, Parquet tables, GeoJSON lookups, optional inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridops.schema import FILE_PATTERN, RAW_SCHEMA
from gridops.session import file_system, path_exists


def read_activity_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Daily CSV files with a fixed schema.

    ``enforceSchema=false`` checks each header against the schema instead of
    binding columns by position, so a reordered file fails loudly.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_activity_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Daily CSV files with inferred types; costs one extra pass over the files."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """One row per file directly in ``directory``: path, file_name, length, modified (milliseconds). Subfolders are not listed, content is not read.

    The names of one folder pass through the driver, empty files included, which no scan shows.
    """
    system, own = file_system(spark, directory)
    if not system.exists(own):
        raise FileNotFoundError(directory)
    if not system.getFileStatus(own).isDirectory():
        raise NotADirectoryError(directory)
    found = [s for s in system.listStatus(own) if s.isFile()]
    rows = [(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found]
    return spark.createDataFrame(rows, "path string, file_name string, length bigint, modified bigint")


def discover_files(
    spark: SparkSession, directory: str, pattern: str = FILE_PATTERN, require_match: bool = False
) -> DataFrame:
    """Files directly in ``directory`` whose whole name matches ``pattern``, sorted by name."""
    found = list_files(spark, directory).where(F.col("file_name").rlike(pattern))
    if require_match and found.isEmpty():
        raise FileNotFoundError(f"no file in {directory} matches {pattern}")
    return found.withColumn("file_date", F.regexp_extract("file_name", r"\d{4}-\d{2}-\d{2}", 0).try_cast("date")).orderBy(
        "file_name"
    )


def file_provenance(df: DataFrame) -> DataFrame:
    """Distinct source files behind a frame that was read from files."""
    return df.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")
    ).distinct()


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def rows_to_df(spark: SparkSession, rows, columns) -> DataFrame:
    """In-memory rows to a frame; ``columns`` is a list of names or a schema."""
    return spark.createDataFrame(rows, columns)


def read_geojson_lookup(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """FeatureCollection file(s) to (grid_id, geometry JSON text).

    A whole-file document is one task. Split a large lookup into several files of
    one directory, or write a FeatureCollection per line and set ``one_per_line``
    so that Spark can split the files themselves.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    schema = "features array<struct<properties:struct<cellId:int>,geometry:string>>"
    features = spark.read.schema(schema).option("multiLine", not one_per_line).json(path)
    return features.select(F.explode("features").alias("f")).select(
        F.col("f.properties.cellId").alias("grid_id"), F.col("f.geometry").alias("geometry")
    )


def read_optional(spark: SparkSession, path: str, required: list[str]) -> DataFrame | None:
    """The Parquet table at ``path`` cut to ``required``; None if it or a column is absent."""
    if not path_exists(spark, path):
        return None
    df = spark.read.parquet(path)
    return df.select(*required) if set(required) <= set(df.columns) else None


def join_optional(df: DataFrame, extra: DataFrame | None, keys: list[str], null_types: dict[str, str]) -> DataFrame:
    """Left join ``extra``; without it carry typed NULL columns in its place."""
    if extra is None:
        return df.withColumns({name: F.lit(None).cast(kind) for name, kind in null_types.items()})
    return df.join(extra.select(*keys, *null_types), keys, "left")
