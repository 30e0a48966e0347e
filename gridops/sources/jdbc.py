"""Database tables through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, properties: dict, partition: dict | None = None) -> dict[str, str]:
    """Reader options; ``partition`` is column, lower, upper, num for a parallel read.

    Without ``partition`` Spark reads the table in one task, so give it for any
    table that is not small. Credentials come from the caller's ``properties``.
    """
    options = {**properties, "url": url, "dbtable": table}
    if partition:
        options.update(
            partitionColumn=partition["column"],
            lowerBound=partition["lower"],
            upperBound=partition["upper"],
            numPartitions=partition["num"],
        )
    return {key: str(value) for key, value in options.items()}


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict, partition: dict | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, partition)).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict, mode: str = "append", batchsize: int = 20_000
) -> None:
    """Batched inserts; ``mode="overwrite"`` empties the table and keeps its definition."""
    options = {**jdbc_options(url, table, properties), "batchsize": str(batchsize), "truncate": "true"}
    df.write.format("jdbc").options(**options).mode(mode).save()
