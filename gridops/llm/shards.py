"""Sharding by weighted rendezvous hashing of a stable record key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that wins the key.

    Every shard draws u in (0, 1) from the hash of (key, shard) and bids -ln(u) / weight;
    the lowest bid wins, ties go to the lower number. A shard gets keys in proportion
    to its weight. Adding a shard moves keys only into it, removing one moves only
    its own keys, changing a weight moves keys only into or out of that shard.
    A null key is a key like any other; a shard of weight 0 gets nothing.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be non-negative, one of them positive")
    # Hash twice: the outer round parts the draws of neighbouring shards.
    draw = lambda i: F.shiftrightunsigned(F.xxhash64(F.xxhash64(key, F.lit(i)), F.lit(i)), 11)
    bids = [
        F.struct((-F.log((draw(i) + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(w))).alias("bid"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    return (F.least(*bids) if len(bids) > 1 else bids[0])["shard"]


def shard_documents(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 16,
    grown: Sequence[float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_bucket: int = 100_000,
) -> DataFrame:
    """Shard of every document, its slot there, and the shard after growth to ``grown`` weights.

    Columns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. ``grown``
    defaults to ``weights`` and one more shard of weight 1. Slots count from 0 without
    a gap in each shard. They need no sort of a whole shard: a shard is cut into hash
    buckets of about ``rows_per_bucket`` rows, bucket totals are summed up, and rows
    are numbered inside their bucket. Rows equal in doc_id, size and checksum are
    counted first and numbered as a run, so repeated rows do not pile up. A null text
    has size 1 and checksum 0; rows with a null doc_id share one shard. Other columns
    are ignored; an empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    total = docs.count()
    buckets = max(1, -(-total // (rows_per_bucket * len(weights))))
    runs = (
        rows.groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
        .withColumn("shard", rendezvous_shard(F.col("doc_id"), weights))
        .withColumn("grown_shard", rendezvous_shard(F.col("doc_id"), grown or (*weights, 1.0)))
        .withColumn("bucket", F.expr(f"pmod(xxhash64(doc_id, size, text_crc32, 7), {buckets})"))
    )
    by_bucket = Window.partitionBy("shard").orderBy("bucket")
    totals = runs.groupBy("shard", "bucket").agg(F.sum("copies").alias("rows"))
    offsets = totals.select("shard", "bucket", (F.sum("rows").over(by_bucket) - F.col("rows")).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    upto = F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = runs.withColumn("inside", upto - F.col("copies")).join(offsets, ["shard", "bucket"])
    numbered = placed.withColumn("first_slot", F.col("before") + F.col("inside"))
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    return numbered.select("*", copy).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first_slot") + F.col("copy")).alias("slot"),
        "grown_shard",
    )
