"""Exact deduplication by skew-safe combining of whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm.common import stage, unused


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digest", F.sha2("text", 256))


def text_classes(rows: DataFrame, salts: int = 16) -> DataFrame:
    """One row per digest: ``keep_id``, ``group_size``.

    Copies are combined three times, each time by digest *and* whole text: within a
    task before the shuffle (the map side of the first aggregate; the salt is the
    task's own number, so all its copies meet), per digest and salt, and over the
    salts. A text that makes up a third of all rows reaches the last step as at most
    ``salts`` rows. If two texts ever shared a digest the job stops with an error
    rather than merge them.
    """
    local = rows.withColumn("salt", F.expr(f"spark_partition_id() % {int(salts)}"))
    salted = local.groupBy("digest", "text", "salt").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    whole = salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    one = F.count("*") == 1
    return whole.groupBy("digest").agg(
        F.when(one, F.max("keep_id")).otherwise(F.raise_error(F.lit("two texts share a digest"))).alias("keep_id"),
        F.max("n").alias("group_size"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per document: which document of its equal texts stays.

    Columns ``doc_id, keep_id, group_size, kept, text_sha256``. The largest doc_id of
    equal texts stays; null texts count as empty. Rows repeated with one doc_id and
    text count each, and one of them stays. A null doc_id never wins over another;
    if all are null, ``keep_id`` is null and one row stays. Other columns are ignored;
    an empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col)
    # Only ids and digests go back; repeated rows travel as a count.
    copies = stage(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("copies")), "copies")
    # Between two written tables the join splits the ids of a text that many documents have.
    joined = copies.join(stage(text_classes(rows, salts), "classes"), "digest")
    each = joined.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
    return each.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are, whatever their names; one row per distinct text."""
    # One key of digest and id: it parts a text that many documents have, and the rows
    # that it brings together need no second shuffle to tell repeated ones.
    key = lambda digest, doc_id: F.concat_ws(":", digest, doc_id.cast("string"))
    own, win = unused(docs, "__own"), unused(docs, "__win")
    classes = text_classes(_rows(docs, id_col, text_col), salts)
    winners = stage(classes.select(key(F.col("digest"), F.col("keep_id")).alias(win)), "winners")
    digest = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    keyed = docs.withColumn(own, key(digest, F.col(id_col)))
    return keyed.join(winners, F.col(own) == F.col(win)).dropDuplicates([own]).drop(own, win)
