"""Audit of how filters overlap: which rows each of them takes, in every order in which they may be applied."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm.common import stage

#: Letters of the filters; the bit of a letter in a row's combination is its place here.
FILTERS = "ABCDE"
#: Fixed values of the conditions.
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, SYMBOLS = 200, 50, 2, "[#$%&*|]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def text_failures(text: Column) -> Column:
    """Sum of the bits of the filters A to D that a text (not null) fails; each looks at the whole text."""
    words = F.array_remove(F.split(text, "[ \\x09-\\x0D]+"), "")
    n = F.size(words)
    conditions = {
        "A": n < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)).cast("bigint") * 100 < n.cast("bigint") * LEAST_DISTINCT_PERCENT,
        "C": (F.length(text) - F.length(F.translate(text, _CAPITALS, ""))).cast("bigint") * 100 > F.length(text).cast("bigint") * MOST_CAPITALS_PERCENT,
        "D": text.rlike(SYMBOLS),
    }
    bits = [F.when(condition, _bit(letter)).otherwise(0) for letter, condition in conditions.items()]
    return sum(bits[1:], bits[0])


def later_copies(rows: DataFrame) -> DataFrame:
    """The rows (``doc_id, hash, text`` and more) whose text an equal one of a smaller doc_id has, too.

    A semi-join of the rows with themselves on hash, whole text and smaller doc_id. Of the rows that
    may be the other side only the smallest doc_id of each hash and text is kept, summed up
    before the shuffle: it exists if any does. Rows whose hash stands alone do not take part, so only
    the texts of copies travel; both sides are written, so that Spark can split a text that
    many rows have. A null doc_id is not smaller than any, nor larger.
    """
    crowded = rows.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("hash")
    copies = stage(rows.where(F.col("doc_id").isNotNull()).join(stage(crowded, "hashes"), "hash", "left_semi"), "copies")
    firsts = stage(copies.groupBy("hash", "text").agg(F.min("doc_id").alias("first")), "firsts")
    mine, other = copies.alias("mine"), firsts.alias("other")
    same = (F.col("mine.hash") == F.col("other.hash")) & (F.col("mine.text") == F.col("other.text")) & (F.col("other.first") < F.col("mine.doc_id"))
    return mine.join(other, same, "left_semi")


def failure_combinations(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: rows of each part by the combination of filters they fail.

    The ids that fail A to D and those that fail E are put together and added up per id;
    rows that share id, text and part are one with a count.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    own = rows.select("doc_id", "hash", "part", text_failures(F.col("text")).alias("bits"), F.lit(1).cast("bigint").alias("n"))
    copies = later_copies(rows).select("doc_id", "hash", "part", F.lit(_bit("E")).alias("bits"), F.lit(0).cast("bigint").alias("n"))
    each = own.union(copies).groupBy("doc_id", "hash", "part").agg(F.bit_or("bits").alias("mask"), F.sum("n").alias("n"))
    is_one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    joined = each.join(told, F.col("doc_id") == F.col("id"), "left")
    count = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), count("good").alias("good"), count("toxic").alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """What each filter does to each part at each step of all 120 orders.

    Per ``part``, ``filter_order`` and ``step`` (its filter is that letter of the order): rows ``kept``
    after it, ``removed`` by it, ``redundant`` (they fail it but have gone before), ``unique_fails``
    (they fail nothing else), ``good_lost`` and ``toxic_lost`` (removed rows with that label), ``shapley``
    (what the filter removes, summed over all orders). Filters fail texts A: of fewer than 200 words,
    B: with under 50 in 100 words distinct, C: with more than 2 in 100 characters in A-Z, D: with one of
    ``#$%&*|``, E: equal to the text of a smaller doc_id anywhere in the table.

    All orders follow from one count of rows per part and combination of filters: at most 32 rows a part,
    summed up before the shuffle. Null texts are empty, a null part is the empty string, a null doc_id
    has no label, never fails E and makes none fail it; rows repeated with one doc_id count each and
    are no copies of each other. A doc_id with several labels is good or toxic if one says so. Other columns
    are ignored; an empty table gives no rows.
    """
    masks = failure_combinations(docs, labels, id_col, text_col, part_col)
    # Rows that fail none of a set of filters, for each of the 32 sets, in an array by set.
    passes = F.col("mask").bitwiseAND(F.col("set")) == 0
    count = lambda c: F.sum(F.when(passes, F.col(c)).otherwise(0)).alias(c)
    sets = masks.withColumn("set", F.explode(F.sequence(F.lit(0), F.lit(31)))).groupBy("part", "set").agg(count("n"), count("good"), count("toxic"))
    exact = masks.groupBy("part").agg(*(F.sum(F.when(F.col("mask") == _bit(c), F.col("n")).otherwise(0)).alias(c) for c in FILTERS))
    by_part = sets.groupBy("part").agg(F.transform(F.array_sort(F.collect_list(F.struct("set", "n", "good", "toxic"))), lambda x: x.dropFields("set")).alias("left"))
    orders = ",".join(map("".join, permutations(FILTERS)))
    rows = by_part.join(exact, "part").withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    bits = lambda string: F.aggregate(
        F.filter(F.split(string, ""), lambda c: c != ""), F.lit(0), lambda acc, c: acc + F.call_function("shiftleft", F.lit(1), F.ascii(c) - ord("A"))
    )
    rows = rows.withColumn("before", F.get("left", bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))))
    rows = rows.withColumn("after", F.get("left", bits(F.substring("filter_order", F.lit(1), F.col("step")))))
    lost = lambda c: F.col(f"before.{c}") - F.col(f"after.{c}")
    failing = F.get("left", F.lit(0))["n"] - F.get("left", bits(letter))["n"]
    unique = F.coalesce(*(F.when(letter == c, F.col(c)) for c in FILTERS))
    told = rows.select(
        "part",
        "filter_order",
        "step",
        F.col("after.n").alias("kept"),
        lost("n").alias("removed"),
        (failing - lost("n")).alias("redundant"),
        unique.alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        letter.alias("letter"),
    )
    return told.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")
