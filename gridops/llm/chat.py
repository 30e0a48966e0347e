"""Chat formatting from the perspective of every participant; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm.common import stage

#: Fixed values of the rendered format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Turn numbers of a range, and hex digits of the ranges of rows that share one.
RANGE, DIGITS = 4096, 3


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies, first``: distinct rows with the positions ``first .. first + copies - 1`` in their dialogue.

    Turns sort by number (none first), then by the MD5 of speaker and text. No task sorts a dialogue: its turns are
    counted by ranges of numbers, by number, and by ranges of the MD5 among equal numbers; the counts are
    summed up in that order, and rows are numbered inside the last ranges only. Equal rows are one row with a count.
    """
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    digest = F.md5(F.concat("role", F.lit("\x01"), "text").cast("binary"))
    distinct = distinct.withColumns({"digest": digest, "range": F.floor(F.col("turn") / RANGE)})
    distinct = stage(distinct.withColumn("tie", F.substring("digest", 1, DIGITS)), "turns")
    ties = distinct.groupBy("conv_id", "range", "turn", "tie").agg(F.sum("copies").alias("n"))
    numbers = ties.groupBy("conv_id", "range", "turn").agg(F.sum("n").alias("n"))
    ranges = numbers.groupBy("conv_id", "range").agg(F.sum("n").alias("n"))

    def before(counts: DataFrame, within: list[str], by: str) -> DataFrame:
        upto = F.sum("n").over(Window.partitionBy(*within).orderBy(F.col(by).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
        return counts.withColumn("before", upto - F.col("n")).drop("n")

    def joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        other = right.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("before").alias("more"))
        equal = F.lit(True)
        for k in keys:
            equal = equal & F.col(k).eqNullSafe(F.col(f"_{k}"))
        out = left.join(other, equal).withColumn("before", F.col("before") + F.col("more"))
        return out.drop("more", *(f"_{k}" for k in keys))

    offsets = joined(before(numbers, ["conv_id", "range"], "turn"), before(ranges, ["conv_id"], "range"), ["conv_id", "range"])
    offsets = stage(joined(before(ties, ["conv_id", "turn"], "tie"), offsets, ["conv_id", "turn"]), "offsets")
    inside = Window.partitionBy("conv_id", "turn", "tie").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    placed = distinct.withColumn("before", F.sum("copies").over(inside) - F.col("copies"))
    return joined(placed, offsets, ["conv_id", "turn", "tie"]).select("conv_id", "turn", "role", "text", "copies", F.col("before").alias("first"))


def rotate_perspectives(turns: DataFrame, part_turns: int = 256) -> DataFrame:
    """Render each dialogue once per participant, that speaker as assistant, the others as named users.

    Reads ``conv_id, turn, role, text``; gives ``conv_id, speaker, part, n_turns, n_own, text, mask``.
    ``mask`` lists the character spans ``start:end`` of ``text`` to be learned: the
    speaker's own words with their closing mark, in order, joined by commas.

    A dialogue of any length is delivered whole, in parts of ``part_turns`` consecutive turns (part = position
    div part_turns), so that no row holds more than one part; ordinary dialogues are one part 0.
    Participants are those of the whole dialogue, so a part may have no own turn (empty mask).
    Turns sort by number, those without one first, then by the MD5 of speaker and text (ties); repeated rows
    are all rendered. A null role is the speaker "unknown", a null text is empty, and a null conv_id is a
    dialogue of its own. Other columns are ignored; an empty table gives no rows.
    """
    placed = stage(numbered_turns(turns), "placed")
    last = F.col("first") + F.col("copies") - 1
    # A row that repeats over many parts is dealt out in blocks of them, so that no array is long.
    block = part_turns * 10_000
    blocks = placed.withColumn("block", F.explode(F.sequence(F.expr(f"first div {block}"), F.expr(f"(first + copies - 1) div {block}"))))
    low, high = F.greatest("first", F.col("block") * block), F.least(last, (F.col("block") + 1) * block - 1)
    dealt = blocks.withColumns({"low": low, "high": high}).withColumn("part", F.explode(F.sequence(F.expr(f"low div {part_turns}"), F.expr(f"high div {part_turns}"))))
    at = F.greatest("low", F.col("part") * part_turns)
    times = (F.least("high", (F.col("part") + 1) * part_turns - 1) - at + 1).cast("int")
    parts = dealt.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct(at.alias("at"), "role", "text", times.alias("times")))).alias("runs"))
    turns_of = F.flatten(F.transform("runs", lambda r: F.array_repeat(F.struct(r["role"].alias("role"), r["text"].alias("text")), r["times"])))
    parts = parts.select("conv_id", "part", turns_of.alias("turns"))
    speakers = placed.groupBy("conv_id", "role").agg(F.lit(1).alias("one")).select(F.col("conv_id").alias("of"), F.col("role").alias("speaker"))
    pairs = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))

    own = lambda t: t["role"] == F.col("speaker")
    head = lambda t: F.when(own(t), OPEN + "assistant\n").otherwise(F.concat(F.lit(OPEN + "user name="), t["role"], F.lit("\n")))
    shaped = F.transform(
        "turns", lambda t: F.struct(own(t).alias("own"), head(t).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"))
    )
    span = lambda at, p: F.concat_ws(":", at + F.length(p["head"]), at + F.length(p["head"]) + F.length(p["body"]))
    spans = F.aggregate(
        "shaped",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
            F.when(p["own"], F.concat(acc["spans"], F.array(span(acc["at"], p)))).otherwise(acc["spans"]).alias("spans"),
        ),
    )["spans"]
    return pairs.withColumn("shaped", shaped).select(
        "conv_id",
        "speaker",
        "part",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.size(F.filter("shaped", lambda p: p["own"])).cast("bigint").alias("n_own"),
        F.array_join(F.transform("shaped", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        F.array_join(spans, ",").alias("mask"),
    )
