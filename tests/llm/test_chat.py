"""Chat formatting against a plain rendering."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridops.llm import chat


def plain(rows, part_turns=256):
    """``(conv, speaker, part, n_turns, n_own, text, mask)`` of every dialogue, one turn after the other."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role if role is not None else "unknown", text or ""))
    out = []
    for conv, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{t[1]}\x01{t[2]}".encode()).hexdigest()))
        for speaker in {t[1] for t in turns}:
            for part in range(-(-len(turns) // part_turns)):
                own, text, spans = 0, "", []
                some = turns[part * part_turns : (part + 1) * part_turns]
                for _, role, words in some:
                    text += "<|im_start|>" + ("assistant\n" if role == speaker else f"user name={role}\n")
                    if role == speaker:
                        own += 1
                        spans.append(f"{len(text)}:{len(text) + len(words) + 11}")
                    text += words + "<|im_end|>\n"
                out.append((conv, speaker, part, len(some), own, text, ",".join(spans)))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in chat.rotate_perspectives(df, **kw).collect()), key=str)


@pytest.mark.parametrize("part_turns", [1, 3, 256])
def test_every_kind_of_turn_number(spark, part_turns):
    rnd = random.Random(part_turns)
    rows = [
        (rnd.choice([1, 2, None]), rnd.choice([None, -1, -5000, 0, 1, 2, 3, 4095, 4096, 9000, 2**40]), rnd.choice(["ann", "bob", None]), rnd.choice([None, "", "hi", "yo é 😀", "ok\n"]))
        for _ in range(300)
    ]
    rows += [(9, 7, "ann", "same")] * 20 + [(8, i, f"s{i % 3}", str(i)) for i in range(40)] + [(1, -1, "x", "minus"), (1, None, "x", "none")]
    df = spark.createDataFrame([(*r, "p", "c") for r in rows], "conv_id long, turn long, role string, text string, part string, copies string").repartition(4)
    assert got(df, part_turns=part_turns) == plain(rows, part_turns)


def test_rows_that_share_everything_stay_in_bounded_parts(spark):
    df = spark.range(5000).select(F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("a").alias("role"), F.lit("t").alias("text"))
    rows = chat.rotate_perspectives(df).collect()
    assert sorted(r["part"] for r in rows) == list(range(20)) and sum(r["n_turns"] for r in rows) == 5000 and max(r["n_turns"] for r in rows) == 256
    assert chat.rotate_perspectives(df.limit(0)).count() == 0
    assert chat.numbered_turns(df).select("copies", "first").collect() == [(5000, 0)]
