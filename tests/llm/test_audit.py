"""The filter audit against a loop over all orders."""

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from gridops.llm import audit

SCHEMA = "doc_id long, text string, source string, part string, mask string, n string, hash string"


def plain_audit(docs, labels):
    """Every order walked row by row; docs are ``(doc_id, text, source)``."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = [w for w in re.split("[ \t-\r]+", text) if w]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": any((t or "") == text and j is not None and i is not None and j < i for j, t, _ in docs),
        }
        rows.append((i, source or "", {f for f in fails if fails[f]}))
    out = {}
    for part in {p for _, p, _ in rows}:
        own = [(i, f) for i, p, f in rows if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left, seen = own, ""
            for step, c in enumerate(order, 1):
                gone = [i for i, f in left if c in f]
                left = [(i, f) for i, f in left if c not in f]
                shapley[c] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(c in f and bool(f & set(seen)) for _, f in own), sum(f == {c} for _, f in own),
                    sum(i in good for i in gone), sum(i in toxic for i in gone),
                ]
                seen += c
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def rows_of(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def test_audit_equals_a_walk_through_all_orders(spark):
    rnd = random.Random(4)
    texts = [None, "", "a", "A b $", "x " * 250, " ".join(f"w{i}" for i in range(300)), " ".join(f"W{i}" for i in range(250)), "\x0b".join(f"v{i}" for i in range(220)) + "|", "É" * 30, "x " * 250 + "%", "a b " * 100 + "c " * 100]
    docs = [(rnd.choice([None, *range(60)]), rnd.choice(texts), rnd.choice([None, "", "s1", "s2"])) for _ in range(150)]
    docs += [(3, "same", "s1"), (3, "same", "s1"), (9, "same", "s2"), (None, "same", "s1"), (-1, "x " * 250, None)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 60, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (777, 1, 1)]
    df = spark.createDataFrame([(*d, "p", "m", "n", "h") for d in docs], SCHEMA).repartition(5)
    told = spark.createDataFrame([(*x, "a", "b") for x in labels], "doc_id long, quality int, toxic int, good string, part string").repartition(3)
    got = rows_of(audit.audit_filters(df, told))
    assert got == plain_audit(docs, labels) and len(got) == 3 * 600
    assert audit.audit_filters(df.limit(0), told).count() == 0
    assert rows_of(audit.audit_filters(df, told.limit(0))) == plain_audit(docs, [])


def test_hashes_that_collide_are_no_copies(spark):
    rows = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, "b", 7), (4, "a", 8)], "doc_id long, text string, hash long")
    assert [r["doc_id"] for r in audit.later_copies(rows).collect()] == [3]


def test_copies_of_one_text_stay_linear(spark):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("hot text").alias("text"), F.lit(None).cast("string").alias("source"))
    got = rows_of(audit.audit_filters(rows, spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    assert got["", "EABCD", 1][:4] == (1, 29_999, 29_999 - 29_999, 0) and got["", "AEBCD", 2][:3] == (0, 0, 29_999)
