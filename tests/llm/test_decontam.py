"""Decontamination against a comparison of all windows."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridops.llm import decontam
from gridops.llm.queries import QUERIES
from tests.conftest import SMALL

UNSPACED = "".join(f"{chr(a)}-{chr(b)}" for a, b in decontam.UNSPACED)
WORD = re.compile(f"[{UNSPACED}]|(?:(?![{UNSPACED}])[0-9A-Za-z_\u0080-\U0010ffff])+")


def words_of(text):
    return WORD.findall((text or "").lower())


def overlaps(doc, item):
    """The best share of equal words, laid at any place; 0 below the least that counts."""
    n = min(13, len(item))
    if not item:
        return 0.0
    if len(item) < 5:
        return float(doc == item)
    best = 0
    for i in range(len(doc) - n + 1):
        for j in range(len(item) - n + 1):
            best = max(best, sum(a == b for a, b in zip(doc[i : i + n], item[j : j + n], strict=True)))
    return best / n if best >= 0.8 * n - 1e-9 else 0.0


def test_words_of_every_script():
    texts = ["Hello, wörld_1 x2", "日本語のテスト", "abc日本def กขค", "ไทย 한국어 text", "\u3000全角　空白", "e\u0301a \U00020000\U0001F600z", "", None, "ab\u00a0cd", "日", "a日"]
    hashes, cuts = decontam.word_hashes(pa.array(texts))
    known = {}
    for i, t in enumerate(texts):
        own = hashes[cuts[i] : cuts[i + 1]].tolist()
        assert len(own) == len(words_of(t)), t
        for h, w in zip(own, words_of(t), strict=True):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("n", range(5, 13))
def test_blocks_find_short_items_with_the_words_that_may_differ(n):
    from itertools import combinations

    may = n - -(-8 * n // 10)
    for gone in combinations(range(n), may):
        assert any(not set(range(a, a + size)) & set(gone) for a, size in decontam.short_blocks(n))
    assert sum(size for _, size in decontam.short_blocks(n)) == n


def test_every_kind_of_item(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)] + list("日本語中文字符号")
    draw = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    join = lambda words: "".join(w if len(w) == 1 else f" {w} " for w in words)
    items = [draw(n) for n in (1, 2, 3, 4, 4, 5, 5, 6, 7, 8, 9, 10, 10, 11, 12, 12, 13, 14, 20, 40, 90)]
    items += [list("日本語中文字符号日本語中文"), list("中文字符号"), list("日本")]
    bench = [(i, join(w)) for i, w in enumerate(items)] + [(None, join(draw(15))), (None, join(draw(6))), (3, join(draw(16))), (50, None), (51, " .,;")]
    docs = []
    for _, text in bench:
        own = words_of(text)
        for changed in (0, 1, 2, 3):
            copy = own.copy()
            for i in rnd.sample(range(len(copy)), min(changed, len(copy))):
                copy[i] = "other"
            docs.append(join(copy))
            docs.append(join(draw(30) + copy + draw(30)))
            docs.append(join(draw(9) + copy[len(copy) // 3 :] + draw(9)))
    docs += [None, "", "w1", "日", "日本"] + [join(draw(60)) for _ in range(20)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, item string").repartition(4)
    benchmark = spark.createDataFrame([(*b, "y") for b in bench], "item_id long, text string, words string").repartition(2)
    got = {r["doc_id"]: r for r in decontam.decontaminate(df, benchmark).collect()}
    assert len(got) == len(docs)
    found = [words_of(t) for _, t in bench]
    for i, t in enumerate(docs):
        shares = [overlaps(words_of(t), w) for w in found]
        r = got[i]
        assert (r["contaminated"], r["n_items"], round(r["share"], 9)) == (max(shares) > 0, sum(s > 0 for s in shares), round(max(shares), 9)), (i, t)
        assert r["items"] == sorted({b[0] for b, s in zip(bench, shares, strict=True) if s > 0 and b[0] is not None})
    assert any(r["n_items"] and not r["items"] for r in got.values())
    kept = {r["doc_id"] for r in decontam.drop_contaminated(df, benchmark).collect()}
    assert kept == {i for i, r in got.items() if not r["contaminated"]}


def test_query_equals_all_windows(spark):
    bench = {r["item_id"]: words_of(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    texts = {r["doc_id"]: words_of(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").where(F.length("text") < 3000).collect()}
    got = {r["doc_id"]: r for r in QUERIES["op6_decontamination"](spark, SMALL).collect()}
    # Only items that share a word run of five with a document can have a window in it with two of 13 words changed.
    runs = {}
    for k, w in bench.items():
        for i in range(len(w) - 3):
            runs.setdefault(tuple(w[i : i + 4]), set()).add(k)
    for i, doc in texts.items():
        some = {k for a in range(len(doc) - 3) for k in runs.get(tuple(doc[a : a + 4]), ())}
        want = sorted(k for k in some if overlaps(doc, bench[k]))
        assert got[i]["items"] == want
    assert sum(bool(got[i]["items"]) for i in texts) >= 3
