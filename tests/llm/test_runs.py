"""Periodic runs against a comparison of every two words."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from gridops.llm import runs
from gridops.llm.queries import QUERIES
from tests.conftest import SMALL


def words_of(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def plain_runs(words, least_words=6, least_periods=4):
    """``(start, length, smallest period)`` of all maximal runs."""
    n, out = len(words), {}
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least_words, least_periods * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in out.items())


def looped(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text):
    words = words_of(text) if doc_id is None else looped(words_of(text), doc_id)
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    text = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(text))


def row(r):
    return (r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed_sha256"])


def samples():
    rnd = random.Random(5)
    out = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "b a a a a a a c", "\x0ba a\x0ca a\ra a\x1c", "é é é é é é x"]
    fib = ["a", "a b"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + " " + fib[-2])
    out += [fib[-1], "x " * 300, "x y " * 100 + "x", "x y x z " * 40, ("a " * 9 + "b ") * 30]
    for _ in range(500):
        letters = "abcd"[: rnd.randrange(1, 5)]
        base = [rnd.choice(letters) for _ in range(rnd.randrange(0, 90))]
        for _ in range(rnd.randrange(3)):
            unit = [rnd.choice(letters) for _ in range(rnd.randrange(1, 9))]
            at = rnd.randrange(len(base) + 1)
            base[at:at] = (unit * 12)[: rnd.randrange(1, 8 * len(unit) + 1)]
        out.append(" ".join(base))
    return out


def test_all_runs_of_many_shapes():
    texts = [words_of(t) for t in samples()]
    names = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    codes = np.array([names[w] for t in texts for w in t])
    cuts = np.cumsum([0, *map(len, texts)])
    for least_words, least_periods in ((6, 4), (2, 2), (4, 3)):
        start, length, period = runs.periodic_runs(codes, cuts, least_words, least_periods)
        text = np.searchsorted(cuts, start, "right") - 1
        got = [[] for _ in texts]
        for t, s, n, q in zip(text.tolist(), (start - cuts[text]).tolist(), length.tolist(), period.tolist(), strict=True):
            got[t].append((s, n, q))
        assert got == [plain_runs(t, least_words, least_periods) for t in texts]


def test_suffix_array_equals_sorting():
    rng = np.random.default_rng(2)
    codes, cuts = rng.integers(0, 3, 200), np.array([0, 0, 70, 71, 200, 200])
    sa = runs.suffix_array(codes, cuts)
    want = [i for a, b in zip(cuts[:-1], cuts[1:], strict=True) for i in sorted(range(a, b), key=lambda i: codes[i:b].tolist())]
    assert sa.order.tolist() == want
    for x in range(1, 200):
        a, b = sa.order[x - 1], sa.order[x]
        n = 0
        while sa.starts[a] == sa.starts[b] and max(a, b) + n < sa.ends[a] and codes[a + n] == codes[b + n]:
            n += 1
        assert sa.lcp[x] == n


@pytest.mark.parametrize("partitions", [1, 4])
def test_rows_with_odd_ids_and_columns(spark, partitions):
    rows = [(i, t, "r", "c") for i, t in enumerate(samples())] + [(None, "a a a a a a", "", None), (None, "a a a a a a", "", None), (3, "z", None, None), (3, "z", None, None)]
    # Ids that are looped, a very long text among them.
    loops = [i for i in range(20_000, 21_000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rnd = random.Random(1)
    rows += [(i, " ".join(rnd.choice(["x", "yy", "é", "z."]) + str(rnd.randrange(k + 1)) for _ in range(k * 9)), "", "") for k, i in enumerate(loops)]
    rows.append((-7, "lorem ipsum dolor " * 20_000, "", ""))
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed string").repartition(partitions)
    got = runs.run_digest(runs.find_runs(df, loops=True)).collect()
    want = [plain_row(i, t) for i, t, *_ in rows if i != -7]
    assert sorted((row(r) for r in got if r["doc_id"] != -7), key=str) == sorted(want, key=str)
    (long,) = (r for r in got if r["doc_id"] == -7)
    if zlib.crc32(b"-7") % 10:
        assert (long["n_runs"], long["start"], long["length"], long["period"], long["exponent_milli"]) == (1, 0, 60_000, 3, 20_000_000)
    assert runs.find_runs(df.limit(0)).count() == 0


def test_collapsed_text_and_spans(spark):
    df = spark.createDataFrame([(1, "go  no no no no no no\nno on"), (2, "one two")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in runs.find_runs(df).collect()}
    assert bytes(got[1]["collapsed"]) == b"go no on" and [tuple(x) for x in got[1]["runs"]] == [(1, 7, 1)]
    assert bytes(got[2]["collapsed"]) == b"one two" and got[2]["runs"] == []


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: row(r) for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert len(got) == len(texts) and any(g[1] for g in got.values())
    short = [i for i in texts if len(words_of(texts[i])) < 1500]
    assert len(short) > 150 and {i: got[i] for i in short} == {i: plain_row(i, texts[i]) for i in short}
