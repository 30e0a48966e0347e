"""The URL filter against a model kept in dictionaries."""

import math
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from gridops.llm import urls
from gridops.llm.queries import QUERIES
from tests.conftest import SMALL


def host_and_path(url):
    if "://" not in (url or ""):
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    found = None, None
    for rule, verdict in sorted(urls.RULES, key=lambda r: len(r[0])):
        name, start = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            found = rule, verdict
    return found


def grams(url):
    text = "\x01" * urls.ORDER + "".join(c.lower() if "A" <= c <= "Z" else c for c in url)
    return [text[i : i + urls.ORDER + 1] for i in range(len(url))]


def plain_judgement(pages):
    """``{id: (host, path, rule, verdict, score)}`` with counts in dictionaries."""
    told = {i: (*host_and_path(u), *rule_of(*host_and_path(u))) for i, u in pages}
    held = lambda u: (xxhash.xxh64_intdigest(u.encode(), 42) + (1 << 63)) % (1 << 64) % urls.FOLDS == (1 << 63) % urls.FOLDS  # noqa: E731  # of the signed hash
    counts = {"allow": [defaultdict(Counter) for _ in range(urls.ORDER + 1)], "block": [defaultdict(Counter) for _ in range(urls.ORDER + 1)]}
    for i, u in pages:
        if u and told[i][3] and not held(u):
            for g in grams(u):
                for k in range(urls.ORDER + 1):
                    counts[told[i][3]][k][g[urls.ORDER - k : urls.ORDER]][g[-1]] += 1

    def probability(side, g):
        p = 1 / urls.ALPHABET
        for k in range(urls.ORDER + 1):
            seen = counts[side][k].get(g[urls.ORDER - k : urls.ORDER], Counter())
            p = (seen[g[-1]] + urls.BACKOFF * p) / (sum(seen.values()) + urls.BACKOFF)
        return p

    known = {}
    score = {}
    for u in {u for _, u in pages if u}:
        bits = [known.setdefault(g, math.log2(probability("allow", g)) - math.log2(probability("block", g))) for g in grams(u)]
        score[u] = sum(bits) / len(bits)
    sides = {"allow": Counter(), "block": Counter()}
    for i, u in pages:
        if u and told[i][3] and held(u):
            bin_ = math.floor((max(-urls.SPREAD, min(urls.SPREAD, score[u])) + urls.SPREAD) / (2 * urls.SPREAD) * (urls.BINS - 1))
            sides[told[i][3]][bin_] += 1
    threshold = 0.0
    if all(sides.values()):
        total = {s: sum(c.values()) for s, c in sides.items()}
        errors = [
            sum(n for b, n in sides["allow"].items() if b < cut) / total["allow"] + sum(n for b, n in sides["block"].items() if b >= cut) / total["block"]
            for cut in range(urls.BINS)
        ]
        best = [cut for cut, e in enumerate(errors) if e <= min(errors) + 1e-12]
        threshold = sum(best) / len(best) / (urls.BINS - 1) * 2 * urls.SPREAD - urls.SPREAD
    out = {}
    for i, u in pages:
        host, path, rule, verdict = told[i]
        s = score.get(u, 0.0)
        out[i] = (host, path, rule, verdict or ("allow" if s >= threshold else "block"), s)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for i, (host, path, rule, verdict, score) in want.items():
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict) and abs(r["score"] - score) < 1e-9


@pytest.mark.parametrize("sent", [True, False])
def test_judgement_equals_the_plain_model(spark, monkeypatch, sent):
    if not sent:  # as for a table of grams that is too large to be sent out
        monkeypatch.setattr(urls, "bounded_broadcast", lambda small: small)
    rnd = random.Random(9)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 9)))
    some = [f"http://{word('abcdef')}.org/{word('good')}" for _ in range(120)] + [f"HTTP://{word('uvwxyz')}.com/de/{word('junk')}" for _ in range(120)]
    some += [f"https://{word('abcxyz')}.net/{word('gojunk')}?{word('é日q')}#x" for _ in range(60)] + ["http://hot.org/a"] * 50
    some += [None, "", "x", "http://b.com/de/" + "long" * 5000, "http://a.org/" + "\x01" * 9, "no scheme/org/"]
    df = spark.createDataFrame(list(enumerate(some)), "page_id long, url string").withColumns({c: F.lit("c") for c in ("uid", "gram", "a", "r", "n", "accepted", "found")}).repartition(5)
    same({r["page_id"]: r for r in urls.judge_urls(df).collect()}, plain_judgement(list(enumerate(some))))


def test_query_equals_the_plain_model(spark):
    pages = [(r["page_id"], r["url"]) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    same({r["page_id"]: r for r in QUERIES["op4_url_filter"](spark, SMALL).collect()}, plain_judgement(pages))


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, None), (2, None), (None, "q")], "page_id long, url string")
    rows = urls.judge_urls(df).collect()
    assert len(rows) == 4 and all(r["verdict"] == "allow" and r["score"] == 0 for r in rows)
