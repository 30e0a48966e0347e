"""URL filter: rules first, then the ratio of two character language models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm.common import stage
from gridops.session import bounded_broadcast

#: The rules of the query, longest wins.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Longest context in characters, weight of the shorter context, characters of the uniform model below all contexts.
ORDER, BACKOFF, ALPHABET = 5, 2.0, 256
#: What stands before the first character.
START = "\x01"
#: Bins of the calibration histogram over scores from -8 to 8 bits a character; folds of the URLs, of which one is not counted.
BINS, SPREAD, FOLDS = 1024, 8.0, 5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits the host or a parent of it and starts the path; else null."""
    found = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


@dataclass
class RatioModel:
    """Log2 of the ratio of both models by gram (``gram, bits``), and the calibrated threshold."""

    grams: DataFrame
    threshold: float = 0.0


def url_grams(urls: DataFrame) -> DataFrame:
    """Every character of every URL (A-Z in lower case) with the ``ORDER`` characters before it as ``gram``; other columns stay."""
    text = F.concat(F.lit(START * ORDER), F.translate("url", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return urls.select(
        *(c for c in urls.columns if c != "url"),
        F.explode(F.transform(F.sequence(F.lit(1), F.length("url")), lambda i: F.substring(text, i, F.lit(ORDER + 1)))).alias("gram"),
    )


def gram_ratios(grams: DataFrame) -> DataFrame:
    """``gram, bits``: log2 of the probability of a gram's last character after the others as accepted, less that as rejected.

    ``grams`` has every gram once with its counts ``a`` and ``r`` on both sides (0 where it was seen on neither).
    Orders go up from single characters: a character's probability after k others is its count
    there, with ``BACKOFF`` counts spread as after k - 1, over all counts there. Tables hold each string
    of an order once, however often it occurs; the largest grows with the distinct grams of the URLs.
    """
    orders = [grams.select(F.col("gram").alias("s"), "a", "r")]
    for _ in range(ORDER):
        above = orders[-1]
        orders.append(stage(above.groupBy(F.expr("substring(s, 2)").alias("s")).agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "order"))
    known = None
    for k, counts in enumerate(reversed(orders)):
        after = Window.partitionBy(F.substring("s", 1, k))
        told = counts.withColumns({f"{c}_all": F.sum(c).over(after) for c in "ar"})
        if known is None:
            told = told.withColumns({f"p{c}": F.lit(1.0 / ALPHABET) for c in "ar"})
        else:
            told = told.withColumn("shorter", F.expr("substring(s, 2)")).join(known, "shorter")
        p = {c: (F.col(c) + BACKOFF * F.col(f"p{c}")) / (F.col(f"{c}_all") + BACKOFF) for c in "ar"}
        known = stage(told.select(F.col("s").alias("shorter"), p["a"].alias("pa"), p["r"].alias("pr")), "probabilities")
    return known.select(F.col("shorter").alias("gram"), (F.log2("pa") - F.log2("pr")).alias("bits"))


def fit(urls: DataFrame) -> RatioModel:
    """Model of distinct ``url, n, accepted`` rows (``n`` pages each; null where no rule decides).

    Counts are of all decided URLs but a fifth (by hash), on which it is calibrated: the threshold is the
    score that best separates its two sides (mean of both error rates), found on a
    histogram of fixed size. With no rows on one side it is 0.
    """
    held = F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0
    weight = lambda side: F.when(F.col("accepted").eqNullSafe(F.lit(side)) & ~held, F.col("n")).otherwise(0)
    counted = url_grams(urls.select("url", weight(True).alias("a"), weight(False).alias("r")))
    grams = stage(counted.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "grams")
    model = RatioModel(stage(gram_ratios(grams), "ratios"))
    place = F.floor((F.greatest(F.lit(-SPREAD), F.least(F.lit(SPREAD), "score")) + SPREAD) / (2 * SPREAD) * (BINS - 1))
    judged = url_scores(urls.where(held & F.col("accepted").isNotNull()), model, "n", "accepted")
    rows = judged.groupBy(place.cast("int").alias("bin"), "accepted").agg(F.sum("n").alias("n")).collect()
    sides = np.zeros((2, BINS))
    for r in rows:
        sides[int(r["accepted"]), r["bin"]] += r["n"]
    if sides.sum(axis=1).min() > 0:
        share = sides / sides.sum(axis=1, keepdims=True)
        # Error at each cut: accepted below it, rejected from it on.
        errors = np.cumsum(share[1]) - share[1] + 1 - (np.cumsum(share[0]) - share[0])
        best = np.flatnonzero(errors <= errors.min() + 1e-12)
        model.threshold = float(best.mean() / (BINS - 1) * 2 * SPREAD - SPREAD)
    return model


def url_scores(urls: DataFrame, model: RatioModel, *keep: str) -> DataFrame:
    """``uid, score`` (and the columns to keep) of distinct URLs: mean bits a character."""
    grams = url_grams(urls.select(uid().alias("uid"), "url", *keep))
    # Small sums travel, not characters, as long as the table of grams is small enough to be sent out; else it is joined in parts.
    told = grams.join(bounded_broadcast(model.grams), "gram")
    return told.groupBy("uid", *keep).agg(F.avg("bits").alias("score"))


def uid() -> Column:
    """96 bits that stand for a URL where its characters are rows."""
    return F.struct(F.xxhash64("url").alias("h"), F.crc32(F.col("url").cast("binary")).alias("c"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page.

    A fitting rule decides; else the model, which has learned from all URLs that a rule decides:
    at least the threshold is ``allow``. ``score`` is given for all: log2 likelihood of the
    characters as accepted, less that as rejected, by their number. What is counted grows with the URLs,
    and no two grams share a count. A null URL has empty host and path and score 0, as has an empty one;
    repeated rows each get a row; other columns are ignored; an empty table gives no rows.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    # The rule follows from the URL, so equal URLs are one.
    distinct = rows.where(F.length("url") > 0).groupBy("url").agg(F.count("*").alias("n"), (F.max("found.verdict") == "allow").alias("accepted"))
    distinct = stage(distinct, "urls")
    model = fit(distinct)
    scores = stage(url_scores(distinct, model), "scores")
    flat = rows.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("decided"), uid().alias("uid"))
    scored = flat.join(scores, "uid", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    by_model = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", by_model).alias("verdict"), "score")
