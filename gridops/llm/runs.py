"""Periodic runs of words by the branching-tandem test on an enhanced suffix array, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm.common import flat_bytes, pieces, ragged, slices
from gridops.llm.units import word_spans

#: Fixed values of the contract: words and periods that a run has at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4


@dataclass
class SuffixArray:
    """Suffixes of all texts of a batch; suffixes of different texts never compare equal in any prefix."""

    order: np.ndarray  # SA: places, sorted by text and then by suffix
    place: np.ndarray  # ISA
    lcp: np.ndarray  # by index of the order: words shared with the suffix before it; one 0 more at the end
    levels: list[np.ndarray]  # by k: number of the string of 2**k words at each place, equal numbers for equal strings
    starts: np.ndarray  # by place: first place of its text, and the place behind its last
    ends: np.ndarray


def _numbered(keys: np.ndarray) -> np.ndarray:
    """Position of each key's group among the sorted keys."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    return out


def suffix_array(codes: np.ndarray, by_text: np.ndarray) -> SuffixArray:
    """Prefix doubling: each round only places whose string is not yet the only one of its kind are sorted again."""
    n = len(codes)
    sizes = np.diff(by_text)
    starts, ends = np.repeat(by_text[:-1], sizes), np.repeat(by_text[1:], sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    rank = _numbered(text * (int(codes.max()) + 1 if n else 1) + codes)
    levels, step = [rank], 1
    while True:
        counts = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(counts[rank] > 1)
        if not len(open_):
            break
        ahead = open_ + step
        inside = ahead < ends[open_]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        # Ranks leave room for the members of their group, so the new rank is the old one and the place inside.
        key = rank[open_] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key, sorted_rank = key[order], rank[open_][order]
        at = np.arange(len(order))
        group = np.ones(len(order), bool)
        group[1:] = sorted_rank[1:] != sorted_rank[:-1]
        new = np.ones(len(order), bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        first = np.maximum.accumulate(np.where(group, at, 0))
        own = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[open_[order]] = sorted_rank + own - first
        levels.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    out = SuffixArray(order, rank, np.zeros(n + 1, np.int64), levels, starts, ends)
    if n > 1:
        met = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
        out.lcp[met + 1] = shared_ahead(out, order[met], order[met + 1])
    return out


def shared_ahead(sa: SuffixArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` (different places of one text) share, by the levels from the longest string down."""
    at, to, n = a.copy(), b.copy(), len(sa.order)
    for k in range(len(sa.levels) - 1, -1, -1):
        level = sa.levels[k]
        ok = (np.maximum(at, to) < sa.ends[a]) & (level[np.minimum(at, n - 1)] == level[np.minimum(to, n - 1)])
        at, to = at + (ok << k), to + (ok << k)
    return at - a


def shared_behind(sa: SuffixArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words before ``a`` and ``b`` (a < b, one text) that are equal."""
    at, to = a.copy(), b.copy()
    for k in range(len(sa.levels) - 1, -1, -1):
        level, low = sa.levels[k], at - (1 << k)
        ok = low >= sa.starts[a]
        ok &= level[np.maximum(low, 0)] == level[np.maximum(to - (1 << k), 0)]
        at, to = at - (ok << k), to - (ok << k)
    return a - at


def _nearest_smaller(lcp: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each index of ``at``: the nearest index before (step -1) or behind it (1) with a smaller value.

    All indices jump at once over what those they point to have already passed.
    """
    to = np.arange(len(lcp)) + step
    todo = at
    while len(todo):
        todo = todo[lcp[to[todo]] >= lcp[todo]]
        to[todo] = to[to[todo]]
    return to[at]


def squares(sa: SuffixArray, least: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of tandem repeats: of every run with ``least`` periods one at least, at its right end.

    For every interval of the common prefixes (depth d) the suffixes outside its largest
    child are looked at: where the suffix d words before or behind is in the interval,
    too, a string of d words stands there twice. A run of ``least`` periods has an interval
    of as many suffixes, so smaller ones are passed over. Which intervals a suffix is in
    outside the largest child comes from heavy paths over the intervals, of which each has a
    logarithmic number on its way up; only arrays of interval bounds are kept.
    """
    inner = np.flatnonzero(sa.lcp > 0)
    none = np.zeros(0, np.int64)
    if not len(inner):
        return none, none
    # A 0 stands at both ends, and wherever a text or a word ends.
    low, high = _nearest_smaller(sa.lcp, inner, -1), _nearest_smaller(sa.lcp, inner, 1) - 1
    _, first, number = np.unique(low * len(sa.lcp) + high, return_index=True, return_inverse=True)
    node_at = np.full(len(sa.lcp), -1)
    node_at[inner] = number  # the interval that a border between two suffixes belongs to
    low, high, depth = low[first], high[first], sa.lcp[inner[first]]
    size = high - low + 1

    def above(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The next larger interval of what lies between two borders: that of the higher one; -1 if there is none."""
        return node_at[np.where(sa.lcp[left] >= sa.lcp[right], left, right)]

    parent = above(low, high + 1)
    # The largest child of each interval continues its path; paths start at the others.
    child = np.flatnonzero(parent >= 0)
    child = child[np.lexsort((child, -size[child], parent[child]))]
    largest = np.zeros(len(parent), bool)
    largest[child[np.unique(parent[child], return_index=True)[1]]] = True
    top = np.where(largest, parent, np.arange(len(parent)))
    while (top != top[top]).any():
        top = top[top]

    members = np.flatnonzero((sa.lcp[:-1] > 0) | (sa.lcp[1:] > 0))
    node = above(members, members + 1)
    found_at, found_d = [], []
    while len(members):
        big = size[node] >= least
        index, own = members[big], node[big]
        at, d = sa.order[index], depth[own]
        for other in (at + d, at - d):
            inside = (other >= sa.starts[at]) & (other < sa.ends[at])
            met = sa.place[np.where(inside, other, 0)]
            ok = inside & (met >= low[own]) & (met <= high[own])
            found_at.append(np.minimum(at, other)[ok])
            found_d.append(d[ok])
        up = parent[top[node]]
        members, node = members[up >= 0], up[up >= 0]
    return np.concatenate(found_at), np.concatenate(found_d)


def periodic_runs(codes: np.ndarray, by_text: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all maximal runs, by start and then period.

    ``codes`` numbers the words of all texts, ``by_text`` has the texts' offsets; a run has ``least_periods``
    periods (2 at least) and ``least_words`` words at least. Squares are rotated as far as the words on
    both sides go on with their period; those of one run meet in one stretch, and its
    smallest period is the run's (longer ones are multiples).
    """
    sa = suffix_array(codes, by_text)
    at, period = squares(sa, least_periods)
    if len(at):
        _, first = np.unique(at * (len(codes) + 1) + period, return_index=True)
        at, period = at[first], period[first]
    start = at - shared_behind(sa, at, at + period)
    length = at + period + shared_ahead(sa, at, at + period) - start
    ok = length >= np.maximum(least_words, least_periods * period)
    start, length, period = start[ok], length[ok], period[ok]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def looped_words(n: int, key: int) -> np.ndarray | None:
    """Fixed rule of the contract: which original word stands at each of ``n`` places if ``key`` asks for loops, else None."""
    if key % 10 or not n:
        return None
    g = key // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def _batch_runs(texts: pa.Array, keys: list[int | None] | None, least_words: int, least_periods: int) -> dict[str, pa.Array]:
    data, offsets = flat_bytes(texts)
    starts, ends, by_text = word_spans(data, offsets)
    if keys is not None:
        source = np.arange(len(starts))
        for i, key in enumerate(keys):
            if key is not None and key % 10 == 0 and (moved := looped_words(int(by_text[i + 1] - by_text[i]), key)) is not None:
                source[by_text[i] : by_text[i + 1]] = by_text[i] + moved
        starts, ends = starts[source], ends[source]
    codes = pieces(data, starts, ends).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
    start, length, period = periodic_runs(codes, by_text, least_words, least_periods)
    # Words after the first period of any run are dropped.
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    where, cuts = ragged(starts[kept], ends[kept] - starts[kept] + 1)
    joined = np.append(data, np.uint8(32))[np.minimum(where, len(data))]
    joined[cuts[1:] - 1] = 32
    text_cuts = cuts[np.searchsorted(kept, by_text)]
    run_text = np.searchsorted(by_text, start, "right") - 1
    first = start - by_text[run_text]
    run_cuts = np.searchsorted(run_text, np.arange(len(by_text)))
    return {
        "runs": pa.ListArray.from_arrays(
            pa.array(run_cuts, pa.int32()),
            pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (first, length, period)], ["start", "length", "period"]),
        ),
        "collapsed": pa.array([joined[a : max(a, b - 1)].tobytes() for a, b in zip(text_cuts[:-1].tolist(), text_cuts[1:].tolist(), strict=True)], pa.large_binary()),
    }


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loops: bool = False, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> DataFrame:
    """``doc_id, runs, collapsed``: the periodic runs of every document, and its text with each run cut to one period.

    Words are what stands between ASCII white space; a run is a stretch of words with
    smallest period q, ``least_words`` words and ``least_periods`` periods at least, that no
    neighbouring word extends. ``runs`` are ``start, length, period`` in words, by start and
    then period; ``collapsed`` (UTF-8 bytes) has the words that no run contains after its first
    period, joined by one space. With ``loops`` documents are first looped by
    the rule of ``looped_words`` for the CRC-32 of their id as text (a null id is not looped).

    Texts are handled in batches of some megabytes, a longer text alone, in memory that grows with its
    words times the logarithm of its longest repeat. Rows keep their partitions, nothing is shuffled.
    A null or blank text has no runs; repeated rows each get a row; other columns are ignored; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            found = _batch_runs(batch["text"], batch["key"].to_pylist() if loops else None, least_words, least_periods)
            yield pa.record_batch([batch["doc_id"], found["runs"], found["collapsed"].cast(pa.binary())], ["doc_id", "runs", "collapsed"])

    doc_id = F.col(id_col)
    rows = docs.select(doc_id.alias("doc_id"), F.crc32(doc_id.cast("string").cast("binary")).alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs {_RUNS}, collapsed binary")


def run_digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_runs``, the run of most periods (``start, length, period, exponent_milli``; nulls without a run) and both digests."""
    # Exact order of the exponents: a/b > c/d as a*d > c*b; ties keep the earlier run, then the smaller period.
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda acc, r: F.when(acc.isNull() | (r["length"] * acc["period"] > acc["length"] * r["period"]), r).otherwise(acc),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

