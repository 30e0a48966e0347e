"""Removal of repeated byte strings by column-wise suffix sorting of aligned fragments."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm.common import flat_bytes, mix, prefix_sums, ragged, signed, slices, span_hash, stage

#: Bytes of a repeated string, and of the gram inside it that brings its copies together.
LENGTH, GRAM = 400, 100
#: Window starts handled at a time in one text.
CHUNK = 1 << 20


def _anchors(data: np.ndarray, sums: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each start of a window: the place of its smallest gram hash, the first of equal ones.

    It depends on the window alone, so equal windows have it at the same place inside.
    """
    at = np.arange(len(data) - gram + 1)
    h = mix(span_hash(sums, at, at + gram))
    low = np.uint64((1 << 24) - 1)
    keyed = (h & ~low) | at.astype(np.uint64)
    width = length - gram + 1
    padded = np.full(-(-len(keyed) // width) * width, ~np.uint64(0))
    padded[: len(keyed)] = keyed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keyed) - width + 1
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def fragments_of(texts: pa.Array, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Cut the windows of all texts into fragments of neighbouring windows with one anchor.

    By fragment: ``text``, ``at`` (first window), ``n`` (windows), ``lead`` (anchor less
    first window), ``anchor`` (hash of the anchor's gram), ``body`` (hash of all its
    bytes and of the other figures). Every window is in one fragment.
    """
    data, offsets = flat_bytes(texts)
    raw = memoryview(np.ascontiguousarray(data))
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("text", "at", "n", "lead", "anchor", "body")}
    for base in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[base : base + CHUNK + length - 1]
        sums = prefix_sums(part)
        anchors = _anchors(part, sums, length, gram) if len(part) >= length else np.zeros(0, np.int64)
        stops = np.clip(offsets[1:] - length + 1 - base, 0, len(anchors))
        begins = np.clip(offsets[:-1] - base, 0, len(anchors))
        sizes = np.maximum(stops - begins, 0)
        starts, _ = ragged(begins, sizes)
        if not len(starts):
            continue
        text = np.repeat(np.arange(len(sizes)), sizes)
        place = anchors[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (text[1:] != text[:-1]) | (place[1:] != place[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(starts)))
        at, place, text = starts[first], place[first], text[first]
        lead = place - at
        ends = at + n + length - 1
        body = np.fromiter(
            (xxhash.xxh3_64_intdigest(raw[a:b], k) for a, b, k in zip((at + base).tolist(), (ends + base).tolist(), lead.tolist(), strict=True)),
            np.uint64,
            len(at),
        )
        found = {"text": text, "at": at + base - offsets[text], "n": n, "lead": lead, "anchor": span_hash(sums, place, place + gram), "body": body}
        for k, v in found.items():
            out[k].append(v)
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


def _occurrences(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            f = fragments_of(batch["text"], length, gram)
            own = pa.array(f["text"], pa.int64())
            columns = {
                "rid": batch["rid"].take(own),
                "size": batch["size"].take(own),
                "at": pa.array(f["at"], pa.int32()),
                "n": pa.array(f["n"], pa.int32()),
                "lead": pa.array(f["lead"], pa.int32()),
                "anchor": pa.array(signed(f["anchor"])),
                "body": pa.array(signed(f["body"])),
            }
            yield pa.record_batch(list(columns.values()), list(columns))

    return rows.mapInArrow(run, "rid bigint, size int, at int, n int, lead int, anchor bigint, body bigint")


def repeated_windows(fragments: list[bytes], leads: np.ndarray, groups: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """By fragment: which of its windows stand in another fragment of its group, too.

    The collection's Burrows-Wheeler transform grows by columns, from the right: each
    round puts one symbol of every fragment before its suffix. The symbols in the order
    of the suffixes are the new section of the transform; sorting them stably gives the
    order of the longer suffixes, and the smallest common prefix between two equal
    symbols, plus one, is the new common prefix. Fragments are aligned at their anchor,
    which equal windows have at one place, so suffixes of different rounds never share
    a window, and a finished section is no longer needed.
    """
    sizes = np.array([len(f) for f in fragments])
    data = np.frombuffer(b"".join(fragments), np.uint8)
    bases = np.concatenate(([0], np.cumsum(sizes)[:-1])) + leads  # place of each anchor
    rights, lefts = sizes - leads - 1, -leads
    repeated = [np.zeros(max(0, s - length + 1), bool) for s in sizes.tolist()]
    flat, cuts = np.zeros(sum(map(len, repeated)), bool), np.concatenate(([0], np.cumsum([len(r) for r in repeated])))
    by_right = np.argsort(-rights, kind="stable")
    _, group = np.unique(groups, return_inverse=True)
    order, common, entered = np.zeros(0, np.int64), np.zeros(0, np.int32), 0
    for column in range(int(rights.max()), int(lefts.min()) - 1, -1):
        stay = lefts[order] <= column
        if not stay.all():
            # A fragment that has ended leaves; the next one inherits the smaller common prefix.
            kept = np.flatnonzero(stay)
            common = np.minimum.reduceat(common[: kept[-1] + 1], np.concatenate(([0], kept[:-1] + 1))) if len(kept) else common[:0]
            order = order[kept]
        upto = entered
        while upto < len(by_right) and rights[by_right[upto]] >= column:
            upto += 1
        if upto > entered:
            order = np.concatenate([by_right[entered:upto], order])
            common = np.concatenate([np.zeros(upto - entered, np.int32), common])
            entered = upto
        if not len(order):
            continue
        section = data[bases[order] + column]
        code = group[order] * 256 + section
        rank = np.argsort(code, kind="stable")
        same = code[rank[1:]] == code[rank[:-1]]
        longer = np.zeros(len(order), np.int32)
        if same.any():
            spans = np.stack([rank[:-1][same] + 1, rank[1:][same] + 1], axis=1).ravel()
            smallest = np.minimum.reduceat(np.append(common, 0), spans)[::2]
            longer[1:][same] = smallest + 1
        order, common = order[rank], longer
        hit = common >= length
        if hit.any():
            met = hit.copy()
            met[:-1] |= hit[1:]
            who = order[met]
            flat[cuts[who] + column + leads[who]] = True
    return np.split(flat, cuts[1:-1])


def _ranges(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return [{"a": a, "b": b} for a, b in zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True)]


def _fetched(rows: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """``anchor, body, lead, bytes``: the bytes of one occurrence of each kind of fragment."""
    wanted = kinds.groupBy("rid", "size").agg(F.collect_list(F.struct("anchor", "body", "lead", "at", "n")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            out = []
            for text, wants in zip(batch["text"], batch["wanted"].to_pylist(), strict=True):
                data = text.as_py().encode()
                for w in wants:
                    cut = data[w["at"] : w["at"] + w["n"] + length - 1]
                    # Another text with the same hash and size would show here.
                    if xxhash.xxh3_64_intdigest(cut, w["lead"]) == w["body"] % (1 << 64):
                        out.append((w["anchor"], w["body"], w["lead"], cut))
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)]
            if out:
                yield pa.record_batch(columns, ["anchor", "body", "lead", "bytes"])

    joined = rows.join(wanted, ["rid", "size"]).select("text", "wanted")
    return joined.mapInArrow(run, "anchor bigint, body bigint, lead int, bytes binary").dropDuplicates(["anchor", "body"])


def _sorted_out(fragments: DataFrame, length: int, batch_size: int) -> DataFrame:
    """``anchor, body, ranges`` of the fragments whose anchors have at most ``batch_size`` kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve() -> pa.RecordBatch:
            flags = repeated_windows([h[3] for h in held], np.array([h[2] for h in held]), np.array([h[0] for h in held]), length)
            ranges = pa.array([_ranges(f) for f in flags], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            return pa.record_batch([pa.array([h[0] for h in held]), pa.array([h[1] for h in held]), ranges], ["anchor", "body", "ranges"])

        last = None
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("anchor", "body", "lead", "bytes")), strict=True):
                if len(held) >= batch_size and row[0] != last:
                    yield solve()
                    held = []
                held.append(row)
                last = row[0]
        if held:
            yield solve()

    n = int(fragments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = fragments.repartition(n, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "anchor bigint, body bigint, ranges array<struct<a:int,b:int>>")


def _counted_out(fragments: DataFrame, length: int) -> DataFrame:
    """The same for anchors with more kinds: their windows are hashed twice and counted, nothing is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 1 << 18):
            for anchor, body, lead, cut in zip(*(batch[c].to_pylist() for c in ("anchor", "body", "lead", "bytes")), strict=True):
                data = np.frombuffer(cut, np.uint8)
                at = np.arange(len(data) - length + 1)
                place = (lead - at).astype(np.uint64)
                one = mix(span_hash(prefix_sums(data), at, at + length) + place)
                two = np.fromiter((xxhash.xxh3_64_intdigest(cut[i : i + length]) for i in at.tolist()), np.uint64, len(at))
                n = len(at)
                columns = [np.full(n, anchor), np.full(n, body), at.astype(np.int32), signed(one), signed(two)]
                yield pa.record_batch([pa.array(c) for c in columns], ["anchor", "body", "w", "one", "two"])

    windows = fragments.mapInArrow(run, "anchor bigint, body bigint, w int, one bigint, two bigint")
    twice = windows.groupBy("one", "two").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    hits = windows.join(twice, ["one", "two"])
    single = F.struct(F.col("w").alias("a"), F.col("w").alias("b"))
    return hits.groupBy("anchor", "body").agg(F.collect_list(single).alias("ranges"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, batch_size: int = 4096) -> DataFrame:
    """``rid, size, spans``: ranges of repeated windows in each distinct text (``rid, size, text``) that has any.

    1. Texts are cut into fragments at content-chosen anchors; equal windows of any
       two places have anchors with equal grams at the same place inside them.
    2. Anchors seen once are dropped. Fragments wholly equal to another are repeated
       throughout, and count as one from here on.
    3. Of each kind of fragment that shares its anchor with a different kind, one is
       fetched; they are sorted column by column, ``batch_size`` at a time.
    4. Anchors with more kinds than that are settled by counting window hashes.
    Repeats depend on the text alone, so texts stand for the rows that hold them.
    """
    places = stage(_occurrences(rows, length, gram), "fragments")
    shared = places.groupBy("anchor").agg(F.count("*").alias("m"), F.min("body").alias("low"), F.max("body").alias("high")).where(F.col("m") > 1)
    # Written first, so that the join meets two plain shuffles and Spark can split a frequent anchor.
    shared = stage(shared.select("anchor", (F.col("low") == F.col("high")).alias("uniform")), "anchors")
    busy = stage(places.join(shared, "anchor"), "shared")
    mixed = busy.where(~F.col("uniform"))
    # rid, size and at are non-null, so the firsts are of one row.
    kinds = mixed.groupBy("anchor", "body").agg(
        F.count("*").alias("m"), *(F.first(c).alias(c) for c in ("rid", "size", "at", "n", "lead"))
    )
    kinds = stage(kinds, "kinds")
    full = kinds.groupBy("anchor").agg(F.count("*").alias("k")).where(F.col("k") > batch_size).select("anchor")
    plain, crowded = kinds.join(full, "anchor", "left_anti"), kinds.join(full, "anchor", "left_semi")
    found = _sorted_out(_fetched(rows, plain, length), length, batch_size)
    if not full.isEmpty():
        found = found.union(_counted_out(stage(_fetched(rows, crowded, length), "crowded"), length))
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("n") - 1).alias("b")))
    some = kinds.join(found, ["anchor", "body"], "left").select(
        "anchor", "body", F.when(F.col("m") > 1, whole).otherwise(F.col("ranges")).alias("ranges")
    )
    some = some.where(F.size("ranges") > 0)
    at = F.col("at")
    spans = mixed.join(stage(some, "ranges"), ["anchor", "body"]).select(
        "rid", "size", F.transform("ranges", lambda r: F.struct((at + r["a"]).alias("a"), (at + r["b"]).alias("b"))).alias("spans")
    )
    plainly = busy.where("uniform").select("rid", "size", F.array(F.struct(at.alias("a"), (at + F.col("n") - 1).alias("b"))).alias("spans"))
    every = spans.union(plainly).groupBy("rid", "size").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    return stage(every, "spans")


def cut_spans(data: bytes, spans: list[dict[str, int]] | None, length: int = LENGTH) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs, and what is left."""
    kept, removed, runs, end = [], 0, 0, 0
    for a, b in sorted((s["a"], s["b"] + length) for s in spans or ()):
        if a > end or not runs:
            kept.append(data[end:a])
            runs += 1
            removed += b - a
        else:
            removed += max(0, b - end)
        end = max(end, b)
    kept.append(data[end:])
    return removed, runs, b"".join(kept)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, batch_size: int = 4096) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    Every byte covered by a ``length``-byte string that also starts anywhere else, in
    the same or another document, is removed; ``kept`` has the remaining bytes. A null
    text is empty; texts under ``length`` bytes stay whole; rows repeated with one text
    are copies of each other. Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("rid"), F.octet_length("text").alias("size"), "text")
    found = repeated_spans(rows.where(F.col("size") >= length).select("rid", "size", "text"), length, gram, batch_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            cuts, digests, sizes = [], [], pc.binary_length(batch["text"])
            for t, spans in zip(batch["text"], batch["spans"].to_pylist(), strict=True):
                cuts.append(cut_spans(t.as_py().encode(), spans, length))
                digests.append(hashlib.sha256(cuts[-1][2]).hexdigest())
            columns = {
                "doc_id": batch["doc_id"],
                "n_bytes": sizes.cast(pa.int64()),
                "n_removed": pa.array([c[0] for c in cuts], pa.int64()),
                "n_spans": pa.array([c[1] for c in cuts], pa.int64()),
                "kept_sha256": pa.array(digests),
                "kept": pa.array([c[2] for c in cuts], pa.binary()),
            }
            yield pa.record_batch(list(columns.values()), list(columns))

    joined = rows.join(found, ["rid", "size"], "left").select("doc_id", "text", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
