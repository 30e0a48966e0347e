"""SimHash near-duplicates found through Golay-code keys."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridops.llm.common import signed, slices, stage, unused
from gridops.llm.components import connected_components

#: Fixed values of the fingerprint: words per shingle, seed of XXH64.
SHINGLE, SEED = 3, 42
#: Fixed values of the binary Golay code: generator polynomial, word and check bits.
GENERATOR, WORD, CHECK = 0xC75, 23, 11
#: First bit and width of the three fingerprint segments; the last is filled up with zeros.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Bits in which linked fingerprints may differ.
MAX_BITS = 2

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None) -> int:
    """64-bit fingerprint of a text: a bit is set if it is set in over half of the shingle hashes."""
    words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    counts = np.zeros((8, 256), np.int64)
    for i in range(0, len(hashes), 1 << 16):
        octets = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8) + np.arange(8) * 256
        counts += np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
    votes = (counts @ _BITS).ravel()
    return int.from_bytes(np.packbits(votes * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(rows: DataFrame) -> DataFrame:
    """``rows`` with column ``__fp`` (bigint); reads the text column ``__text`` and drops it."""
    keep = [c for c in rows.columns if c != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            found = np.fromiter((fingerprint(t.as_py()) for t in batch["__text"]), np.uint64, batch.num_rows)
            yield pa.record_batch([*(batch[c] for c in keep), pa.array(signed(found))], [*keep, "__fp"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.mapInArrow(run, f"{kinds}, __fp bigint")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders by the generator polynomial."""
    rest = words.copy()
    for bit in range(WORD - 1, CHECK - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - CHECK), 0)
    return rest


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """By syndrome: the error patterns of up to 4 bits that lead to a codeword, filled up with -1."""
    patterns = np.array([sum(1 << b for b in c) for k in range(5) for c in combinations(range(WORD), k)])
    table = [[] for _ in range(1 << CHECK)]
    for s, p in zip(_syndromes(patterns).tolist(), patterns.tolist(), strict=True):
        table[s].append(p)
    width = max(map(len, table))
    return np.array([t + [-1] * (width - len(t)) for t in table])


def near_codewords(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 bits of each 23-bit word: one or six, filled up with -1.

    Two words that differ in at most two bits have such a codeword in common.
    """
    errors = _errors()[_syndromes(words)]
    return np.where(errors >= 0, (words[:, None] ^ errors) >> CHECK, -1)


@lru_cache(maxsize=1)
def _codewords() -> np.ndarray:
    """All codewords by their index, a column each, bits as 1 and -1."""
    words = np.arange(1 << (WORD - CHECK)) << CHECK
    return ((((words ^ _syndromes(words)) >> np.arange(WORD)[:, None]) & 1) * 2 - 1).astype(np.float32)


def nearest_codewords(votes: np.ndarray, most: int = 2) -> np.ndarray:
    """Indices of the ``most`` codewords nearest to each row of 23 votes, nearest first.

    A vote says by its sign which bit a fingerprint has, by its size how far the bit is from turning. Bits that may
    turn count little, so near copies meet more often than by their bits alone (``near_codewords``).
    """
    found = np.empty((len(votes), most), np.int64)
    for i in range(0, len(votes), 256):
        scores = votes[i : i + 256].astype(np.float32) @ _codewords()
        rows = np.arange(len(scores))
        for k in range(most):
            best = found[i : i + 256, k] = scores.argmax(axis=1)
            scores[rows, best] = -np.inf
    return found


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints and the number of the fingerprint each belongs to.

    Of two differing bits, one of three segments has none; it stands in the key as it
    is, the next segment, with at most two, as its near codewords.
    """
    fps = fps.astype(np.uint64)
    parts = [(fps >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1) for at, width in SEGMENTS]
    keys, owners = [], []
    for i, exact in enumerate(parts):
        near = near_codewords(parts[(i + 1) % len(parts)])
        rows, _ = np.nonzero(near >= 0)
        keys.append((i << 40 | exact[rows] << 12) | near[near >= 0])
        owners.append(rows)
    return np.concatenate(keys), np.concatenate(owners)


def _keyed(fps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False)
            keys, owners = golay_keys(fp.view(np.uint64))
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(fp[owners])], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key bigint, fp bigint")


def fingerprint_links(fps: DataFrame, bucket_limit: int = 64) -> DataFrame:
    """Edges ``a, b`` that link all fingerprints differing in at most two bits, directly or in steps.

    Fingerprints meet in the buckets of their Golay keys. In buckets of up to
    ``bucket_limit`` all pairs are verified. Fuller buckets are not paired: each of
    their fingerprints offers itself and its 64 one-bit neighbours, and those that
    offer the same value, which differ in at most two bits, are hung on the smallest.
    That takes 65 rows a fingerprint however full the bucket, and finds the same classes.
    """
    keyed = _keyed(fps)
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    busy = stage(keyed.join(counts, "key"), "buckets")
    small = busy.where(F.col("n") <= bucket_limit)
    left, right = small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = left.join(right, (left["key"] == right["key"]) & (F.col("a") > F.col("b")) & (differ <= MAX_BITS)).select("a", "b")
    full = busy.where(F.col("n") > bucket_limit).select("fp").distinct()
    flips = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))))
    offers = full.select("fp", F.explode(flips).alias("at"))
    least = offers.groupBy("at").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    stars = offers.join(least, "at").where(F.col("fp") > F.col("b")).select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).distinct()


def _classes(members: DataFrame, least: Column, bucket_limit: int) -> DataFrame:
    """``__fp, first``: the smallest value of ``least`` in the component of each fingerprint."""
    fps = stage(members.groupBy("__fp").agg(F.min(least).alias("first")), "fingerprints")
    roots = connected_components(fingerprint_links(fps.select(F.col("__fp").alias("fp")), bucket_limit))
    linked = fps.join(roots, fps["__fp"] == roots["node"], "left").select("__fp", "first", F.coalesce("root", "__fp").alias("root"))
    firsts = linked.groupBy("root").agg(F.min("first").alias("first"))
    return linked.select("__fp", "root").join(firsts, "root").select("__fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_limit: int = 64) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    ``component_id`` is the smallest doc_id reachable over fingerprints that differ in
    at most two bits. Null, empty and blank texts have fingerprint zero and link like
    any other. A null doc_id is never the smallest; if a component has no other its id
    is null. Repeated rows give as many rows. Other columns are ignored; an empty table
    gives no rows. Documents with one fingerprint collapse before anything is linked.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("__text"))
    members = stage(fingerprints(rows), "simhash")
    classes = _classes(members, F.col("doc_id"), bucket_limit)
    return members.join(classes, "__fp").select(
        "doc_id", F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_limit: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are, whatever their names: of each component the smallest doc_id.

    Rows that share it are told apart by a hash of the text; of wholly repeated rows one stays.
    """
    text = F.col(text_col).cast("string")
    key = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("text"))
    members = stage(fingerprints(docs.select(key.alias("__key"), text.alias("__text")).select("__key.*", "__text")), "simhash")
    firsts = _classes(members, F.struct("last", "id", "text"), bucket_limit).select("first.*").distinct()
    own, first = unused(docs, "__own"), unused(docs, "__first")
    firsts = stage(firsts.select(F.concat_ws(":", "text", F.col("id").cast("string")).alias(first)), "firsts")
    # One key, so that repeated rows meet without a second shuffle.
    keyed = docs.withColumn(own, F.concat_ws(":", F.coalesce(F.xxhash64(text), F.lit(0)), F.col(id_col).cast("string")))
    return keyed.join(firsts, F.col(own) == F.col(first)).dropDuplicates([own]).drop(own, first)
