"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm.common import flat_bytes, list_array, mix, prefix_sums, signed, slices, span_hash, stage, unused

#: Five-word masks; either finds every window of 13 words with up to two substitutions (tested by enumeration).
MASKS = ("11010011", "11001011")
#: Words of the window that is compared, and the share of them that must agree.
WINDOW, SIMILARITY = 13, 0.8
#: Items under so many words match only a document that has no other words.
SHORTEST = 5
#: Bits of the filter that test hashes set; its size does not depend on the tables.
FILTER_BITS = 25

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True


#: First and last characters of the scripts that are written without spaces (fixed values): Thai and Lao, Myanmar, Khmer,
#: kana, ideographs and their extensions.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the characters of scripts without spaces in UTF-8 bytes, and the places behind them."""
    lead = np.flatnonzero(data >= 0xE0)
    size = np.where(data[lead] >= 0xF0, 4, 3)
    byte = lambda k: data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F
    three = (data[lead].astype(np.int64) & 0x0F) << 12 | byte(1) << 6 | byte(2)
    four = (data[lead].astype(np.int64) & 0x07) << 18 | byte(1) << 12 | byte(2) << 6 | byte(3)
    point = np.where(size == 4, four, three)
    mine = np.zeros(len(lead), bool)
    for a, b in UNSPACED:
        mine |= (point >= a) & (point <= b)
    return lead[mine], (lead + size)[mine]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and their offsets by text.

    Words are runs of letters, digits, ``_`` and non-ASCII characters of the text in lower case;
    every character of a script that is written without spaces is a word of its own.
    """
    data, offsets = flat_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = _WORD[data]
    alone, behind = _unspaced(data)
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    opens[inner] = word[inner]
    closes[inner - 1] = word[inner - 1]
    for cut in (alone, behind[behind < len(data)]):
        opens[cut] = word[cut]
        before = cut[cut > 0] - 1
        closes[before] = word[before]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return mix(span_hash(prefix_sums(data), starts, ends)), np.searchsorted(starts, offsets)


def seed_hashes(words: np.ndarray, by_text: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a mask fits inside a text, and the hashes of the words it shows there."""
    span = len(mask)
    if len(words) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(by_text) - 1), np.diff(by_text))
    at = np.flatnonzero(text[: len(text) - span + 1] == text[span - 1 :])
    h = np.full(len(at), int.from_bytes(mask.encode()[-7:], "big") * 257 + span, np.uint64)
    for offset, shown in enumerate(mask):
        if shown == "1":
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[at + offset]
    return at, mix(h)


def whole_hash(words: np.ndarray) -> int:
    """Hash of a text's words that no seed of a mask shares."""
    h = np.full(1, 0xC2B2AE3D27D4EB4F + len(words), np.uint64)
    for w in words:
        h = h * np.uint64(0x9E3779B97F4A7C15) + w
    return int(mix(h)[0])


def short_blocks(n: int) -> list[tuple[int, int]]:
    """Start and length of the blocks of an item of ``SHORTEST`` to ``WINDOW - 1`` words, one more than words that may differ.

    So one of them stands unchanged wherever the item does.
    """
    blocks = n - math.ceil(SIMILARITY * n - 1e-9) + 1
    cuts = [n * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _benchmark_items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item, key, words`` (hashes) of every item with a word; ``key`` tells items apart that share an id or have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, by_text = word_hashes(batch["text"])
            yield pa.record_batch([batch["item"], batch["key"], list_array(signed(words), by_text, pa.int64())], ["item", "key", "words"])

    text = F.col(text_col).cast("string")
    rows = benchmark.select(F.col(item_col).alias("item"), F.xxhash64(F.col(item_col), text).alias("key"), text.alias("text"))
    kind = rows.schema["item"].dataType.simpleString()
    return rows.mapInArrow(run, f"item {kind}, key bigint, words array<bigint>").where(F.size("words") > 0).dropDuplicates(["key"])


def _item_seeds(items: DataFrame) -> DataFrame:
    """``hash, item, at`` (``item`` is the key): masked hashes of long items, those of the blocks of short ones, of very short ones the whole."""

    def seeds(own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(own) < SHORTEST:
            yield np.zeros(1, np.int64), np.array([whole_hash(own)], np.uint64)
            return
        if len(own) >= WINDOW:
            for mask in MASKS:
                yield seed_hashes(own, np.array([0, len(own)]), mask)
            return
        for start, length in short_blocks(len(own)):
            at, h = seed_hashes(own[start : start + length], np.array([0, length]), "1" * length)
            yield at + start, h

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, words in zip(batch["key"].to_pylist(), batch["words"], strict=True):
                for at, h in seeds(np.array(words.as_py(), np.int64).view(np.uint64)):
                    yield pa.record_batch([pa.array(signed(h)), pa.array([key] * len(at), pa.int64()), pa.array(at, pa.int32())], ["hash", "item", "at"])

    return items.mapInArrow(run, "hash bigint, item bigint, at int")


def _probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each hash."""
    return (h >> np.uint64(64 - FILTER_BITS)).view(np.int64), (h & np.uint64((1 << FILTER_BITS) - 1)).view(np.int64)


def _filter(seeds: DataFrame) -> np.ndarray:
    """The filter as one truth value per bit: 2**25 bits whatever the tables hold."""
    top = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    bit = F.explode(F.array(top, F.col("hash").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)))).alias("bit")
    words = seeds.select(bit).groupBy(F.shiftright("bit", 5).alias("word"))
    rows = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").bitwiseAND(F.lit(31)).cast("int"))).alias("bits"))
    table = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    found = rows.toArrow()  # at most 2**20 pairs of numbers
    table[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return table


def _inside(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (table[bits >> 5] >> (bits & 31).astype(np.uint32) & np.uint32(1)).astype(bool)


def _hits(docs: DataFrame, table: np.ndarray, short: list[int]) -> DataFrame:
    """``doc_id, text_key, segment, first, words, ats, hashes``: where seeds of a document pass the filter.

    A segment has the hits that stand within a window of each other (cut after 2,048
    words) and the word hashes around them, enough to judge every window with a hit. ``short``
    has the lengths of the blocks of short items. A text of few words has one hit more, of all of them.
    """
    masks = [*MASKS, *("1" * n for n in short)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, by_text = word_hashes(batch["text"])
            found = []
            for mask in masks:
                at, h = seed_hashes(words, by_text, mask)
                one, two = _probes(h)
                ok = np.flatnonzero(_inside(table, one))
                ok = ok[_inside(table, two[ok])]
                found.append((at[ok], h[ok]))
            few = np.flatnonzero((np.diff(by_text) > 0) & (np.diff(by_text) < SHORTEST))
            whole = np.array([whole_hash(words[by_text[i] : by_text[i + 1]]) for i in few.tolist()], np.uint64)
            ok = _inside(table, _probes(whole)[0]) & _inside(table, _probes(whole)[1])
            found.append((by_text[few[ok]], whole[ok]))
            at, h = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            text = np.searchsorted(by_text, at, "right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (text[1:] != text[:-1]) | (np.diff(at) > WINDOW) | (at[1:] // 2048 != at[:-1] // 2048)
            opens = np.flatnonzero(new)
            closes = np.append(opens[1:], len(at))
            own = text[opens]
            first = np.maximum(at[opens] - WINDOW, by_text[own])
            last = np.minimum(at[closes - 1] + 2 * WINDOW, by_text[own + 1])
            where = np.concatenate([np.arange(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True)])
            inside = at - np.repeat(first, closes - opens)
            columns = {
                "doc_id": batch["doc_id"].take(pa.array(own)),
                "text_key": batch["text_key"].take(pa.array(own)),
                "first": pa.array(first - by_text[own], pa.int64()),
                "words": list_array(signed(words[where]), np.concatenate(([0], np.cumsum(last - first))), pa.int64()),
                "ats": list_array(inside, np.append(opens, len(at)), pa.int32()),
                "hashes": list_array(signed(h), np.append(opens, len(at)), pa.int64()),
            }
            yield pa.record_batch(list(columns.values()), list(columns))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text_key bigint, first bigint, words array<bigint>, ats array<int>, hashes array<bigint>")


def best_window(doc: np.ndarray, item: np.ndarray, shift: int) -> float:
    """Largest share of agreeing words over the windows of ``item`` laid on ``doc`` from ``shift`` on."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    size = min(WINDOW, len(item))
    if high - low < size:
        return 0.0
    same = np.concatenate(([0], np.cumsum(doc[low + shift : high + shift] == item[low:high])))
    share = float((same[size:] - same[:-size]).max()) / size
    # An item of few words, whose seed is of whole texts only, must be all of the text.
    return share if len(item) >= SHORTEST or (share == 1.0 and len(doc) == len(item)) else 0.0


def _judged(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, items = batch["words"], batch["item_words"]
            shares = [
                best_window(docs[i].values.to_numpy(), items[i].values.to_numpy(), shift)
                for i, shift in enumerate(batch["shift"].to_pylist())
            ]
            keep = pa.array(np.array(shares) >= SIMILARITY)
            columns = [batch["doc_id"], batch["text_key"], batch["item"], pa.array(shares, pa.float64())]
            yield pa.record_batch(columns, ["doc_id", "text_key", "item", "share"]).filter(keep)

    return pairs.mapInArrow(run, f"doc_id {pairs.schema['doc_id'].dataType.simpleString()}, text_key bigint, item bigint, share double")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``doc_id, text_key, items, n_items, share`` of the documents that overlap a benchmark item.

    A document overlaps an item if 13 words in a row of one stand in the other with at least 0.8 of them
    equal (up to two substituted), wherever that is. Items of 5 to 12 words must stand in it from end to end, with the
    same share; items of under five words say too little and must be all of its words. ``items`` are
    the item ids in order (none for items without one), ``n_items`` counts all distinct items,
    ``share`` is the best agreement. ``text_key`` is a hash of the text, so that rows sharing a doc_id
    are told apart. Null texts and items have no words and overlap nothing.
    """
    items = stage(_benchmark_items(benchmark, item_col, item_text_col), "items")
    seeds = stage(_item_seeds(items), "seeds")
    sizes = [r[0] for r in items.select(F.size("words")).where(F.size("words").between(SHORTEST, WINDOW - 1)).distinct().collect()]  # 5 to 12
    short = sorted({length for n in sizes for _, length in short_blocks(n)})
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    hits = stage(_hits(rows, _filter(seeds), short), "hits")
    each = hits.select("doc_id", "text_key", "first", F.explode(F.arrays_zip("ats", "hashes")).alias("hit"))
    each = each.select("doc_id", "text_key", "first", F.col("hit.ats").alias("pos"), F.col("hit.hashes").alias("hash"))
    met = each.join(seeds, "hash").select("doc_id", "text_key", "first", "item", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    own = hits.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("first").alias("f"), "words")
    own = own.dropDuplicates(["d", "t", "f"])  # repeated rows
    pairs = met.join(own, met["doc_id"].eqNullSafe(own["d"]) & (met["text_key"] == own["t"]) & (met["first"] == own["f"]))
    told = pairs.join(items.select(F.col("key").alias("item"), F.col("words").alias("item_words")), "item")
    judged = _judged(told.select("doc_id", "text_key", "item", "shift", "words", "item_words"))
    best = judged.groupBy("doc_id", "text_key", "item").agg(F.max("share").alias("share"))
    named = best.join(items.select(F.col("key").alias("item"), F.col("item").alias("name")), "item")
    return named.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set("name")).alias("items"), F.count("*").cast("int").alias("n_items"), F.max("share").alias("share")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names: str) -> DataFrame:
    """``doc_id, contaminated, n_items, items, share`` of every document (see ``contaminated``).

    Clean documents have no items and share 0. Repeated rows each get a row; other
    columns are ignored; an empty benchmark leaves all clean.
    """
    found = contaminated(docs, benchmark, id_col, text_col, **names)
    found = found.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "items", "n_items", "share")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"))
    marked = rows.join(found, rows["doc_id"].eqNullSafe(found["d"]) & (rows["text_key"] == found["t"]), "left")
    return marked.select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", F.array().cast(found.schema["items"].dataType)).alias("items"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names: str) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, all columns as they are, whatever their names."""
    found = contaminated(docs, benchmark, id_col, text_col, **names)
    key, doc, text = unused(docs, "__key"), unused(docs, "__doc"), unused(docs, "__text")
    found = found.select(F.col("doc_id").alias(doc), F.col("text_key").alias(text))
    own = docs.withColumn(key, F.xxhash64(F.col(text_col).cast("string")))
    return own.join(found, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(key) == F.col(text)), "left_anti").drop(key)
