"""Token ids in directly addressable codes: tokenise, write block files, read them back."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridops.llm.common import flat_bytes, ragged, slices, stage
from gridops.llm.units import SPACE, UnitStore, distinct, word_spans

#: First bytes of a block.
MAGIC = b"DAC1"


def pack_block(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One block: the documents' ids and lengths, then their token ids level by level.

    A level holds the next 8 bits of every id that reaches it, one bit per id that
    says whether it goes on, and the number of such bits before each 64-bit word of
    them (the rank directory), which is where an id goes on in the next level.
    """
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        chunk, rest = (rest & 255).astype(np.uint8), rest >> 8
        on = rest > 0
        bits = np.zeros(-(-len(on) // 64) * 8, np.uint8)
        packed = np.packbits(on, bitorder="little")
        bits[: len(packed)] = packed
        ranks = np.zeros(len(bits) // 8, np.uint32)
        np.cumsum(np.bitwise_count(bits.view(np.uint64))[:-1], out=ranks[1:])
        rest = rest[on]
        last = not len(rest)
        levels.append(struct.pack("<I?", len(chunk), last) + chunk.tobytes() + (b"" if last else bits.tobytes() + ranks.tobytes()))
    head = MAGIC + struct.pack("<IQB", len(doc_ids), len(ids), len(levels))
    return head + doc_ids.astype("<i8").tobytes() + lengths.astype("<u4").tobytes() + b"".join(levels)


class Block:
    """A block as written; any token is reached by its number without decoding others."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        n_docs, self.n_tokens, n_levels = struct.unpack_from("<IQB", payload, 4)
        at = 17

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.lengths, self.levels = take("<i8", n_docs), take("<u4", n_docs), []
        for _ in range(n_levels):
            n, last = struct.unpack_from("<I?", payload, at)
            at += 5
            words = 0 if last else -(-n // 64)
            self.levels.append((take("u1", n), take("<u8", words), take("<u4", words)))

    def get(self, positions: np.ndarray) -> np.ndarray:
        """Token ids at these positions, in any order."""
        at = np.asarray(positions, np.int64)
        out, who, shift = np.zeros(len(at), np.uint32), np.arange(len(at)), 0
        for chunk, bits, ranks in self.levels:
            out[who] |= chunk[at].astype(np.uint32) << np.uint32(shift)
            if not len(bits):
                break
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            on = (bits[word] >> bit & np.uint64(1)).astype(bool)
            word, bit, who = word[on], bit[on], who[on]
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            at = ranks[word].astype(np.int64) + np.bitwise_count(below)
            shift += 8
        return out


@lru_cache(maxsize=2)
def _specials(path: str) -> re.Pattern[bytes]:
    """The strings that the tokenizer, as loaded, takes for one token wherever they stand in a text."""
    found = Tokenizer.from_file(path).get_added_tokens_decoder().values()
    if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in found):
        raise ValueError("only special tokens that are matched as they are written can be cut out")
    return re.compile(b"|".join(re.escape(t.content.encode()) for t in found) or b"(?!)")


@lru_cache(maxsize=2)
def _store(path: str, specials: bool) -> UnitStore:
    """Ids by word. White space never gets into a token of this tokenizer, so words encode alone."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not specials  # if set, their strings in a text are ordinary text

    def encode(words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch([w.decode() for w in words], add_special_tokens=False)]
        return words, np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.uint32, len(found))

    return UnitStore(encode, limit=1_000_000)  # about 200 bytes each


_LETTER, _MARK, _LOWER = np.zeros(256, bool), np.zeros(256, bool), np.arange(256, dtype=np.uint8)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = True  # not the apostrophe: 's is one token
_LOWER[65:91] += 32


def _folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewer distinct words of the same tokens: A-Z in lower case, as the tokenizer does itself
    (unless a combining character may follow), and cut where a letter meets an ASCII mark."""
    if not len(data):
        return data, offsets, np.zeros(0, bool)
    plain = np.ones(len(data), bool)
    plain[:-1] = data[1:] < 128
    folded, cut = np.where(plain, _LOWER[data], data), np.zeros(len(data), bool)
    letter, mark = _LETTER[data], _MARK[data]
    cut[1:] = letter[:-1] & mark[1:] | mark[:-1] & letter[1:]
    return folded, offsets, cut


def token_ids(path: str, texts: pa.Array, end_id: int, specials: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, the end id after each, and the offsets of the texts among them.

    With ``specials`` the strings of the tokenizer's special tokens are those tokens, else ordinary text.
    """
    raw, offsets = flat_bytes(texts)
    data, offsets, cut = _folded(raw, offsets)
    for m in _specials(path).finditer(raw) if specials else ():
        inside = np.searchsorted(offsets, [m.start(), m.end() - 1], "right")
        if inside[0] == inside[1]:  # not put together from two texts
            cut[m.start() : m.end()] = False
            for at in (m.start(), m.end()):  # a cut is between two bytes of words
                if 0 < at < len(cut):
                    cut[at] = not SPACE[raw[at - 1]] and not SPACE[raw[at]]
    starts, ends, by_text = word_spans(data, offsets, cut)
    which, words = distinct(data, starts, ends)
    store = _store(path, specials)
    at = store.numbers(words)[which] if len(which) else which
    ids, bounds = store.tables()
    where, spans = ragged(bounds[at], bounds[at + 1] - bounds[at])
    cuts = spans[by_text]
    lengths = np.diff(cuts) + 1
    out_offsets = np.concatenate(([0], np.cumsum(lengths)))
    out = np.full(out_offsets[-1], end_id, np.uint32)
    body = np.ones(len(out), bool)
    body[out_offsets[1:] - 1] = False
    out[body] = ids[where]
    return out, out_offsets


def write_token_blocks(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    block_tokens: int = 1 << 18,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the token ids of all documents in ascending doc_id order; returns the written blocks.

    Columns ``part, block, n_docs, n_tokens, payload``; (part, block) is the order. The
    blocks are a Parquet table below ``spark.checkpoint.dir``, because executors can
    write to a shared store only through Spark. Documents are range-partitioned by
    doc_id and a hash of the text, so that even one doc_id on many rows is dealt out;
    a task holds one block at a time. A block ends after ``block_tokens`` ids (a longer
    document is whole in its block). A null text has no token but the end id; a null
    doc_id sorts first and reads back as null; equal doc_ids sort by text. Strings of
    special tokens in a text become those tokens, as the library does by default.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            ids, lengths = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            names = np.concatenate([h[0] for h in held])
            columns = [[part], [block], [len(names)], [len(ids)], [pack_block(names, lengths, ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            fields = ["part", "block", "n_docs", "n_tokens", "payload"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], fields)

        for batch in slices(batches, "text", 2 << 20):
            ids, offsets = token_ids(tokenizer_path, batch["text"], end_id, specials=True)
            names = batch["doc_id"].fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            held.append((names, ids, np.diff(offsets)))
            size += len(ids)
            if size >= block_tokens:
                yield flush()
                block, held, size = block + 1, [], 0
        if held:
            yield flush()

    schema = "part int, block int, n_docs bigint, n_tokens bigint, payload binary"
    return stage(dealt.mapInArrow(write, schema), "tokens")


#: How a null doc_id is written.
NULL_ID = -(1 << 63)


def read_token_blocks(blocks: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``; see ``read_token_ids`` for the ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, payload in zip(batch["part"].to_pylist(), batch["block"].to_pylist(), batch["payload"], strict=True):
                block = Block(payload.as_py())
                ids = np.concatenate([block.get(np.arange(i, min(i + 65536, block.n_tokens))) for i in range(0, block.n_tokens, 65536)])
                ends = np.cumsum(block.lengths, dtype=np.int64)
                view = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), block.lengths.tolist(), strict=True)]
                n = len(ends)
                columns = {
                    "part": pa.array(np.full(n, part), pa.int32()),
                    "block": pa.array(np.full(n, number), pa.int32()),
                    "doc_id": pa.array(block.doc_ids, pa.int64(), mask=block.doc_ids == NULL_ID),
                    "inside": pa.array(ends - block.lengths, pa.int64()),
                    "n_tokens": pa.array(block.lengths, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                yield pa.record_batch(list(columns.values()), list(columns))

    rows = blocks.select("part", "block", "payload").mapInArrow(
        read, "part int, block int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return rows.join(block_starts(blocks), ["part", "block"]).select(
        "doc_id", (F.col("first_token") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def block_starts(blocks: DataFrame) -> DataFrame:
    """``part, block, first_token``: ids before each block; sums per part, then over the parts."""
    sizes = blocks.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row per part, as many as shuffle partitions.
    before = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    return sizes.withColumn("inside", inside).join(before, "part").select("part", "block", (F.col("before") + F.col("inside")).alias("first_token"))
