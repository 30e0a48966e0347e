"""Helpers shared by the operators: stage tables, bounded Arrow slices, byte hashing in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gridops.session import scratch_path

#: Base of the position-free byte hash (any odd 64-bit number) and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 64, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh table below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage; a lost executor costs the tasks it ran, not the stages before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes``; a longer text stands alone."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + max_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and the offsets of the texts in it; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray | None = None) -> pa.Array:
    """Arrow binary values ``data[starts[i]:ends[i]]``; ``ends`` defaults to the next start."""
    if ends is None:
        offsets = np.append(starts, len(data)).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    where, offsets = ragged(starts, ends - starts)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[where])])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all runs one after the other, and the offsets of the runs among them."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    where = np.arange(offsets[-1], dtype=np.int64) + np.repeat(starts - offsets[:-1], lengths)
    return where, offsets


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        _powers[base] = np.cumprod(p)
    return _powers[base][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` takes the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(BASE_INVERSE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, wherever it stands."""
    return (sums[ends] - sums[starts]) * powers(BASE, len(sums))[starts]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits may serve as a hash."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
