"""SentencePiece encoding and decoding by a batched Viterbi search in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from gridops.llm.common import BASE, flat_bytes, list_array, powers, ragged, slices
from gridops.llm.units import UnitStore, distinct

#: The mark that stands for a space in a piece.
MARK = "▁"
#: Base of the hash of substrings, over code points.
CHAR_BASE = 0xD1342543DE82EF95
NONE, START = -2, -1
NEVER = 1 << 40


@dataclass
class PieceTable:
    """What the search needs of a model: sorted piece keys, merge ranks and last merges."""

    keys: np.ndarray  # sorted hashes of the pieces that can end up in a result
    ids: np.ndarray  # their ids
    merge_keys: np.ndarray  # sorted hashes of all mergeable pieces
    merge_ids: np.ndarray
    hashes: np.ndarray  # by id: hash over code points, not yet mixed
    lengths: np.ndarray  # by id, in characters
    rank: np.ndarray  # by id: order of merging, -1 for single characters
    left: np.ndarray  # by id: the two pieces merged last
    right: np.ndarray
    longest: int
    byte_ids: np.ndarray  # ids of the 256 bytes
    runs: list[list[int]]  # ids of 0, 1, .. spaces up to the longest piece of spaces
    texts: np.ndarray  # bytes that each id decodes to
    text_offsets: np.ndarray


def _char_hash(points: np.ndarray) -> np.ndarray:
    """Hash of each row of code points, as the prefix sums of the search give it."""
    h = np.zeros(len(points), np.uint64)
    for column in points.T:
        h = h * np.uint64(CHAR_BASE) + column.astype(np.uint64) + np.uint64(1)
    return h


def _key(h: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return (h + lengths.astype(np.uint64) * np.uint64(BASE)) * np.uint64(0xD6E8FEB86659FD93)


def _merge(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Byte-pair merging of a short symbol list: lowest rank first, leftmost on ties; and the last merge."""
    last = None
    while True:
        found = [(rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in rank]
        if not found:
            return symbols, last
        i = min(found)[1]
        last = (symbols[i], symbols[i + 1])
        symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]


@lru_cache(maxsize=2)
def piece_table(model_path: str) -> PieceTable:
    """Read a byte-pair model with byte fallback (built once, on the driver)."""
    model = SentencePieceProcessor(model_file=model_path)
    n = model.vocab_size()
    names = [model.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    if not all(map(model.is_byte, byte_ids.tolist())):
        raise ValueError("a model with byte fallback is needed")
    spaces = {names[i]: i for i in normal if set(names[i]) == {MARK}}
    words = [i for i in normal if MARK not in names[i][1:]]
    if len(words) + len([s for s in spaces if len(s) > 1]) != len(normal):
        raise ValueError("pieces that span words are not supported")
    order = {i: r for r, i in enumerate(sorted((i for i in words if len(names[i]) > 1), key=lambda i: -model.get_score(i)))}
    ranks = {names[i]: r for i, r in order.items()}
    number = {names[i]: i for i in words}

    rank, left, right = (np.full(n + 1, -1, np.int64) for _ in range(3))
    reachable = [i for i in words if len(names[i]) == 1]
    for i, r in order.items():
        rank[i] = r
        result, last = _merge(list(names[i]), ranks)
        if len(result) == 1 and all(x in number for x in last):
            left[i], right[i] = (number[x] for x in last)
            reachable.append(i)
    lengths, hashes = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.uint64)
    for i in words:
        points = np.frombuffer(names[i].encode("utf-32-le"), np.uint32)
        lengths[i], hashes[i] = len(points), _char_hash(points[None])[0]
    all_words, usable = np.array(words), np.array(reachable)

    def index(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = _key(hashes[ids], lengths[ids])
        at = np.argsort(keys)
        if (np.diff(keys[at].astype(object)) == 0).any():
            raise ValueError("two pieces share a key")
        return keys[at], ids[at]

    longest_run = max(map(len, spaces))
    in_runs = {s: 0 for s in spaces if len(s) > 1}  # all of one rank: leftmost first
    runs = [[spaces[s] for s in _merge([MARK] * k, in_runs)[0]] for k in range(longest_run + 1)]
    texts = []
    for i, name in enumerate(names):
        byte = bytes([int(name[3:5], 16)]) if model.is_byte(i) else b""
        texts.append(byte or (" ⁇ ".encode() if model.is_unknown(i) else b"" if model.is_control(i) else name.replace(MARK, " ").encode()))
    return PieceTable(
        *index(usable),
        *index(all_words),
        hashes, lengths, rank, left, right,
        int(lengths.max()),
        byte_ids,
        runs,
        np.frombuffer(b"".join(texts), np.uint8),
        np.concatenate(([0], np.cumsum([len(t) for t in texts]))),
    )


class SortedKeys:
    """Ids by key: most keys that are not there fail on a table of their first 20 bits, the rest is searched."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray):
        self.keys, self.ids = keys, ids
        self.first = np.zeros(1 << 20, bool)
        self.first[keys >> np.uint64(44)] = True

    def probe(self, wanted: np.ndarray) -> np.ndarray:
        """The ids, -1 where there is none."""
        out = np.full(wanted.shape, -1, np.int64)
        maybe = np.nonzero(self.first[(wanted >> np.uint64(44)).view(np.int64)])
        some = wanted[maybe]
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == some, self.ids[at], -1)
        return out


class Viterbi:
    """Finds, for many words at once, the segmentation that byte-pair merging ends in.

    Merging ends in the one path whose neighbours all stay apart when merged on their
    own. So a path scores 1 while all its neighbours do, else 0, and the search keeps,
    at every position of every word of equal length, the piece of the maximal score
    and with it the pointer back.
    """

    #: Slots for pairs of pieces already judged; a pair that is not there is judged again.
    SLOTS = 21

    def __init__(self, table: PieceTable):
        self.t = table
        self.unknown = len(table.rank) - 1  # stands for any character without a piece
        self.usable, self.mergeable = SortedKeys(table.keys, table.ids), SortedKeys(table.merge_keys, table.merge_ids)
        self.pairs, self.apart = np.full(1 << self.SLOTS, -1, np.int64), np.zeros(1 << self.SLOTS, bool)

    def encode(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words by length, the ids of one after the other, and how many each has."""
        texts = [w.decode().replace(" ", MARK) for w in words]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(sizes, kind="stable")
        sizes = sizes[order]
        parts = []
        start = 0
        while start < len(order):
            length = int(sizes[start])
            end = min(int(np.searchsorted(sizes, length, "right")), start + max(1, 65_536 // max(length, 1)))
            if length:
                group = "".join([texts[i] for i in order[start:end].tolist()])
                parts.append(self._group(np.frombuffer(group.encode("utf-32-le"), np.uint32).reshape(-1, length)))
            else:
                parts.append((np.zeros(0, np.int64), np.zeros(end - start, np.int64)))
            start = end
        return [words[i] for i in order.tolist()], np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _group(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t, (n, length) = self.t, points.shape
        sums = np.zeros((n, length + 1), np.uint64)
        for j in range(length):
            sums[:, j + 1] = sums[:, j] * np.uint64(CHAR_BASE) + points[:, j].astype(np.uint64) + np.uint64(1)
        scale = powers(CHAR_BASE, t.longest + 1)
        last = np.full((n, length + 1), NONE, np.int64)
        last[:, 0] = START
        back = np.zeros((n, length + 1), np.int32)
        for j in range(1, length + 1):
            sizes = np.arange(1, min(j, t.longest) + 1)
            spans = sums[:, j, None] - sums[:, j - sizes] * scale[sizes]
            piece = self.usable.probe(_key(spans, sizes))
            piece[:, 0] = np.where(piece[:, 0] < 0, self.unknown, piece[:, 0])
            before = last[:, j - sizes]
            score = (piece >= 0) & (before != NONE)
            score[score] = self._stay_apart(before[score], piece[score])
            best = score.argmax(axis=1)
            rows = np.arange(n)
            found = score[rows, best]  # inside a longer piece no path may end
            last[:, j] = np.where(found, piece[rows, best], NONE)
            back[:, j] = sizes[best]
        if (last[:, length] == NONE).any():
            raise AssertionError("a word has no segmentation")
        return self._trace(points, last, back)

    def _trace(self, points: np.ndarray, last: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, length = points.shape
        rows, at = np.arange(n), np.full(n, length)
        steps, places = [], []
        while (at > 0).any():
            steps.append(np.where(at > 0, last[rows, at], NONE))
            at = at - np.where(at > 0, back[rows, at], 0)
            places.append(at)
        ids, places = np.array(steps[::-1]).T, np.array(places[::-1]).T
        real = ids != NONE
        lengths, flat = real.sum(axis=1), ids[real]
        odd = np.flatnonzero(flat == self.unknown)
        if not len(odd):
            return flat, lengths
        # Characters without a piece become their bytes.
        row = np.repeat(rows, lengths)
        utf8 = [chr(p).encode() for p in points[row[odd], places[real][odd]].tolist()]
        width = np.ones(len(flat), np.int64)
        width[odd] = [len(u) for u in utf8]
        out = np.repeat(flat, width)
        out[out == self.unknown] = self.t.byte_ids[np.frombuffer(b"".join(utf8), np.uint8)]
        return out, np.bincount(row, width, n).astype(np.int64)

    def _stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging a and b on their own leaves them as they are."""
        free = (a == START) | (a == self.unknown) | (b == self.unknown)
        code = a * (self.unknown + 1) + b
        slot = ((code.astype(np.uint64) * np.uint64(BASE)) >> np.uint64(64 - self.SLOTS)).view(np.int64)
        missing = ~free & (self.pairs[slot] != code)
        new = np.unique(code[missing])
        if not len(new):
            return free | self.apart[slot]
        apart = self._unmerge(new // (self.unknown + 1), new % (self.unknown + 1))
        out = free | self.apart[slot]
        out[missing] = apart[np.searchsorted(new, code[missing])]
        at = ((new.astype(np.uint64) * np.uint64(BASE)) >> np.uint64(64 - self.SLOTS)).view(np.int64)
        at, first = np.unique(at, return_index=True)
        self.pairs[at], self.apart[at] = new[first], apart[first]
        return out

    def _unmerge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Walk the merges of both sides back in time; a merge across, if due before either side's next, joins them."""
        t = self.t
        scale = powers(CHAR_BASE, t.longest + 1)
        apart, live = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.copy(), b.copy()
        next_a, next_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(live):
            x, y = a[live], b[live]
            size = t.lengths[x] + t.lengths[y]
            fits = size <= t.longest
            across = np.full(len(live), -1)
            both = t.hashes[x[fits]] * scale[t.lengths[y[fits]]] + t.hashes[y[fits]]
            across[fits] = self.mergeable.probe(_key(both, size[fits]))
            due = t.rank[across]
            joined = (across >= 0) & (due < next_a[live]) & (due <= next_b[live])
            apart[live[joined]] = False
            whole = (t.rank[x] < 0) & (t.rank[y] < 0)
            live = live[~joined & ~whole]
            x, y = a[live], b[live]
            from_a = t.rank[x] > t.rank[y]
            u, v = live[from_a], live[~from_a]
            next_a[u], a[u] = t.rank[a[u]], t.right[a[u]]
            next_b[v], b[v] = t.rank[b[v]], t.left[b[v]]
        return apart


class Encoder:
    """Encodes batches of texts, units at a time; lives in one Python worker."""

    def __init__(self, table: PieceTable):
        self.t = table
        self.store = UnitStore(Viterbi(table).encode)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the offsets of the texts among them."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
        # Every text that is not empty starts with a space of its own.
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise("", texts, " "))
        data, offsets = flat_bytes(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        # A unit is a space with the word after it, or a line end, which never merges.
        cut = (data == 32) | (data == 10)
        cut[1:] |= data[:-1] == 10
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        which, units = distinct(data, starts)
        numbers = self.store.numbers(units)[which]
        ids, bounds = self.store.tables()
        numbers, ids, bounds = self._space_runs(numbers, ids, bounds, starts, offsets)
        where, spans = ragged(bounds[numbers], bounds[numbers + 1] - bounds[numbers])
        return ids[where], spans[np.searchsorted(starts, offsets)]

    def _space_runs(self, numbers, ids, bounds, starts, offsets):
        """Spaces merge with each other after all words have merged: give runs of them their own ids."""
        lone = self.store.known.get(b" ")
        if lone is None:
            return numbers, ids, bounds
        alone = numbers == lone
        new_text = np.isin(starts, offsets[:-1])
        mark = self.t.runs[1][0]
        opens = bounds[numbers]
        # A space whose word did not take it in joins the run before it.
        joins = ~alone & (ids[np.minimum(opens, len(ids) - 1)] == mark) & ~new_text
        first = np.flatnonzero(alone & ~(np.concatenate(([False], alone[:-1])) & ~new_text))
        if not len(first):
            return numbers, ids, bounds
        stops = np.flatnonzero(~alone | new_text)
        more_ids, more_ends, numbers = [ids], [bounds], numbers.copy()
        seen: dict[tuple[str, int], int] = {}
        end, count = int(bounds[-1]), len(bounds) - 1

        def add(kind: tuple[str, int], values: np.ndarray) -> int:
            nonlocal end, count
            if kind not in seen:
                seen[kind], end, count = count, end + len(values), count + 1
                more_ids.append(values.astype(np.uint32))
                more_ends.append(np.array([end]))
            return seen[kind]

        after = np.searchsorted(stops, first, "right")
        for i, k in zip(first.tolist(), after.tolist(), strict=True):
            stop = int(stops[k]) if k < len(stops) else len(numbers)
            taken = stop < len(numbers) and bool(joins[stop])
            run = stop - i + taken
            if run < 2:
                continue
            numbers[i + 1 : stop] = add(("none", 0), np.zeros(0))
            full, rest = divmod(run, len(self.t.runs) - 1)
            numbers[i] = add(("run", run), np.array(self.t.runs[-1] * full + self.t.runs[rest]))
            if taken:
                word = int(numbers[stop])
                numbers[stop] = add(("rest", word), ids[bounds[word] + 1 : bounds[word + 1]])
        return numbers, np.concatenate(more_ids), np.concatenate(more_ends)


def decode_ids(table: PieceTable, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of id lists; the first space of a text is dropped, broken UTF-8 is replaced."""
    lengths = np.diff(table.text_offsets)[ids]
    where, spans = ragged(table.text_offsets[ids], lengths)
    data, cuts = table.texts[where], spans[offsets]
    begins, ends = cuts[:-1].copy(), cuts[1:]
    some = begins < ends
    begins[some] += data[begins[some]] == 32
    where, bounds = ragged(begins, ends - begins)
    raw = pa.Array.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[where])]
    )
    try:
        return raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode(errors="replace") for x in raw.to_pylist()], pa.string())


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, n_tokens, round_trip`` of every document.

    ``ids`` are those of the model's own library. ``round_trip`` says whether they
    decode to the text again, which only fails where the text holds the mark U+2581
    itself (it decodes to a space). A null or empty text has no ids. Rows keep their
    partitions, nothing is shuffled; other columns are ignored.
    """
    table = piece_table(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(table)
        for batch in slices(batches, "text", 2 << 20):
            ids, offsets = encoder.encode(batch["text"])
            back = pc.equal(decode_ids(table, ids, offsets), pc.fill_null(batch["text"], ""))
            columns = [batch["doc_id"], list_array(ids.astype(np.int32), offsets, pa.int32()), pa.array(np.diff(offsets), pa.int64()), back]
            yield pa.record_batch(columns, ["doc_id", "ids", "n_tokens", "round_trip"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens bigint, round_trip boolean")


def decode_tokens(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of every list of ids; a null list is an empty text."""
    table = piece_table(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = decode_ids(table, ids, np.concatenate(([0], np.cumsum(lengths))))
            yield pa.record_batch([batch["doc_id"], texts], ["doc_id", "text"])

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
