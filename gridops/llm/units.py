"""Words of a batch of texts, and a bounded store of what each distinct word encodes to."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np

from gridops.llm.common import pieces

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(
    data: np.ndarray, offsets: np.ndarray, cut: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space, and their offsets by text.

    ``cut`` marks bytes before which a run is split.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~SPACE[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    opens[inner] = word[inner]
    closes[inner - 1] = word[inner - 1]
    if cut is not None:
        opens |= cut
        closes[:-1] |= cut[1:]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, list[bytes]]:
    """Number of each span among the distinct spans, and these."""
    coded = pieces(data, starts, ends).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


class UnitStore:
    """Ids of units seen so far, emptied before it holds more than ``limit`` units.

    ``encode`` takes unknown units and gives them back in an order of its choice, with
    their ids one unit after the other and the number of ids of each.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[list[bytes], np.ndarray, np.ndarray]], limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.lengths = array("I"), array("I")

    def numbers(self, units: list[bytes]) -> np.ndarray:
        """Where each unit stands in the store; unknown ones are encoded together first."""
        if len(self.known) + len(units) > self.limit:
            self._clear()
        fresh = [u for u in units if u not in self.known]
        if fresh:
            fresh, ids, lengths = self.encode(fresh)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.ids.frombytes(ids.astype(np.uint32).tobytes())
            self.lengths.frombytes(lengths.astype(np.uint32).tobytes())
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of the units among them (copies: the store may grow later)."""
        offsets = np.zeros(len(self.lengths) + 1, np.int64)
        np.cumsum(np.frombuffer(self.lengths, np.uint32) if len(self.lengths) else [], out=offsets[1:])
        return np.array(self.ids, np.uint32), offsets
