"""Words of many texts at once: numpy passes over the bytes of an Arrow column, no loop over words.

A word is a run of bytes other than the ASCII white space 0x20 and 0x09-0x0D; A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at a time; arrays of a dozen bytes for each exist meanwhile.
PIECE = 1 << 21

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64


class WordHasher:
    """64-bit hashes of words.

    The hash of a word is a polynomial in a fixed odd base over random numbers that stand for its
    bytes, so it is the difference of two running sums.  The same seed gives the same hashes
    in every task.
    """

    def __init__(self, seed: int = 7):
        numbers = np.random.default_rng(seed).integers(0, 2 ** 64, 256, dtype=np.uint64)
        numbers[ord("A"):ord("Z") + 1] = numbers[ord("a"):ord("z") + 1]
        self.numbers = numbers
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self._powers(1 << 12)

    def _powers(self, length: int) -> None:
        self.up = np.cumprod(np.full(length + 1, _BASE, np.uint64))
        self.up = np.concatenate([np.ones(1, np.uint64), self.up[:-1]])
        inverse = np.full(length + 1, pow(_BASE, -1, 2 ** 64), np.uint64)
        self.down = np.concatenate([np.ones(1, np.uint64), np.cumprod(inverse)[:-1]])

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(hash, text number, first byte, end) of the words, in order, a piece of the bytes at a time.

        A piece ends at white space or at the end of a text, so no word is ever cut.
        """
        low, end = int(offsets[0]), int(offsets[-1])
        while low < end:
            high = self._cut(data, offsets, low, end)
            yield self._piece(data, offsets, low, high)
            low = high

    def _cut(self, data: np.ndarray, offsets: np.ndarray, low: int, end: int) -> int:
        high = low + PIECE
        while high < end:
            border = int(offsets[np.searchsorted(offsets, high, side="left")])
            spaces = np.flatnonzero(self.space[data[high:min(high + PIECE, border)]])
            if len(spaces):
                return high + int(spaces[0])
            if border <= high + PIECE:
                return border
            high += PIECE
        return end

    def _piece(self, data, offsets, low, high):
        part = data[low:high]
        if len(part) > len(self.up) - 1:
            self._powers(len(part))
        solid = ~self.space[part]
        first = np.empty(len(part), bool)
        first[0] = True
        first[1:] = ~solid[:-1]
        borders = offsets[np.searchsorted(offsets, low):np.searchsorted(offsets, high)] - low
        first[borders] = True
        starts = np.flatnonzero(first & solid)
        last = np.empty(len(part), bool)
        last[-1] = True
        last[:-1] = first[1:] | ~solid[1:]
        ends = np.flatnonzero(last & solid) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(self.numbers[part] * self.up[:len(part)], out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * self.down[starts])
        owner = np.searchsorted(offsets, starts + low, side="right") - 1
        return hashes, owner, starts + low, ends + low

    def all_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        pieces = list(self.words(data, offsets))
        if not pieces:
            empty = np.empty(0, np.int64)
            return np.empty(0, np.uint64), empty, empty, empty
        return tuple(map(np.concatenate, zip(*pieces)))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def joined(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """One number for each run of `length` hashes that begins at `starts`."""
    out = np.full(len(starts), length, np.uint64)
    for i in range(length):
        out = mixed(out ^ hashes[starts + i]) + np.uint64(_BASE)
    return out


def ngrams(hashes: np.ndarray, owner: np.ndarray, length: int,
           whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, text number, index of the first word) of each run of `length` words of a text.

    With `whole_if_short`, the words of a text that has fewer make one run.
    """
    found = []
    if len(hashes) >= length:
        starts = np.flatnonzero(owner[: len(owner) - length + 1] == owner[length - 1:])
        found.append((joined(hashes, starts, length), owner[starts], starts))
    if whole_if_short and len(hashes):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[first, len(owner)])
        for n in range(1, length):
            starts = first[sizes == n]
            if len(starts):
                found.append((joined(hashes, starts, n), owner[starts], starts))
    if not found:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty
    numbers, owners, starts = map(np.concatenate, zip(*found))
    if len(found) > 1:
        order = np.argsort(starts, kind="stable")
        numbers, owners, starts = numbers[order], owners[order], starts[order]
    return numbers, owners, starts


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (or those of a binary one) and where each text begins (one more than texts).

    NULL counts as empty.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8), offsets


def slices(batch: pa.RecordBatch, text: int, most_bytes: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about so many bytes of text; a longer text is a slice of its own."""
    _, offsets = bytes_of(batch.column(text))
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(offsets, offsets[low] + most_bytes, side="right")) - 1
        high = min(max(high, low + 1), batch.num_rows)
        yield batch.slice(low, high - low)
        low = high
