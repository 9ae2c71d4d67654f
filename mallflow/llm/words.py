"""Words of whole texts as arrays: byte classes, 64-bit word hashes and hashes of word runs, for use inside Arrow tasks.

A batch's texts are worked on as the UTF-8 bytes that Arrow already holds, in chunks of whole texts, so memory is bounded by
:data:`CHUNK_BYTES` or by the longest text, whichever is larger. Hashes are polynomials modulo 2**64, taken from running sums,
and mixed; equal words have equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_GRAM = 0xD6E8FEB86659FD93 | 1


def _table(separators: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256, dtype=np.uint64)
    if fold:
        codes[65:91] += 32
    return ~separators, codes + np.uint64(1)


def _spaces() -> np.ndarray:
    sep = np.zeros(256, dtype=bool)
    sep[[0x20, *range(0x09, 0x0E)]] = True
    return sep


def _punctuation() -> np.ndarray:
    # After A-Z are lower-cased, everything below 0x80 that is neither a digit nor a lower-case letter separates words.
    sep = np.zeros(256, dtype=bool)
    sep[:0x80] = True
    sep[0x30:0x3A] = False
    sep[0x41:0x5B] = False
    sep[0x61:0x7B] = False
    return sep


# Words between white space, as they are; and lower-cased words of digits, letters and everything beyond ASCII.
PLAIN = _table(_spaces(), fold=False)
FOLDED = _table(_punctuation(), fold=True)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _GRAM_POWERS = _Powers(_BASE), _Powers(_GRAM)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans_hash(data: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per byte span."""
    up, down = _BYTE_POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * down[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * up[starts])


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` consecutive words, by its first word. Runs over the end of a text are the caller's to drop."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = _GRAM_POWERS.upto(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * down[:n], out=sums[1:])
    first = np.arange(n - size + 1)
    return mix((sums[first + size] - sums[first]) * up[first] + np.uint64(size))


@dataclass
class Chunk:
    """Some whole texts: ``rows`` of the batch and their bytes, which ``bounds`` cuts into texts. Words are found when asked for."""

    rows: range
    data: np.ndarray
    bounds: np.ndarray
    table: tuple[np.ndarray, np.ndarray]

    @cached_property
    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        word = self.table[0][self.data]
        first, last = word.copy(), word.copy()
        if len(self.data):
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            cuts = self.bounds[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < len(self.data))]
            first[cuts] = word[cuts]
            last[cuts - 1] = word[cuts - 1]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    @property
    def starts(self) -> np.ndarray:
        """First byte of each word."""
        return self._places[0]

    @property
    def ends(self) -> np.ndarray:
        """The byte after each word."""
        return self._places[1]

    @cached_property
    def edges(self) -> np.ndarray:
        """Cuts the words into texts."""
        return np.searchsorted(self.starts, self.bounds)

    @cached_property
    def hashes(self) -> np.ndarray:
        return spans_hash(self.data, self.table[1], self.starts, self.ends)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.edges)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows)), self.counts)

    def room(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its text."""
        return np.repeat(self.edges[1:], self.counts) - np.arange(len(self.starts))


def _column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, places, data = array.buffers()
    offsets = np.frombuffer(places, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, table: tuple[np.ndarray, np.ndarray] = PLAIN, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of an Arrow string column, some at a time. A null text has no words."""
    data, offsets = _column(column)
    low = 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield Chunk(range(low, high), data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], table)
        low = high
