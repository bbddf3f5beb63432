"""Words and word windows of whole Arrow batches as 64-bit hashes, with numpy inside the tasks.

A batch is cut into pieces of about PIECE bytes of text (one text longer than that is a piece of its own), so the memory of
a task follows its longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE[_SPACE] = 0
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_P = np.uint64(0x9E3779B97F4A7C15)
#: A second base, for windows that are told apart by 128 bits.
SECOND = np.uint64(0xD1342543DE82EF95)
_INVERSE = {p: np.uint64(pow(int(p), -1, 1 << 64)) for p in (_P, SECOND)}
_POWERS = {p: np.ones(1, np.uint64) for p in (*_INVERSE, *_INVERSE.values())}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64 = _P) -> np.ndarray:
    if len(_POWERS[base]) < n:
        out = np.full(max(n, 2 * len(_POWERS[base])), base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


@dataclass
class Piece:
    """Some rows of a batch. Words i of row r are first[r] <= i < first[r + 1]; starts and ends are bytes in data."""
    row: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def starts_of(self, k: int) -> np.ndarray:
        """First words of the windows of k words that lie within one row."""
        room = np.repeat(self.first[1:], self.counts) - np.arange(len(self.hashes))
        return np.flatnonzero(room >= k)

    def rolling(self, k: int, base: np.uint64 = _P) -> np.ndarray:
        """Hash of the k words from every word on, across rows too; the same for the same words wherever they stand."""
        h, n = self.hashes, len(self.hashes)
        if n < k:
            return np.empty(0, np.uint64)
        if k <= 8:
            out = np.zeros(n - k + 1, np.uint64)
            for j in range(k):
                out = out * base + h[j:n - k + 1 + j]
        else:  # sums of h[j] * base**j, divided by base**i for the window at i
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(n, base), dtype=np.uint64)])
            out = (total[k:] - total[:n - k + 1]) * _powers(n - k + 1, _INVERSE[base])
        return mix(out)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window of k words within one row."""
        at = self.starts_of(k)
        return at, self.rolling(k)[at] if len(at) else np.empty(0, np.uint64)


def folded(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One hash for each run of values: of its content, order and length."""
    if not len(starts):
        return np.empty(0, np.uint64)
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    return mix(np.add.reduceat(values * _powers(int(lengths.max()))[place], starts) ^ lengths.astype(np.uint64))


def pieces(column: pa.Array, lower: bool = False, size: int = PIECE, rows: int = 1 << 30) -> Iterator[Piece]:
    """Cut a string column (nulls: no words) into pieces of at most rows rows and find and hash the words `[^\\x20\\x09-\\x0D]+` of each."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    r, n = 0, len(column)
    while r < n:
        end = min(r + rows, max(r + 1, int(np.searchsorted(offsets, offsets[r] + size, "right")) - 1))
        yield _piece(r, end - r, data[offsets[r]:offsets[end]], offsets[r:end + 1] - offsets[r], lower)
        r = end


def _piece(row: int, rows: int, data: np.ndarray, offsets: np.ndarray, lower: bool) -> Piece:
    word = ~_SPACE[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    start[inner] = word[inner]
    end[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    if len(starts):
        lengths = np.diff(np.append(starts, len(data)))
        place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
        value = (_LOWER if lower else _BYTE)[data[starts[0]:]] * _powers(int(place.max()) + 1)[place]
        hashes = mix(np.add.reduceat(value, starts - starts[0]))
    else:
        hashes = np.empty(0, np.uint64)
    return Piece(row, rows, data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))
