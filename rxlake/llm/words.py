"""Words of whole Arrow batches of text as numpy arrays, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D, as in ``[^\\x20\\x09-\\x0D]+``. Documents
are handled in chunks of a megabyte at most; a longer document is a chunk of its own, hashed piece by
piece, so memory follows the longest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
# For work row by row, whose results do not depend on where chunks end: arrays by byte or word stay small.
ROWS_BYTES = 1 << 18
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Letters and digits in lower case; all other ASCII characters separate words.
LETTERS = LOWER.copy()
LETTERS[[b for b in range(128) if not chr(b).isalnum()]] = 32
_BYTE = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_KEPT: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base from 0 to n, at least, and of its inverse; those of a chunk are kept until ``give_back``."""
    if n > CHUNK_BYTES:
        return _powers(_P, n + 1), _powers(_P_INVERSE, n + 1)
    if not _KEPT or n >= len(_KEPT[0]):
        size = min(1 << n.bit_length(), CHUNK_BYTES) + 1
        _KEPT[:] = [_powers(_P, size), _powers(_P_INVERSE, size)]
    return _KEPT[0], _KEPT[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def give_back() -> None:
    """Return freed memory to the system, as Python workers stay for the tasks of later stages."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets of its rows; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Chunk:
    """Some consecutive rows: their bytes, row offsets, and where each word begins and ends."""

    first: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word_row: np.ndarray  # row within the chunk, by word
    word_offsets: np.ndarray  # n + 1 offsets of the rows into the words

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return self.span_hashes(self.starts, self.ends)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span; starts and ends must both ascend."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(out):
            base = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
            part = self.data[base : ends[to - 1]]
            power, inverse = powers(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * power[: len(part)], dtype=np.uint64, out=sums[1:])
            s, e = starts[at:to] - base, ends[at:to] - base
            out[at:to] = (sums[e] - sums[s]) * inverse[s]
            at = to
        return mix(out ^ (ends - starts).astype(np.uint64))


def chunks(column: pa.Array, table: np.ndarray | None = None, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into chunks of whole rows of about ``size`` bytes, with bytes replaced by a table if there is one."""
    data, offsets = utf8(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        part = data[offsets[row] : offsets[to]]
        own = offsets[row : to + 1] - offsets[row]
        if table is not None:
            part = table[part]
        letter = ~_IS_SPACE[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[own] = True
        before = np.ones(len(part), bool)  # a word may begin here
        before[1:] = ~letter[:-1]
        before |= edge[:-1]
        after = np.ones(len(part), bool)  # a word may end here
        after[:-1] = ~letter[1:]
        after |= edge[1:]
        starts = np.flatnonzero(letter & before)
        ends = np.flatnonzero(letter & after) + 1
        word_offsets = np.searchsorted(starts, own)
        word_row = np.repeat(np.arange(to - row), np.diff(word_offsets))
        yield Chunk(row, to - row, part, own, starts, ends, word_row, word_offsets)
        row = to
