"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def _byte_table(separators: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table


#: Word bytes: all but ASCII white space; and digits, a-z and all beyond ASCII.
SPACED = _byte_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER, MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
MARK[list(b".,;:!?")] = True


def _power(kind: str, size: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < size:
        size = max(size, 1 << 20)
        base = _MULTIPLIER if kind == "up" else pow(_MULTIPLIER, -1, 1 << 64)
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        have = _powers[kind] = np.cumprod(factors)
    return have[:size] if len(have) > size else have


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def released() -> None:
    """Give memory that a finished task has left free in this worker back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Block:
    """Some whole texts: bytes, and where each text and each of its words starts and ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = SPACED, marks: bool = False):
        """marks: a word of ASCII letters also ends before one of .,;:!?"""
        self.data, self.offsets, n = data, offsets, len(data)
        inside = word_bytes[data]
        begin, last = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        if marks and n:
            cut = LETTER[data[:-1]] & MARK[data[1:]]
            begin[1:] |= cut
            last[:-1] |= cut
        starts, ends = offsets[:-1], offsets[1:]
        starts, ends = starts[starts < n], ends[ends > 0]
        begin[starts] = inside[starts]
        last[ends - 1] = inside[ends - 1]
        self.begin, self.end = np.flatnonzero(begin), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.begin, offsets)  # words before each text, and all words

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        """A uint64 hash of the bytes of each word."""
        n = len(self.data)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power("up", n)[:n], out=total[1:])
        return mixed((total[self.end] - total[self.begin]) * _power("down", n + 1)[self.begin])

    def lowered_letters(self) -> None:
        """Lower-case the words that are ASCII letters alone."""
        upper = np.flatnonzero((self.data >= 65) & (self.data <= 90))
        if len(upper):
            other = np.concatenate([[0], np.cumsum(~LETTER[self.data])])
            word = np.maximum(np.searchsorted(self.begin, upper, side="right") - 1, 0)
            plain = other[self.end[word]] == other[self.begin[word]]
            self.data = self.data.copy()
            self.data[upper[plain]] += 32

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words in each text, and where each text's begin.

    A text of fewer words, but at least one, has its whole sequence as its one shingle.
    """
    counts = np.diff(first)
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(runs)])
    factors = [pow(_MULTIPLIER, j + 1, 1 << 64) for j in range(k)]
    n = len(hashes)
    whole = np.zeros(max(0, n - k + 1), dtype=np.uint64)
    for j, f in enumerate(factors):
        whole += hashes[j : n - k + 1 + j] * np.uint64(f) if n >= k else np.uint64(0)
    at = np.arange(begins[-1]) - np.repeat(begins[:-1] - first[:-1], runs)
    short = np.flatnonzero((counts > 0) & (counts < k))
    safe = np.minimum(at, max(0, len(whole) - 1))
    out = whole[safe] if len(whole) else np.zeros(len(at), dtype=np.uint64)
    for i in short:
        value = int(counts[i])
        for j in range(int(counts[i])):
            value = (value + int(hashes[first[i] + j]) * factors[j]) & _MASK
        out[begins[i]] = value
    return mixed(out), begins


def whole_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the texts' offsets in them; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, size: int = 1 << 20, lower: bool = False, word_bytes: np.ndarray = SPACED, marks: bool = False) -> Iterator[tuple[int, Block]]:
    """Consecutive texts of about size bytes together (a longer text alone), with the first one's row."""
    data, offsets = whole_texts(column)
    low = 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1)
        part = data[offsets[low] : offsets[high]]
        yield low, Block(LOWER[part] if lower else part, offsets[low : high + 1] - offsets[low], word_bytes, marks)
        low = high
