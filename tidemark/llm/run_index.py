"""A run-length index of strings: runs of the Burrows-Wheeler transform with sampled run heads.

In the transform of repetitive strings equal letters stand in few long runs. Two facts make the run
heads enough. For a text position i let phi(i) be the start of the suffix just before i's in sorted
order, and plcp(i) the length of their common prefix. If i's row is no head of a run, then
phi(i) = phi(i - 1) + 1 and plcp(i) = plcp(i - 1) - 1. So with phi and plcp at the heads alone,
matching statistics of the strings against themselves are read off in text order: from a head s
with match length l, position s + k matches phi(s) + k over l - k bytes, up to the next head.
Strings end in separators that differ, so no match passes the end of a string.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_PACKED = 7  # letters of 9 bits in a sort key


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letters (1 to 256) of all strings, each followed by 0, and where each string starts."""
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.zeros(starts[-1], dtype=np.int64)
    inside = np.ones(len(text), dtype=bool)
    inside[starts[1:] - 1] = False
    text[inside] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + 1
    return text, starts[:-1]


def sorted_suffixes(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling; left: letters from each place to its separator, with it.

    A suffix ends at its separator; of equal ones the earlier comes first, as if separators rose.
    """
    n = len(text)
    key = np.zeros(n, dtype=np.int64)
    for k in range(_PACKED):
        letter = np.zeros(n, dtype=np.int64)
        letter[: n - k] = text[k:]
        key = (key << 9) | np.where(left > k, letter, 0)
    rank = _ranks(key)
    span, longest = _PACKED, int(left.max(initial=0))
    while span < longest:
        after = np.zeros(n, dtype=np.int64)
        after[: n - span] = rank[span:]
        rank = _ranks((rank << 32) | np.where(left > span, after + 1, 0))
        span *= 2
    return np.sort((rank << 32) | np.arange(n)) & 0xFFFFFFFF


def _ranks(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if len(key) else ordered
    return rank


def common_prefix(text: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at a and b, that end before either's separator."""
    most = np.minimum(left[a], left[b]) - 1
    out = np.zeros(len(a), dtype=np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        same = text[a[live] + out[live]] == text[b[live] + out[live]]
        live = live[same]
        out[live] += 1
        live = live[out[live] < most[live]]
    return out


@dataclass
class RunIndex:
    """Runs of the transform: letters and lengths; and at heads, in text order: start, phi and plcp."""

    letters: np.ndarray
    lengths: np.ndarray
    heads: np.ndarray
    phi: np.ndarray
    plcp: np.ndarray
    size: int

    @classmethod
    def of(cls, strings: list[bytes]) -> RunIndex:
        text, starts = joined(strings)
        n = len(text)
        ends = np.append(starts[1:], n)
        left = np.repeat(ends, ends - starts) - np.arange(n)
        suffixes = sorted_suffixes(text, left)
        before = np.where(suffixes > 0, text[suffixes - 1], 0)  # the transform; 0 where a string starts
        head = np.ones(n, dtype=bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)  # separators differ, so each is a run
        rows = np.flatnonzero(head)
        lengths = np.diff(np.append(rows, n))
        sampled = rows[1:]
        at, source = suffixes[sampled], suffixes[sampled - 1]
        order = np.argsort(at)
        at, source = at[order], source[order]
        return cls(before[rows], lengths, at, source, common_prefix(text, left, at, source), n)

    def matching_statistics(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Text positions whose match with the suffix before them has at least `least` bytes, and where it starts."""
        until = np.minimum(np.append(self.heads[1:], self.size), self.heads + self.plcp - least + 1)
        count = np.maximum(until - self.heads, 0)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(self.heads, count) + step, np.repeat(self.phi, count) + step


def repeated(strings: list[bytes], places: np.ndarray, groups: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of every substring of `least` bytes that also occurs at an earlier place.

    A substring at offset o of string i is at place (groups[i], places[i] + o).
    """
    index = RunIndex.of(strings)
    at, source = index.matching_statistics(least)
    if not len(at):
        return at, at
    to = np.arange(index.size)
    to[at] = source
    while True:  # a chain of equal substrings leads to its first in sorted order, in few doublings
        further = to[to[at]]
        if (further == to[at]).all():
            break
        to[at] = further
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings)) + 1
    starts = np.cumsum(lengths) - lengths
    every = np.union1d(at, to[at])
    string = np.searchsorted(starts, every, side="right") - 1
    _, group = np.unique(groups, return_inverse=True)
    place = (group[string] << 40) + places[string] + every - starts[string]
    first = np.full(index.size, np.iinfo(np.int64).max)
    np.minimum.at(first, to[every], place)
    later = place > first[to[every]]
    return string[later], (every - starts[string])[later]
