"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact similarity.

Texts are compared as lower-cased words of letters, digits and anything beyond ASCII. For every
benchmark item of n words, windows of n words are taken from each document. A window whose
five-word shingles can't reach the similarity, because too few of them occur in any item, is
passed over, which loses nothing. The others get a 64-bit SimHash, in which each occurrence of a
shingle weighs one. Fingerprints are cut into 4 blocks of 16 bits: of two that differ in at most 19
bits, some block differs in at most 4, so probing the values near each block gives all candidates
within the radius; few items are compared one by one, with the same result. Candidates are verified
by exact weighted similarity: the sum over shingles of the smaller number of occurrences over that
of the larger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import ALNUM, Block, blocks, released, shingles

#: Bits that fingerprints of a window and its item may differ in. At similarity 0.8 they differ
#: in 9.7 of 64 on average, with a deviation of 2.9; a test measures the share within the radius.
RADIUS = 19
SHINGLE = 5
#: Bytes of benchmark text that are sent to the tasks at once; more is taken in several passes.
MOST_BYTES = 32 << 20
FOUND = "doc_id long, item_id long, similarity double, start_word long, item_words long"
_BITS = 20


def simhash(values: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of 64 bits of each value."""
    return np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int16) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).reshape(-1, 8)


#: Fingerprints are cut into BLOCKS blocks of 16 bits. Two within RADIUS agree in one of them up to RADIUS // BLOCKS bits.
BLOCKS = 4
#: Items of one length up to which every pair is compared in parts; beyond, blocks are probed. The pairs are the same.
DENSE = 1 << 14


def probes(bits: int, width: int = 16) -> np.ndarray:
    """All values of width bits with at most `bits` of them set."""
    values = np.arange(1 << width, dtype=np.uint32)
    return values[np.bitwise_count(values) <= bits]


def candidates(w: np.ndarray, s: np.ndarray, radius: int = RADIUS, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, items) that come near in a block, each pair once for each such block, in parts of bounded size.

    Items stand in order of a block's value, with a table of where each value starts; a window looks
    up the values near its own. A pair of random fingerprints is a candidate about 0.15 times.
    """
    near_values = probes(radius // BLOCKS)
    for block in range(BLOCKS):
        low = np.uint64(16 * block)
        of_windows, of_items = (((x >> low) & np.uint64(0xFFFF)).astype(np.uint32) for x in (w, s))
        order = np.argsort(of_items, kind="stable")
        table = np.concatenate([[0], np.cumsum(np.bincount(of_items, minlength=1 << 16))])
        step = max(1, most // max(len(near_values), len(s)))
        for at in range(0, len(w), step):
            looked = of_windows[at : at + step, None] ^ near_values[None, :]
            first, n = table[looked].ravel(), (table[looked + 1] - table[looked]).ravel()
            held = np.flatnonzero(n)
            n, first = n[held], first[held]
            place = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
            yield np.repeat(at + held // len(near_values), n), order[place]


def near(windows: np.ndarray, items: np.ndarray, radius: int = RADIUS, dense: int = DENSE, most: int = 1 << 20) -> np.ndarray:
    """(window, item) pairs of fingerprints (rows of 8 bytes) that differ in at most radius bits, all of them, in order.

    Up to `dense` items cost less to compare with every window than a window's probes do.
    """
    w, s = (np.ascontiguousarray(x).view(np.uint64).ravel() for x in (windows, items))
    if len(s) <= dense:
        step = max(1, most // max(1, len(s)))
        out = [np.argwhere(np.bitwise_count(w[at : at + step, None] ^ s[None, :]) <= radius) + [at, 0] for at in range(0, len(w), step)]
        return np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)
    found = [np.zeros(0, dtype=np.int64)]
    for a, b in candidates(w, s, radius, most):
        close = np.bitwise_count(w[a] ^ s[b]) <= radius
        found.append(a[close] * len(s) + b[close])
    return np.stack(np.divmod(np.unique(np.concatenate(found)), len(s)), axis=1)


class Items:
    """The shingles and fingerprints of benchmark items, by length."""

    def __init__(self, rows: list[tuple[int, str]], similarity: float):
        self.similarity = similarity
        self.ids: list[int] = []
        self.values: list[np.ndarray] = []
        self.words: list[int] = []
        for item_id, text in rows:
            for _, block in blocks(pa.array([text]), lower=True, word_bytes=ALNUM):
                values, _ = shingles(block.hashes(), block.first, SHINGLE)
                if len(values):
                    self.ids.append(item_id)
                    self.values.append(values)
                    self.words.append(len(block.begin))
        self.known = np.unique(np.concatenate(self.values)) if self.values else np.zeros(0, dtype=np.uint64)
        self.bitmap = np.zeros(1 << _BITS, dtype=bool)
        self.bitmap[self._place(self.known)] = True
        self.by_length: dict[int, list[int]] = {}
        for i, v in enumerate(self.values):
            self.by_length.setdefault(len(v), []).append(i)
        self.prints = {m: _packed(np.stack([simhash(self.values[i]).sum(axis=0) for i in which])) for m, which in self.by_length.items()}
        self.longest = max(self.by_length, default=0)

    @staticmethod
    def _place(values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - _BITS)).astype(np.int64)

    def hits(self, values: np.ndarray) -> np.ndarray:
        """Whether each shingle occurs in any item."""
        out = self.bitmap[self._place(values)] if len(self.known) else np.zeros(len(values), dtype=bool)
        at = np.flatnonzero(out)
        if len(at):
            found = np.minimum(np.searchsorted(self.known, values[at]), len(self.known) - 1)
            out[at] = self.known[found] == values[at]
        return out

    def likeness(self, values: np.ndarray, item: int) -> float:
        a, na = np.unique(values, return_counts=True)
        b, nb = np.unique(self.values[item], return_counts=True)
        _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        both = int(np.minimum(na[i], nb[j]).sum())
        return both / (len(values) + len(self.values[item]) - both)

    def in_text(self, values: np.ndarray, hit: np.ndarray) -> dict[int, tuple[float, int]]:
        """The items found in one text, from its shingles and hits: similarity and first word of the best window."""
        found: dict[int, tuple[float, int]] = {}
        at = np.flatnonzero(hit)
        for part in np.split(at, np.flatnonzero(np.diff(at) > self.longest) + 1):
            low, high = max(0, int(part[0]) - self.longest), min(len(values), int(part[-1]) + self.longest + 1)
            counts = np.concatenate([[0], np.cumsum(hit[low:high])])
            sums = None
            for m, which in self.by_length.items():
                size = min(m, high - low)
                # at least this share of the larger set must be common
                starts = np.flatnonzero(counts[size:] - counts[: len(counts) - size] >= self.similarity * m - 1e-9)
                if not len(starts):
                    continue
                if sums is None:
                    sums = np.concatenate([np.zeros((1, 64), dtype=np.int32), np.cumsum(simhash(values[low:high]), axis=0, dtype=np.int32)])
                for w, i in near(_packed(sums[starts + size] - sums[starts]), self.prints[m]):
                    start = low + int(starts[w])
                    like = self.likeness(values[start : start + size], which[i])
                    if like >= self.similarity - 1e-12 and like > found.get(which[i], (0.0, 0))[0]:
                        found[which[i]] = (like, start)
        return found

    def in_block(self, block: Block) -> Iterator[tuple[int, dict[int, tuple[float, int]]]]:
        """(text, items found in it) for the texts of a block that hold any."""
        values, begins = shingles(block.hashes(), block.first, SHINGLE)
        hit = self.hits(values)
        for i in np.unique(np.searchsorted(begins, np.flatnonzero(hit), side="right") - 1).tolist():
            a, b = begins[i], begins[i + 1]
            if found := self.in_text(values[a:b], hit[a:b]):
                yield i, found


def _passes(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items with a text and an item_id, in parts of about MOST_BYTES at most."""
    rows = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    parts = max(1, -(-total // MOST_BYTES))
    for part in range(parts):
        here = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield sorted((r.item_id, r.text) for r in here.collect())


_held: dict[tuple, Items] = {}


def _items(sent, similarity: float) -> Items:
    """The items of a broadcast, made once a worker; those of an earlier one go."""
    key = (hash(tuple(sent.value)), len(sent.value), similarity)
    if key not in _held:
        _held.clear()
        _held[key] = Items(sent.value, similarity)
    return _held[key]


def _searcher(sent, similarity: float, keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(sent, similarity)
        for batch in batches:
            column = batch.schema.get_field_index("text")
            clean = np.ones(len(batch), dtype=bool)
            rows = []
            for low, block in blocks(batch.column(column), lower=True, word_bytes=ALNUM):
                for i, found in items.in_block(block):
                    clean[low + i] = False
                    rows += [(low + i, items.ids[k], like, start, items.words[k]) for k, (like, start) in found.items()]
            if keep:
                yield batch.filter(pa.array(clean))
            elif rows:
                ids = batch.column(0).take(pa.array([r[0] for r in rows]))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([r[c] for r in rows]) for c in range(1, 5)]], names=["doc_id", "item_id", "similarity", "start_word", "item_words"])
        released()

    return search


def contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """One row per document row and benchmark item found in it, by the best of its windows.

    doc_id, item_id, similarity (at least the one asked for), start_word (from 0), item_words. An
    item of fewer than five words is its whole sequence; a text shorter than an item is one window.
    Null or empty texts and items are in nothing; items of one id with several texts may each be
    found; null doc_ids and repeated rows are searched like others; extra columns are ignored; an
    empty table gives no rows. Items are sent to the tasks in parts of bounded size.
    """
    out = None
    for rows in _passes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(rows)
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_searcher(sent, similarity, False), FOUND)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows that hold no benchmark item, with all their columns; edge cases as in contamination()."""
    for rows in _passes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(rows)
        docs = docs.mapInArrow(_searcher(sent, similarity, True), docs.schema)
    return docs
