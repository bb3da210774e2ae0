"""Quality: histogram gradient-boosted trees over document statistics.

Statistics come from whole texts, many texts at a time in numpy. Trees are grown on binned
statistics of a bounded sample of labelled rows, and kept as flat arrays that all rows of a batch
walk down together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import labelled
from tidemark.llm.words import SPACED, Block, blocks, shingles

FOLDS, HELD, CUT = 4, 2, 0.7
TREES, DEPTH, BINS, RATE = 80, 4, 64, 0.1

#: Kinds of bytes: lower case, upper case, digit, blank, line end, symbol, mark, other ASCII, rest.
KINDS = np.full(256, 7, dtype=np.int64)
KINDS[128:] = 8
for _kind, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b"#*$%&|<>", b"!?")):
    KINDS[list(_bytes)] = _kind
_LINES = np.ones(256, dtype=bool)
_LINES[10] = False

FEATURES = (
    "words", "mean_length", "length_deviation", "longest", "distinct_words", "repeated_windows", "repeated_pairs", "lines", "distinct_lines", "words_a_line",
    "lower", "upper", "digits", "blanks", "line_ends", "symbols", "marks", "other", "beyond",
)


def _distinct(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct values of each text (a block has fewer than 2 ** 20 texts, whose number takes 20 of 64 bits)."""
    n = len(first) - 1
    text = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    both = np.sort((values & ~np.uint64(0xFFFFF)) | text)
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return np.bincount((both & np.uint64(0xFFFFF)).astype(np.int64), minlength=n)


def statistics(block: Block) -> np.ndarray:
    """FEATURES of each text of a block, a row each; of a text without words all are 0."""
    n = len(block)
    size = np.diff(block.offsets)
    text = np.repeat(np.arange(n), size)
    kinds = np.bincount(text * 9 + KINDS[block.data], minlength=9 * n).reshape(n, 9)
    words = np.diff(block.first)
    some = np.maximum(words, 1)
    length = (block.end - block.begin).astype(np.float64)
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])[block.first]
    total, squares = np.diff(sums(length)), np.diff(sums(length**2))
    longest = np.zeros(n)
    full = np.flatnonzero(words)
    if len(full):
        longest[full] = np.maximum.reduceat(length, block.first[full])
    mean = total / some
    hashes = block.hashes()
    shares = []
    for k in (8, 2):
        values, begins = shingles(hashes, block.first, k)
        each = np.diff(begins)
        shares.append(1 - _distinct(values, begins) / np.maximum(each, 1))
    shares = [np.where(words > 0, s, 0) for s in shares]
    lines = Block(block.data, block.offsets, _LINES)
    n_lines = np.diff(lines.first)
    some_lines = np.maximum(n_lines, 1)
    out = np.column_stack([
        words, mean, np.sqrt(np.maximum(squares / some - mean**2, 0)), longest, _distinct(hashes, block.first) / some, shares[0], shares[1],
        n_lines, _distinct(lines.hashes(), lines.first) / some_lines, words / some_lines, kinds / np.maximum(size, 1)[:, None],
    ])
    out[words == 0] = 0
    return out


def of_texts(column: pa.Array) -> np.ndarray:
    parts = [statistics(b) for _, b in blocks(column, word_bytes=SPACED)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Trees:
    """All trees in one set of flat arrays: node i's feature, threshold, children and value.

    A leaf is its own child on both sides, so every row takes as many steps as the deepest tree.
    """

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots.tolist():
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return out


def binned(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bin numbers, and each feature's edges: bin k holds values in (edge k - 1, edge k]."""
    edges = []
    bins = np.zeros(x.shape, dtype=np.int64)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        if len(values) > BINS:
            values = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1), method="lower"))
        edges.append((values[:-1] + values[1:]) / 2)
        bins[:, j] = np.searchsorted(edges[-1], x[:, j], side="left")
    return bins, edges


def grow(x: np.ndarray, label: np.ndarray, weight: np.ndarray, trees: int = TREES, leaf: float = 5.0, ridge: float = 1.0) -> Trees:
    """Boosted trees for the logistic loss; with one label only, its smoothed share alone."""
    share = ((label * weight).sum() + 0.5) / (weight.sum() + 1)
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []
    roots: list[int] = []
    bins, edges = binned(x)
    width = max([1, *(len(e) + 1 for e in edges)])
    offset = np.arange(x.shape[1]) * width
    z = np.full(len(label), base)

    def split(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int) -> int:
        number = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        value = -RATE * g / (h + ridge)
        nodes.append([0, 0.0, number, number, value])
        if depth == DEPTH or h < 2:
            z[rows] += value
            return number
        cells = (bins[rows] + offset).ravel()
        sums = [np.bincount(cells, np.repeat(v, x.shape[1]), minlength=width * x.shape[1]).reshape(-1, width).cumsum(axis=1)[:, :-1] for v in (grad[rows], hess[rows], np.ones(len(rows)))]
        gl, hl, nl = sums
        gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
        gain[(nl < leaf) | (len(rows) - nl < leaf)] = 0
        if not gain.size or gain.max() <= 1e-6:
            z[rows] += value
            return number
        j, k = np.unravel_index(gain.argmax(), gain.shape)
        low = bins[rows, j] <= k
        nodes[number][:2] = [int(j), float(edges[j][k])]
        nodes[number][2] = split(rows[low], grad, hess, depth + 1)
        nodes[number][3] = split(rows[~low], grad, hess, depth + 1)
        return number

    for _ in range(trees if len(label) and label.min() != label.max() else 0):
        p = 1 / (1 + np.exp(-z))
        roots.append(split(np.arange(len(label)), (p - label) * weight, p * (1 - p) * weight, 0))
    flat = list(zip(*nodes, strict=True)) if nodes else [[]] * 5
    return Trees(base, np.array(roots, dtype=np.int64), *(np.array(c, dtype=t) for c, t in zip(flat, (np.int64, float, np.int64, np.int64, float), strict=True)))


def fitted(docs: DataFrame, labels: DataFrame, most: int = 6000) -> Trees:
    """Trees of at most about 2 * most labelled rows outside the held fold, chosen by the hash of doc_id.

    Only statistics of the sample reach the driver. If a label has more rows than the sample takes,
    its rows weigh more, so that scores follow the shares of all labels of the training folds.
    """
    sample = labelled(docs, labels, "quality", FOLDS, HELD, most, [F.col("text")])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = of_texts(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    rows = sample.select("doc_id", F.col("_label").cast("int"), "text").mapInArrow(measure, "doc_id long, label int, x array<double>").collect()
    rows.sort(key=lambda r: r.doc_id)
    label = np.array([r.label for r in rows], dtype=float)
    train = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD))
    every = {r.quality: r.n for r in train.groupBy("quality").agg(F.count_distinct("doc_id").alias("n")).collect()}
    have = {q: max(1, int((label == q).sum())) for q in (0, 1)}
    scale = {q: max(1.0, every.get(q, 0) / have[q]) for q in (0, 1)}
    weight = np.where(label == 1, scale[1], scale[0])
    weight *= len(label) / max(weight.sum(), 1)
    return grow(np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES)), label, weight)


def _scorer(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for batch in batches:
            z = trees.logits(of_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-z)), pa.float64())], names=["doc_id", "score"])

    return score


def scored(docs: DataFrame, labels: DataFrame, most: int = 6000) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted (score >= 0.7).

    Whole texts are scored; null and empty texts have all statistics 0. Null doc_ids are not held
    out; repeated rows score alike; extra columns are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, most))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scorer(sent), "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
