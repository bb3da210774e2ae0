"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

Words are hashed twice, and a word's vector is the two buckets' vectors side by side, so that a
word that shares one bucket with another still differs from it. Filters of several widths run over
the words, each keeps its maximum over the text, and a logistic layer scores the maxima. The model
is trained with Adam on a bounded sample of labelled rows. The score's middle and each language's
threshold are placed on a fifth of all labelled rows, which the fit never sees: they are scored in
Spark and come back as counts by language, label and bin of the score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import labelled
from tidemark.llm.words import ALNUM, blocks, mixed

WIDTHS = (1, 2, 3)
FILTERS = 12
DIM = 8  # of each of a word's two vectors
BITS = 17  # of a bucket's number
FOLDS, HELD = 5, 0
PLACED = 1  # remainder of the second fold, whose rows place middle and thresholds
BINS = 64  # of the logit, to one unit
MOST_LOGIT = 30
PAD = max(WIDTHS)  # rows after each text
MOST_SENT = 2_000_000  # ids of labelled rows that are broadcast, some 16 MB
LEAST_ROWS = 20  # of either label, for a language's own threshold


@dataclass
class Model:
    """vectors: (2 ** BITS + 1, 2 * DIM); bucket 2 ** BITS is the padding after each text."""

    vectors: np.ndarray
    kernels: list[np.ndarray] = field(default_factory=list)  # (width, 2 * DIM, FILTERS)
    biases: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32))
    middle: float = 0.0

    @staticmethod
    def new(seed: int = 5) -> Model:
        draw = np.random.default_rng(seed)
        vectors = draw.normal(0, 0.02, ((1 << BITS) + 1, 2 * DIM)).astype(np.float32)
        vectors[-1] = 0
        kernels = [draw.normal(0, 1 / np.sqrt(2 * DIM * w), (w, 2 * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        weights = draw.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        return Model(vectors, kernels, [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS], weights)


def buckets(hashes: np.ndarray) -> np.ndarray:
    """The two buckets of each word."""
    other = mixed(hashes)
    shift = np.uint64(64 - BITS)
    return np.stack([(hashes >> shift).astype(np.int32), (other >> shift).astype(np.int32)], axis=1)


def padded(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of texts' words with the padding after each text, and where each text begins."""
    n = len(first) - 1
    begins = first + PAD * np.arange(n + 1)
    out = np.full((begins[-1], 2), 1 << BITS, dtype=np.int32)
    out[np.arange(first[-1]) + PAD * np.repeat(np.arange(n), np.diff(first))] = words
    return out, begins


def places(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's filters begin: at each of its words, or at the padding if it has none; so none reaches the next text."""
    return begins[:-1], np.maximum(begins[1:] - PAD, begins[:-1] + 1)


def _looked_up(model: Model, rows: np.ndarray) -> np.ndarray:
    return np.concatenate([model.vectors[rows[:, 0], :DIM], model.vectors[rows[:, 1], DIM:]], axis=1)


def _maps(model: Model, x: np.ndarray) -> Iterator[np.ndarray]:
    """For each width, the filters' values at each place; past the end all is padding."""
    for kernel, bias in zip(model.kernels, model.biases, strict=True):
        out = x @ kernel[0] + bias
        for j in range(1, len(kernel)):
            out[:-j] += x[j:] @ kernel[j]
        yield out


def logits(model: Model, rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The logistic layer's input for each text; of a text without words, that of padding alone."""
    edges = np.stack(places(begins), axis=1).ravel()
    pooled = [np.maximum(np.maximum.reduceat(m, edges, axis=0)[::2], 0) for m in _maps(model, _looked_up(model, rows))]
    return np.concatenate(pooled, axis=1) @ model.weights - model.middle


def _step(model: Model, rows: np.ndarray, begins: np.ndarray, label: np.ndarray, weight: np.ndarray, adam: Adam) -> None:
    x = _looked_up(model, rows)
    n = len(label)
    pooled, tops = [], []
    for m in _maps(model, x):
        at = np.stack([m[a:b].argmax(axis=0) + a for a, b in zip(*places(begins), strict=True)])
        tops.append(at)
        pooled.append(np.take_along_axis(m, at, axis=0))
    raw = np.concatenate(pooled, axis=1)
    act = np.maximum(raw, 0)
    p = 1 / (1 + np.exp(-np.clip(act @ model.weights - model.middle, -30, 30)))
    error = ((p - label) * weight / n).astype(np.float32)
    back = error[:, None] * model.weights[None, :] * (raw > 0)
    grads = {"weights": act.T @ error, "middle": np.array([-error.sum()], dtype=np.float32)}
    touched: list[np.ndarray] = []
    slopes: list[np.ndarray] = []
    for k, (kernel, at) in enumerate(zip(model.kernels, tops, strict=True)):
        g = back[:, k * FILTERS : (k + 1) * FILTERS]
        grads[f"bias{k}"] = g.sum(axis=0)
        dk = np.zeros_like(kernel)
        for j in range(len(kernel)):
            where = np.minimum(at + j, len(x) - 1)
            dk[j] = np.einsum("nf,nfd->df", g, x[where])
            touched.append(where.ravel())
            slopes.append((g[:, :, None] * kernel[j].T[None, :, :]).reshape(-1, 2 * DIM))
        grads[f"kernel{k}"] = dk
    adam.begin()
    model.weights -= adam.step("weights", grads["weights"])
    model.middle -= float(adam.step("middle", grads["middle"])[0])
    for k in range(len(WIDTHS)):
        model.biases[k] -= adam.step(f"bias{k}", grads[f"bias{k}"])
        model.kernels[k] -= adam.step(f"kernel{k}", grads[f"kernel{k}"])
    where, slope = np.concatenate(touched), np.concatenate(slopes)
    for half in (0, 1):
        part = slice(half * DIM, (half + 1) * DIM)
        adam.rows(model.vectors, part, rows[where, half], slope[:, part])
    model.vectors[-1] = 0


class Adam:
    """Adam for dense arrays, and for the touched rows of a large table."""

    def __init__(self, rate: float = 0.01, table: tuple[int, int] | None = None):
        self.rate, self.t = rate, 0
        self.m: dict[str, np.ndarray] = {}
        self.v: dict[str, np.ndarray] = {}
        if table:
            self.m["table"], self.v["table"] = np.zeros(table, dtype=np.float32), np.zeros(table, dtype=np.float32)

    def begin(self) -> None:
        self.t += 1

    def _moved(self, m: np.ndarray, v: np.ndarray) -> np.ndarray:
        return self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)

    def step(self, name: str, grad: np.ndarray) -> np.ndarray:
        self.m[name] = 0.9 * self.m.get(name, 0) + 0.1 * grad
        self.v[name] = 0.999 * self.v.get(name, 0) + 0.001 * grad**2
        return self._moved(self.m[name], self.v[name])

    def rows(self, table: np.ndarray, part: slice, where: np.ndarray, slope: np.ndarray) -> None:
        at, inverse = np.unique(where, return_inverse=True)
        grad = np.zeros((len(at), slope.shape[1]), dtype=np.float32)
        np.add.at(grad, inverse, slope)
        m, v = self.m["table"][at, part] * 0.9 + 0.1 * grad, self.v["table"][at, part] * 0.999 + 0.001 * grad**2
        self.m["table"][at, part], self.v["table"][at, part] = m, v
        table[at, part] -= self._moved(m, v)


@dataclass
class Texts:
    """Words of texts one after the other, as buckets."""

    words: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Texts:
        words, counts = [np.zeros((0, 2), dtype=np.int32)], [np.zeros(1, dtype=np.int64)]
        for _, block in blocks(pa.array(texts, pa.string()), lower=True, word_bytes=ALNUM):
            words.append(buckets(block.hashes()))
            counts.append(np.diff(block.first))
        return Texts(np.concatenate(words), np.cumsum(np.concatenate(counts)))

    def batch(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.words[self.first[i] : self.first[i + 1]] for i in which]
        first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return padded(np.concatenate(parts), first)

    def logits(self, model: Model, which: np.ndarray) -> np.ndarray:
        out = [logits(model, *self.batch(which[i : i + 64])) for i in range(0, len(which), 64)]
        return np.concatenate(out) if out else np.zeros(0)


Counts = dict[int, tuple[int, int]]  # clean and toxic rows by bin


def cut_point(counts: Counts) -> float | None:
    """The logit from which the F1 measure is best, in the middle of the gap; None without both labels."""
    bins = np.array(sorted(counts, reverse=True), dtype=np.int64)
    clean, toxic = np.array([counts[b] for b in bins.tolist()], dtype=np.int64).reshape(-1, 2).T
    if not clean.sum() or not toxic.sum():
        return None
    hit, taken = np.cumsum(toxic), np.cumsum(clean + toxic)
    k = int((2 * hit / (taken + toxic.sum())).argmax())
    after = bins[k + 1] + 1 if k + 1 < len(bins) else bins[k]  # the next bin's upper edge
    return float(bins[k] + after) / 2 / BINS


def bins_of(z: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(z, -MOST_LOGIT, MOST_LOGIT) * BINS).astype(np.int64)


def placed(model: Model, by_lang: dict[str, Counts]) -> dict[str, float]:
    """Move the model's middle to the best cut over all counts, and return the languages' thresholds.

    A language has its own if at least LEAST_ROWS of its rows are of either label.
    """
    every: Counts = {}
    for counts in by_lang.values():
        for b, (clean, toxic) in counts.items():
            had = every.get(b, (0, 0))
            every[b] = (had[0] + clean, had[1] + toxic)
    cut = cut_point(every)
    if cut is None:
        return {}
    model.middle += cut
    many = {name: c for name, c in by_lang.items() if name and min(np.array(list(c.values())).sum(axis=0)) >= LEAST_ROWS}
    return {name: float(1 / (1 + np.exp(cut - cut_point(c)))) for name, c in many.items()}


def train(texts: list[str], label: np.ndarray, langs: list[str | None], fold: np.ndarray, weight: np.ndarray, epochs: int = 8, size: int = 32) -> tuple[Model, dict[str, Counts]]:
    """A model of the rows outside fold % 5 == 1, and the counts that place it where no such rows are set aside.

    The counts are of the rows it was trained on. With one label only, the model scores that
    label's share, and there are none.
    """
    model = Model.new()
    held = fold % FOLDS == PLACED
    if not held.any() or held.all():
        held = np.zeros(len(label), dtype=bool)
    use = np.flatnonzero(~held)
    if not len(use) or label[use].min() == label[use].max():
        model.weights[:] = 0
        share = (label.sum() + 0.5) / (len(label) + 1)
        model.middle = -float(np.log(share / (1 - share)))
        return model, {}
    data = Texts.of(texts)
    adam = Adam(0.01, model.vectors.shape)
    draw = np.random.default_rng(11)
    for epoch in range(epochs):
        adam.rate = 0.01 * (1 - epoch / epochs)
        for part in np.array_split(draw.permutation(use), max(1, len(use) // size)):
            _step(model, *data.batch(part), label[part], weight[part], adam)
    by_lang: dict[str, Counts] = {}
    for i, b in zip(use.tolist(), bins_of(data.logits(model, use)).tolist(), strict=True):
        counts = by_lang.setdefault(langs[i] or "", {})
        clean, toxic = counts.get(b, (0, 0))
        counts[b] = (clean + (label[i] == 0), toxic + (label[i] == 1))
    return model, by_lang


def _second() -> Column:
    return F.crc32(F.reverse(F.col("doc_id").cast("string")))


def counted(docs: DataFrame, labels: DataFrame, model: Model) -> dict[str, Counts]:
    """Rows of all labelled documents of the second fold, outside the held one, by language and bin.

    Texts are scored where they lie, those with a label alone if the labels' ids, a number each, can
    be sent to the tasks (up to MOST_SENT); numbers alone are joined with the labels. A doc_id with
    several labels counts with its largest, one with several texts counts once.
    """
    inside = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD) & (_second() % FOLDS == PLACED)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.where(inside).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(lang, F.lit("")).alias("lang"))
    marks = labels.where(inside & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("label"))
    if marks.count() <= MOST_SENT:
        rows = rows.join(F.broadcast(marks.select("doc_id")), "doc_id", "left_semi")
    bins = rows.mapInArrow(_binned(sent), "doc_id long, lang string, bin long")
    once = bins.join(marks, "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", "bin", "label")).alias("r"))
    found = once.groupBy("r.lang", "r.bin").agg(F.count_if(F.col("r.label") == 0).alias("clean"), F.count_if(F.col("r.label") == 1).alias("toxic")).collect()
    out: dict[str, Counts] = {}
    for r in found:
        out.setdefault(r.lang, {})[r.bin] = (r.clean, r.toxic)
    return out


def fitted(docs: DataFrame, labels: DataFrame, most: int = 3000) -> tuple[Model, dict[str, float]]:
    """Trained on at most about 2 * most labelled rows outside the held fold, chosen by the hash of doc_id.

    Middle and thresholds are placed on all labelled rows of the second fold, at any size; where
    none are or one label lacks there, on the sample that the model was trained on.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = labelled(docs, labels, "toxic", FOLDS, HELD, most, [F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"), _second().alias("fold")]).collect()
    rows.sort(key=lambda r: r.doc_id)
    label = np.array([r._label for r in rows], dtype=np.float32)
    # the rarer label weighs more, up to threefold, so that few toxic rows still teach
    share = label.mean() if len(label) else 0.5
    weight = np.where(label == 1, np.clip((1 - share) / max(share, 1e-6), 1, 3), 1).astype(np.float32)
    model, own = train([r.text for r in rows], label, [r.lang for r in rows], np.array([r.fold for r in rows], dtype=np.int64), weight)
    if not own:
        return model, {}
    every = counted(docs, labels, model)
    both = np.array([n for c in every.values() for n in c.values()]).reshape(-1, 2).sum(axis=0)
    return model, placed(model, every if both.all() else own)


def _scorer(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            out = np.zeros(len(batch))
            for low, block in blocks(batch.column(1), lower=True, word_bytes=ALNUM):
                z = logits(model, *padded(buckets(block.hashes()), block.first))
                out[low : low + len(block)] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out)], names=["doc_id", "lang", "score"])

    return score


def _binned(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            out = np.zeros(len(batch), dtype=np.int64)
            for low, block in blocks(batch.column(1), lower=True, word_bytes=ALNUM):
                out[low : low + len(block)] = bins_of(logits(model, *padded(buckets(block.hashes()), block.first)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out)], names=["doc_id", "lang", "bin"])

    return score


def scored(docs: DataFrame, labels: DataFrame, most: int = 3000) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted (score >= 0.5), flagged.

    flagged holds the score against its language's threshold, 0.5 for languages without one. Whole
    texts are scored; null and empty texts get the score of no words. Null doc_ids are not held
    out; repeated rows score alike; extra columns are ignored; an empty table gives no rows.
    """
    model, thresholds = fitted(docs, labels, most)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lang.alias("lang"))
    out = rows.mapInArrow(_scorer(sent), "doc_id long, lang string, score double")
    limit = F.lit(0.5)
    for name, value in sorted(thresholds.items()):
        limit = F.when(F.col("lang") == name, F.lit(value)).otherwise(limit)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= limit).alias("flagged"))
