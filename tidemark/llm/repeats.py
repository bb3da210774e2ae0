"""Removal of long repeats: every byte covered by a string of LENGTH bytes that also starts earlier.

Windows of LENGTH bytes are dealt to anchors: the window's least gram of GRAM bytes by hash, of equal
ones the leftmost. Equal windows have the same anchor at the same place in them, so every window is
compared with all that could equal it where its anchor's occurrences meet. The windows of one
anchor in one text are a piece of it; a piece that stands somewhere earlier as a whole is a repeat,
and one copy of each piece stands for all. Anchors with differing pieces go to run-length indexes
(run_index.py) over the bytes of their pieces, which find the parts that they share. An anchor with
very many pieces, such as one in a very common line, has its pieces cut into single windows, which
are then dealt by the hash of the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import run_index
from tidemark.llm.store import saved, scratch
from tidemark.llm.words import _power, blocks, mixed, released, whole_texts

LENGTH, GRAM = 100, 20
#: Pieces of an anchor beyond which they are cut into windows; bytes that one index holds, about; rows gathered before copies within a task are taken out.
MANY, INDEXED, GATHERED = 4096, 1 << 21, 1 << 19
#: A place in a text, in one long: 24 bits of the text's checksum, offset (31), windows (7).
TIE, OFFSET, COUNT = 38, 7, 127
ROWS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
PIECES = "anchor long, piece long, doc long, at long, sure boolean"


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, text as given, doc (its order; null ids last) and tie (texts of one id follow their checksum)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tie = F.crc32(text.cast("binary")).bitwiseAND(0x7FFFFF) + F.when(F.col("doc_id").isNull(), F.lit(0x800000)).otherwise(0)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("doc_id", "text", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), tie.cast("long").alias("tie"))


def pieces(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of texts that lie in data between offsets: text, start, windows, anchor's hash and piece's hash of every piece."""
    width, n = length - gram + 1, len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < length or width > COUNT:
        return none, none, none, none, none
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", n)[:n], out=total[1:])
    down = _power("down", n)
    grams = mixed((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    rows = -(-len(grams) // width)
    key = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    key[: len(grams)] = grams
    low = np.uint64(COUNT)
    key = ((key & ~low).reshape(rows, width)) | np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(key, axis=1).ravel()
    behind = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - length + 1)
    left, right = behind[: len(starts)], ahead[width - 1 : width - 1 + len(starts)]
    base = starts // width * width
    first = (left >> np.uint64(7)) <= (right >> np.uint64(7))
    later = (starts + width - 1) // width * width
    anchor = np.where(first, base + (left & low).astype(np.int64), later + (right & low).astype(np.int64))
    text_of = np.searchsorted(offsets, starts, side="right") - 1
    whole = np.flatnonzero(starts + length <= offsets[text_of + 1])
    if not len(whole):
        return none, none, none, none, none
    held = anchor[whole]
    heads = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    begin = whole[heads]
    windows = np.diff(np.append(heads, len(whole)))
    end = begin + windows - 1 + length
    hashes = mixed(mixed((total[end] - total[begin]) * down[begin]) ^ windows.astype(np.uint64))
    text = text_of[begin]
    return text, begin - offsets[text], windows, grams[held[heads]].view(np.int64), hashes.view(np.int64)


def once(anchor: np.ndarray, piece: np.ndarray, doc: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Rows of PIECES: the first of each piece by place, and every other one as sure, under a key of its own."""
    order = np.lexsort((at, doc, piece, anchor))
    anchor, piece, doc, at = anchor[order], piece[order], doc[order], at[order]
    head = np.ones(len(order), dtype=bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(head)[np.cumsum(head) - 1] if len(head) else order
    same = (doc == doc[first]) & (at == at[first])  # the first, or a repeated row of it
    sure = ~same
    own = mixed(at.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ doc.view(np.uint64)).view(np.int64)
    kept = head | sure
    return pa.RecordBatch.from_arrays([pa.array(np.where(sure, own, anchor)[kept]), pa.array(np.where(sure, own, piece)[kept]), pa.array(doc[kept]), pa.array(at[kept]), pa.array(sure[kept])], names=["anchor", "piece", "doc", "at", "sure"])


def _gathered(parts: Iterator[tuple[np.ndarray, ...]], most: int) -> Iterator[pa.RecordBatch]:
    """once() over (anchor, piece, doc, at) arrays, a bounded number of rows at a time."""
    have, size = [], 0
    for part in parts:
        have.append(part)
        size += len(part[0])
        if size >= most:
            yield once(*map(np.concatenate, zip(*have, strict=True)))
            have, size = [], 0
    if size:
        yield once(*map(np.concatenate, zip(*have, strict=True)))
    released()


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _cutter(most: int) -> Batches:
    """(text, doc, tie) rows to PIECES."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            doc, tie = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            for low, block in blocks(batch.column(0), 1 << 19):
                text, start, windows, anchor, piece = pieces(block.data, block.offsets)
                if len(text):
                    yield anchor, piece, doc[low + text], (tie[low + text] << TIE) | (start << OFFSET) | windows

    return lambda batches: _gathered(cut(batches), most)


def judged(rows: DataFrame, many: int) -> DataFrame:
    """PIECES with kind: 'whole' (stands earlier), 'some' (shares its anchor with other pieces), 'many' (of more than many rows); unique ones left out."""
    by_anchor, by_piece = Window.partitionBy("anchor"), Window.partitionBy("anchor", "piece")
    met = rows.withColumn("n", F.count(F.lit(1)).over(by_anchor)).withColumn("differ", F.min("piece").over(by_anchor) != F.max("piece").over(by_anchor)).where((F.col("n") > 1) | F.col("sure"))
    first = F.min(F.struct("doc", "at")).over(by_piece)
    kind = F.when(F.col("sure") | (F.struct("doc", "at") > F.col("first")), "whole").when(~F.col("differ"), "one").when(F.col("n") > many, "many").otherwise("some")
    return met.withColumn("first", first).withColumn("kind", kind).where(F.col("kind") != "one").select(F.when(F.col("kind") != "whole", F.col("anchor")).alias("anchor"), "doc", "at", "kind")


def _asked(found: DataFrame, texts: DataFrame, kind: str) -> DataFrame:
    """Texts that hold pieces of a kind: text, doc, tie and the pieces' anchors and places."""
    asked = found.where(F.col("kind") == kind).groupBy("doc", F.shiftright("at", TIE).alias("tie")).agg(F.collect_set(F.struct("anchor", "at")).alias("asked"))
    return texts.select("text", "doc", "tie").join(asked, ["doc", "tie"]).select("text", "doc", "tie", "asked")


def _each(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, np.ndarray, np.ndarray]]:
    data, offsets = whole_texts(batch.column(0))
    raw, docs = data.tobytes(), batch.column(1).to_pylist()
    for i in range(batch.num_rows):
        rows = batch.column(3)[i].values
        yield raw[offsets[i] : offsets[i + 1]], docs[i], np.asarray(rows.field("anchor")), np.asarray(rows.field("at"))


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, doc, anchors, at in _each(batch):
            starts = (at >> OFFSET) & ((1 << 31) - 1)
            ends = starts + (at & COUNT) - 1 + LENGTH
            strings = [text[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(np.full(len(at), doc, dtype=np.int64)), pa.array(at), pa.array(strings, pa.binary())], names=["anchor", "doc", "at", "bytes"])


def _window_cutter(most: int) -> Batches:
    """Single windows of the asked pieces as PIECES, whose anchor and piece are two hashes of the window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for text, doc, _, at in _each(batch):
                data = np.frombuffer(text, dtype=np.uint8)
                total = np.zeros(len(data) + 1, dtype=np.uint64)
                np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", len(data))[: len(data)], out=total[1:])
                down = _power("down", len(data) + 1)
                count = at & COUNT
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat((at >> OFFSET) & ((1 << 31) - 1), count) + step
                value = (total[start + LENGTH] - total[start]) * down[start]
                half = (total[start + LENGTH // 2] - total[start]) * down[start]
                yield mixed(value).view(np.int64), mixed(mixed(half) ^ value).view(np.int64), np.full(len(start), doc, dtype=np.int64), np.repeat(at >> TIE << TIE, count) | (start << OFFSET) | 1

    return lambda batches: _gathered(cut(batches), most)


def promising(strings: list[bytes], anchors: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Which pieces may share a window with another piece of their anchor.

    A shared window begins before the anchor by `side` bytes or more, and then those agree, or it
    begins later, and then length - side bytes from the anchor on agree. Either stretch is compared by hash.
    """
    side = (length - gram) // 2
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    ends = np.cumsum(lengths)
    starts, data = ends - lengths, np.frombuffer(b"".join(strings), dtype=np.uint8)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", len(data))[: len(data)], out=total[1:])
    down = _power("down", len(data) + 1)
    string = np.repeat(np.arange(len(strings)), lengths)[: len(data) - gram + 1]
    found = np.flatnonzero(mixed((total[gram:] - total[:-gram]) * down[: len(string)]).view(np.int64) == anchors[string])
    at = np.full(len(strings), -1)
    held, first = np.unique(string[found], return_index=True)
    at[held] = found[first]
    out = at < 0  # never so; such a piece would be kept
    for low, high in ((at - side, at + gram), (at, at + length - side)):
        fits = np.flatnonzero((at >= 0) & (low >= starts) & (high <= ends))
        value = mixed((total[high[fits]] - total[low[fits]]) * down[low[fits]]) ^ anchors[fits].view(np.uint64)
        _, which, count = np.unique(value, return_inverse=True, return_counts=True)
        out[fits[count[which] > 1]] = True
    return out


def _marks(strings: list[bytes], anchors: np.ndarray, doc: np.ndarray, at: np.ndarray) -> pa.RecordBatch | None:
    """(doc, at) of stretches of windows that stand earlier among the strings, by their run-length index."""
    kept = np.flatnonzero(promising(strings, anchors))
    strings, doc, at = [strings[i] for i in kept.tolist()], doc[kept], at[kept]
    if not strings:
        return None
    _, group = np.unique(np.stack([doc, at >> TIE]), axis=1, return_inverse=True)
    string, offset = run_index.repeated(strings, (at >> OFFSET) & ((1 << 31) - 1), group.ravel(), LENGTH)
    if not len(string):
        return None
    heads = np.flatnonzero(np.concatenate([[True], (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)]))
    windows = np.diff(np.append(heads, len(string)))
    string, offset = string[heads], offset[heads]
    start = ((at[string] >> OFFSET) & ((1 << 31) - 1)) + offset
    return pa.RecordBatch.from_arrays([pa.array(doc[string]), pa.array((at[string] >> TIE << TIE) | (start << OFFSET) | windows)], names=["doc", "at"])


def _indexer(most: int) -> Batches:
    """Rows (anchor, doc, at, bytes) in order of anchor: an index for each stretch of whole anchors of about most bytes."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: list[bytes] = []
        rows: list[list[int]] = [[], [], []]
        size = 0

        def done() -> Iterator[pa.RecordBatch]:
            marks = _marks(strings, *(np.array(x, dtype=np.int64) for x in rows)) if strings else None
            if marks:
                yield marks

        for batch in batches:
            for string, *row in zip(batch.column(3).to_pylist(), *(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if size >= most and row[0] != rows[0][-1]:
                    yield from done()
                    strings, rows, size = [], [[], [], []], 0
                strings.append(string)
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
                size += len(string) + 1
        yield from done()
        released()

    return index


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = whole_texts(batch.column(1))
        raw = data.tobytes()
        sizes, removed, spans, digests = [], [], [], []
        for i in range(batch.num_rows):
            text = raw[offsets[i] : offsets[i + 1]]
            marks = batch.column(2)[i].values
            gone, runs, kept, begin, end = 0, 0, hashlib.sha256(), 0, 0
            if marks is not None and len(marks):
                at = np.sort(np.asarray(marks) & ((1 << TIE) - 1))
                start = at >> OFFSET
                reach = np.maximum.accumulate(start + (at & COUNT) - 1 + LENGTH)
                heads = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
                for s, e in zip(start[heads].tolist(), reach[np.append(heads[1:] - 1, len(start) - 1)].tolist(), strict=True):
                    kept.update(text[end:s])
                    gone, runs, end = gone + e - s, runs + 1, e
            kept.update(text[end:])
            sizes.append(len(text))
            removed.append(gone)
            spans.append(runs)
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeat_marks(texts: DataFrame, folder: str, many: int = MANY, indexed: int = INDEXED, gathered: int = GATHERED) -> DataFrame:
    """(doc, at) of stretches of windows of placed texts that also start earlier; every such window is in one at least."""
    found = saved(judged(texts.select("text", "doc", "tie").mapInArrow(_cutter(gathered), PIECES), many), folder, "found")
    asked = _asked(found, texts, "some").mapInArrow(_bytes_of, "anchor long, doc long, at long, bytes binary").dropDuplicates(["anchor", "doc", "at"])
    shared = asked.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_indexer(indexed), "doc long, at long")
    single = judged(_asked(found, texts, "many").mapInArrow(_window_cutter(gathered), PIECES), many)
    whole = [x.where(F.col("kind") == "whole").select("doc", "at") for x in (found, single)]
    return whole[0].unionByName(saved(shared.unionByName(whole[1]), folder, "marks"))


def without_repeats(docs: DataFrame, many: int = MANY, indexed: int = INDEXED, gathered: int = GATHERED) -> DataFrame:
    """One row per row of docs (doc_id, text): see ROWS; what a text keeps is its bytes outside all repeats.

    A byte goes if a string of LENGTH bytes around it also starts earlier: in a document of smaller
    doc_id, or before it in the same one. Strings are judged on the whole input, and never cross
    documents. Null and empty texts have no bytes, and shorter texts than LENGTH lose none. Null
    doc_ids come last. Rows of one doc_id with different texts follow their texts' checksum (24
    bits of it); repeated rows of one doc_id and text are one document, and each gets its result.
    Extra columns are ignored; an empty table gives no rows. many, indexed and gathered bound what a
    task holds and change no result.
    """
    texts = placed(docs)
    marks = repeat_marks(texts, scratch(docs.sparkSession, "repeats"), many, indexed, gathered)
    per_text = marks.groupBy("doc", F.shiftright("at", TIE).alias("tie")).agg(F.collect_list("at").alias("marks"))
    return texts.join(per_text, ["doc", "tie"], "left").select("doc_id", "text", "marks").mapInArrow(_covered, ROWS)
