"""Packing token sequences: longest lengths first into the shortest packs, over a length histogram."""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import ranked, saved, scratch
from tidemark.llm.tokens import END_ID, encoder, vocabulary

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cutter(vocab: str, end_id: int, size: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(vocab)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            parts: list[np.ndarray] = []
            for i, ids in made.encode(batch.column(1)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for low in range(0, len(ids), size):
                    part = ids[low : low + size]
                    rows.append((doc_ids[i], low, len(part), zlib.crc32(part.tobytes()), len(ids)))
                    if with_ids:
                        parts.append(part)
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array([p.view("<i4") for p in parts], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        made.finished()

    return cut


def pieces(docs: DataFrame, size: int = 2048, vocab: str | None = None, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every document's ids and end id, cut at each multiple of size; the last piece may be shorter."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_cutter(vocab or vocabulary(), end_id, size, with_ids), PIECES + (", ids array<int>" if with_ids else ""))


def plan(histogram: dict[int, int], size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Packing patterns [(length, copies), ...] and how many packs follow each.

    Lengths are placed longest first, each into the packs that are shortest so far, one to a pack;
    what fits nowhere opens packs that hold as many copies of the length as they can. The histogram
    has at most `size` lengths, so this is small however many documents there are.
    """
    packs: dict[int, list[tuple[tuple, int]]] = {}  # by room left: patterns and counts
    rooms: list[int] = []

    def add(room: int, pattern: tuple, count: int) -> None:
        if room not in packs:
            packs[room] = []
            heapq.heappush(rooms, -room)
        packs[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and rooms and -rooms[0] >= length:
            room = -rooms[0]
            pattern, count = packs[room].pop()
            if not packs[room]:
                del packs[room]
                heapq.heappop(rooms)
            used = min(left, count)
            if used < count:
                add(room, pattern, count - used)
            same = pattern and pattern[-1][0] == length
            grown = (*pattern[:-1], (length, pattern[-1][1] + 1)) if same else (*pattern, (length, 1))
            add(room - length, grown, used)
            left -= used
        each = size // length
        if left // each:
            add(size - each * length, ((length, each),), left // each)
        if left % each:
            add(size - left % each * length, ((length, left % each),), 1)
    return [(list(p), n) for room in sorted(packs) for p, n in packs[room]]


def slots(patterns: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, lowest rank, rank after the last, first sequence, copies, offset): which ranks go where."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, count in patterns:
        at = 0
        for length, copies in pattern:
            low = rank.get(length, 0)
            rank[length] = low + count * copies
            out.append((length, low, low + count * copies, sequence, copies, at))
            at += length * copies
        sequence += count
    return out


def pack(docs: DataFrame, size: int = 2048, vocab: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pack all documents into sequences of at most size ids.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    Null and empty texts have the end id alone; null doc_ids and repeated rows are packed like
    others; extra columns are ignored; an empty table gives no rows. Only the histogram (at most
    size rows) and the patterns made from it reach the driver. Pieces of a length are ranked in
    hash buckets, so a length that a third of all pieces share is no single task, and patterns are
    joined back by rank.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "packing")
    cut = saved(pieces(docs, size, vocab, end_id), folder, "pieces")
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = slots(plan(histogram, size))
    if not where:
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    table = spark.createDataFrame(where, "_length long, _low long, _high long, _first long, _copies long, _at long")
    order = [F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    buckets = max(64, math.isqrt(max(histogram.values())))  # so that neither a bucket nor the table of their counts grows large
    rank = ranked(cut, ["length"], F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)), order, "_rank", folder)
    joined = rank.join(F.broadcast(table), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")))
    number = F.col("_rank") - F.col("_low")
    return joined.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_first") + F.floor(number / F.col("_copies"))).cast("long").alias("sequence_id"),
        (F.col("_at") + F.pmod(number, F.col("_copies")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame, parts: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from pack()'s rows and pieces(..., with_ids=True).

    doc_id must be unique. A sequence has at most `size` ids, so no group grows with the corpus.
    """
    both = packed.join(parts.select("doc_id", "start", "ids"), ["doc_id", "start"])
    held = both.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
    return held.select("sequence_id", F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids"))
