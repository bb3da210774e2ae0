"""Token sequences as length-delimited binary records with masked checksums and an offset index.

A frame is: payload length (uint64), masked checksum of those eight bytes (uint32), payload,
masked checksum of the payload (uint32), all little-endian. A checksum is zlib's CRC-32, masked as
rotate right by 15 bits plus 0xA282EAD8, so that checksums of data that hold checksums stay good.
A payload is: doc_id (int64), 1 if doc_id is null (uint8), bytes per id (uint8), then the ids.
Beside each data file lies an index file: the offset (uint64) of each frame, in order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import saved, scratch
from tidemark.llm.tokens import END_ID, encoder, vocabulary

HEAD, LENGTH, CHECK = "<qBB", "<Q", "<I"
MASK_DELTA = 0xA282EAD8
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(LENGTH, len(payload))
    return b"".join((length, struct.pack(CHECK, masked(length)), payload, struct.pack(CHECK, masked(payload))))


def read_frame(file) -> bytes | None:
    """The next payload of an open file, None at its end; ValueError where a checksum is wrong."""
    head = file.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack(CHECK, head[8:])[0] != masked(head[:8]):
        raise ValueError("a record's length is damaged")
    size = struct.unpack(LENGTH, head[:8])[0]
    body = file.read(size + 4)
    if len(body) < size + 4 or struct.unpack(CHECK, body[size:])[0] != masked(body[:size]):
        raise ValueError("a record's data is damaged")
    return body[:size]


def payload(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack(HEAD, doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def parsed(data: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = struct.unpack_from(HEAD, data)
    return None if null else doc_id, np.frombuffer(data, dtype=f"<u{width}", offset=struct.calcsize(HEAD))


#: Schemes of Hadoop's file systems and what Arrow calls the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss", "file": "file"}


def uri_of(path: str) -> str:
    """A shared folder as Arrow names it; a ValueError where it has no name for the scheme."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return path
    if scheme.lower() not in SCHEMES:
        raise ValueError(f"records can't be written to {scheme}: its files can't be opened outside Spark; set spark.checkpoint.dir to one of {', '.join(sorted(SCHEMES))}")
    return f"{SCHEMES[scheme.lower()]}:{rest}"


def store_of(path: str):
    """The file system of a shared folder (local, HDFS or object store) and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri_of(path))


def _writer(folder: str, vocab: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(vocab)
        width = 2 if max(made.size - 1, end_id) < 1 << 16 else 4
        store, base = store_of(folder)
        name = uuid.uuid4().hex  # a second attempt writes another file; only what is returned counts
        store.create_dir(base, recursive=True)
        records = tokens = at = 0
        first: tuple[int | None, int] = (None, 0)
        with store.open_output_stream(f"{base}/{name}.records") as out, store.open_output_stream(f"{base}/{name}.index") as index:
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                order = batch.column(2).to_pylist()
                for i, ids in made.encode(batch.column(1)):
                    ids = np.append(ids, np.uint32(end_id))
                    data = frame(payload(doc_ids[i], ids, width))
                    if not records:
                        first = (doc_ids[i], order[i])
                    index.write(struct.pack(LENGTH, at))
                    out.write(data)
                    at, records, tokens = at + len(data), records + 1, tokens + len(ids)
        made.finished()
        if records:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([records], pa.int64()), pa.array([tokens], pa.int64()), pa.array([at], pa.int64()), pa.array([first[0]], pa.int64()), pa.array([first[1]], pa.int64())],
                names=["file", "records", "tokens", "bytes", "first_doc", "first_order"],
            )

    return write


#: Bytes of text that one task writes to one file, about.
RANGE_BYTES = 256 << 20


def ranges(docs: DataFrame) -> int:
    """How many ranges of doc_ids to write: as many as Spark shuffles to, or more, so that a range has about RANGE_BYTES."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))


def write_records(docs: DataFrame, folder: str, vocab: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Tokenize whole texts and write them to folder in ascending doc_id order; returns the manifest.

    The manifest has a row for each file, in no order: file, records, tokens, bytes, first_doc,
    first_order. Null texts are empty, null doc_ids come first, rows of one doc_id follow the hash
    of their text; extra columns are ignored; an empty table has no file. One range shuffle by
    doc_id puts texts in order, and each task streams its range to one file, so nothing is held
    whole. A task that runs again writes another file, and only returned files are listed.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_order", F.xxhash64("text"))
    placed = rows.repartitionByRange(ranges(docs), "doc_id", "_order").sortWithinPartitions("doc_id", "_order")
    listed = placed.mapInArrow(_writer(folder, vocab or vocabulary(), end_id), "file string, records long, tokens long, bytes long, first_doc long, first_order long")
    return saved(listed, folder, "manifest")


def in_order(manifest: DataFrame) -> DataFrame:
    """The manifest with start, the ids in all files before: one row for each file, so a window over all of them is small."""
    before = Window.orderBy(F.asc_nulls_first("first_doc"), "first_order").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record of the manifest's files; checks all checksums."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                with store.open_input_stream(f"{base}/{name}.records", buffer_size=1 << 20) as file:
                    while (data := read_frame(file)) is not None:
                        doc_id, ids = parsed(data)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _table(rows)
                            rows = []
                if rows:
                    yield _table(rows)

    n = max(1, manifest.count())  # a task for each file
    return in_order(manifest).select("file", "start").repartition(n).mapInArrow(read, ROWS)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_at(folder: str, name: str, numbers: list[int]) -> Iterator[tuple[int | None, np.ndarray]]:
    """Records of one file by number, in the order asked for, through its index: a shuffled read."""
    store, base = store_of(folder)
    with store.open_input_file(f"{base}/{name}.index") as index, store.open_input_file(f"{base}/{name}.records") as file:
        for k in numbers:
            index.seek(8 * k)
            file.seek(struct.unpack(LENGTH, index.read(8))[0])
            yield parsed(read_frame(file))


def round_trip(docs: DataFrame, vocab: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write docs as records to shared scratch space and return what reading them back gives.

    One row per document row: doc_id, start (ids of all documents before it in doc_id order),
    n_tokens with the end id, ids_crc32. Edge cases as in write_records.
    """
    folder = scratch(docs.sparkSession, "records")
    return read_records(write_records(docs, folder, vocab, end_id), folder)
