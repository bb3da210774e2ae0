import io
import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from .support import ODD, empty, odd, prose, table

from tidemark.llm import packing, records
from tidemark.llm.store import scratch
from tidemark.llm.tokens import WordEncoder, vocabulary


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids_of(text):
    return np.array(library().encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")


def test_encoder_equals_the_library():
    draw = random.Random(5)
    pieces = ["It's", "we're!!", "12,34", "a.b.c", "<|endoftext|>", "É́", "K", "\x00b", "don't.", "I'LL", "ΑΣ.", "　y", "!?", "x'", "-", "ﬁ", "İ", "http://a.b/c?d=e", "\n", "  "]
    texts = [None, "", " "] + ["".join(draw.choice(pieces) + draw.choice(["", " "]) for _ in range(draw.randrange(60))) for _ in range(300)]
    made = WordEncoder(vocabulary(), most=50)
    for _ in range(2):
        got = dict(made.encode(pa.array(texts)))
        for i, t in enumerate(texts):
            assert got[i].tolist() == ids_of(t).tolist()[:-1]


def test_frames_find_damage():
    data = records.frame(records.payload(7, np.array([1, 2, 70000], dtype=np.uint32), 4))
    assert records.parsed(records.read_frame(io.BytesIO(data)))[1].tolist() == [1, 2, 70000]
    assert records.parsed(records.payload(None, np.array([3]), 2))[0] is None
    for k in range(len(data)):
        bad = bytearray(data)
        bad[k] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(bad)))


def test_round_trip(spark):
    docs = odd(spark)
    rows = records.round_trip(docs).collect()
    assert len(rows) == docs.count()
    ordered = sorted(rows, key=lambda r: r.start)
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id is None for r in ordered] == [True] + [False] * (len(rows) - 1)
    assert [r.doc_id for r in ordered[1:]] == sorted(r.doc_id for r in ordered[1:])
    for r in rows:
        if r.doc_id:
            want = ids_of(ODD[r.doc_id - 1])
            assert (r.n_tokens, r.ids_crc32) == (len(want), zlib.crc32(want.tobytes()))
    assert records.round_trip(empty(spark)).count() == 0


def test_index_reads_in_any_order(spark):
    folder = scratch(spark, "records")
    texts = [prose(k, 5 + k) for k in range(20)]
    file = records.in_order(records.write_records(table(spark, texts).coalesce(1), folder).where("records > 3")).first()
    first = file.first_doc
    picks = [2, 0, file.records - 1, 1, 2]
    got = list(records.read_at(folder, file.file, picks))
    assert [d for d, _ in got] == [first + k for k in picks]
    assert all((ids == ids_of(texts[d - 1])).all() for d, ids in got)


def test_shared_folders_by_the_names_that_arrow_has():
    assert [records.uri_of(x) for x in ("s3a://b/x:y", "S3N://b", "file:///tmp/a", "/tmp/a", "hdfs://h:1/x", "abfss://c@a/x", "gcs://b")] == ["s3://b/x:y", "s3://b", "file:///tmp/a", "/tmp/a", "hdfs://h:1/x", "abfss://c@a/x", "gs://b"]
    with pytest.raises(ValueError, match="oss"):
        records.uri_of("oss://b/x")


def test_ranges_follow_the_bytes(spark, monkeypatch):
    docs = table(spark, [prose(k, 50) for k in range(40)])
    few = records.ranges(docs)
    monkeypatch.setattr(records, "RANGE_BYTES", 500)
    assert records.ranges(docs) > few == records.ranges(docs.limit(0))
    assert records.round_trip(docs).agg({"n_tokens": "sum"}).first()[0] == sum(len(ids_of(prose(k, 50))) for k in range(40))


def test_packing_covers_every_id_once(spark):
    docs = odd(spark).where("doc_id IS NOT NULL").unionByName(table(spark, [prose(k, 10 + 7 * k) for k in range(60)], 100)).dropDuplicates(["doc_id"])
    rows = packing.pack(docs, 128).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = ids_of(texts[r.doc_id])
        assert r.doc_tokens == len(ids)
        part = ids[r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids_of(texts[doc]))
    assert set(pieces) == set(texts) and sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(r.length for r in rows)
    assert total / (128 * len(sequences)) > 0.98
    whole = packing.sequences(packing.pack(docs, 128), packing.pieces(docs, 128, with_ids=True)).collect()
    assert sum(len(r.ids) for r in whole) == total


def test_packing_takes_repeated_and_null_rows(spark):
    assert sum(r.start == 0 for r in packing.pack(odd(spark), 64).collect()) == odd(spark).count()
    assert packing.pack(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_the_whole_histogram(seed):
    draw = random.Random(seed)
    histogram = {draw.randrange(1, 65): draw.randrange(1, 500) for _ in range(20)}
    patterns = packing.plan(histogram, 64)
    placed = defaultdict(int)
    for pattern, count in patterns:
        assert sum(n * k for n, k in pattern) <= 64
        for n, k in pattern:
            placed[n] += k * count
    assert dict(placed) == histogram
    ranks = defaultdict(list)
    for length, low, high, *_ in packing.slots(patterns):
        ranks[length].append((low, high))
    for length, parts in ranks.items():
        at = 0
        for low, high in parts:
            assert low == at
            at = high
        assert at == histogram[length]
