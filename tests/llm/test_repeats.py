"""Long repeats and their run-length index against plain loops."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import repeats, run_index

from .support import ODD, empty, odd, prose, table


def plain(texts, length=100):
    """[(n_bytes, n_removed, n_spans, kept_sha256)] of texts in order, by a set of all windows seen."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(window)
        runs = sum(1 for i in range(len(raw)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return out


def mixed_texts(seed, n):
    """Texts that share passages of many lengths around the least, at odd places, with edits and runs of one letter."""
    draw = random.Random(seed)
    passages = [prose(seed + k, 40) for k in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            p = draw.choice(passages).encode()
            a = draw.randrange(len(p) // 2)
            parts.append(p[a : a + draw.choice((60, 98, 99, 100, 101, 130, 400))].decode(errors="ignore"))
            parts.append("".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(80))))
        out.append("".join(parts))
    return out + ["é" * 300, "a" * 350, "ab" * 200, "a" * 99, "x" + "a" * 100, out[0], out[0] + "!", "\x00" * 120]


@pytest.mark.parametrize("limits", [(4096, 1 << 22, 1 << 20), (2, 500, 300)])
def test_every_repeat_and_nothing_else(spark, limits):
    texts = mixed_texts(1, 60) + ODD
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(table(spark, texts).repartition(7), *limits).collect()}
    assert [got[i + 1] for i in range(len(texts))] == plain(texts)


def test_odd_rows(spark):
    rows = {(r.doc_id, r.n_bytes): r for r in repeats.without_repeats(odd(spark)).collect()}
    first = rows[6, len(ODD[5].encode())]  # the row is there twice, as one document
    assert first.n_removed == 0 and rows[7, first.n_bytes].n_removed == first.n_bytes
    assert all(r.kept_sha256 == hashlib.sha256(b"").hexdigest() for r in rows.values() if r.n_bytes == r.n_removed)
    assert len(repeats.without_repeats(odd(spark)).collect()) == len(ODD) + 2
    assert repeats.without_repeats(empty(spark)).collect() == []


def test_null_ids_come_last_and_texts_of_one_id_do_not_mix(spark):
    same = prose(4, 60)
    docs = spark.createDataFrame([(None, same, 1), (9, same, 1), (3, same + "!", 1), (3, "other " * 30, 1)], "doc_id long, text string, at int")
    rows = {(r.doc_id, r.n_bytes): r.n_removed for r in repeats.without_repeats(docs).collect()}
    n = len(same.encode())
    assert rows == {(None, n): n, (9, n): n, (3, n + 1): 0, (3, 180): plain(["other " * 30])[0][1]}


@pytest.mark.parametrize("seed", range(8))
def test_index_equals_sorted_suffixes(seed):
    draw = random.Random(seed)
    strings = [bytes(draw.choice(b"ab") for _ in range(draw.randrange(1, 60))) * draw.randrange(1, 4) for _ in range(12)]
    index = run_index.RunIndex.of(strings)
    text, starts = run_index.joined(strings)
    place = {s + k: (i, k) for i, s in enumerate(starts.tolist()) for k in range(len(strings[i]) + 1)}
    order = sorted(range(len(text)), key=lambda p: (strings[place[p][0]][place[p][1] :], place[p][0]))
    before = [text[p - 1] if place[p][1] else 0 for p in order]
    assert np.repeat(index.letters, index.lengths).tolist() == before
    assert all(a != b or not b for a, b in zip(index.letters[:-1].tolist(), index.letters[1:].tolist(), strict=True))
    common = lambda p, q: next((k for k in range(99) if k >= min(len(strings[place[p][0]]) - place[p][1], len(strings[place[q][0]]) - place[q][1]) or text[p + k] != text[q + k]), 99)
    want = {(p, q) for q, p in zip(order[:-1], order[1:], strict=True) if common(p, q) >= 5}
    at, source = index.matching_statistics(5)
    assert set(zip(at.tolist(), source.tolist(), strict=True)) == want and len(at) == len(want)


def test_pieces_hold_every_window_once_and_equal_windows_meet():
    texts = [t.encode() for t in mixed_texts(3, 30)]
    data, offsets = np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    seen, windows = {}, 0
    for text, start, n, anchor, _ in zip(*repeats.pieces(data, offsets), strict=True):
        for s in range(start, start + n):
            window = texts[text][s : s + 100]
            assert len(window) == 100 and seen.setdefault(window, anchor) == anchor
        windows += n
    assert windows == sum(max(0, len(t) - 99) for t in texts)
