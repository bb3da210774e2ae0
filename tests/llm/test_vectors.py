"""Whitening and hard negatives against plain loops over exact numbers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, list string, n long"


def vectors(spark, rows):
    """An embeddings table of (vec_id, vector, label), with columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, "x", "l", 1) for r in rows], SCHEMA)


def drawn(n, d, seed, spread=1.0):
    """n vectors of dimensions with differing spread, in singles as the table has them."""
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, d)) * np.linspace(0.2, spread, d)).astype(np.float32).tolist()


def whole(vector, scale, shift=0):
    return [math.floor(scale * float(np.float32(c))) + shift for c in vector]


def plain_fit(listed):
    """n, sums and covariance of distinct whole-number vectors, as fractions."""
    n, d = len(listed), len(listed[0])
    sums = [sum(x[i] for x in listed) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    return n, sums, [[sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in listed) / n for j in range(d)] for i in range(d)]


def test_whitened_rows_have_unit_covariance_and_exact_deviations(spark):
    made = drawn(150, 6, 1)
    rows = [(i, v, 0) for i, v in enumerate(made)] + [(None, made[0], 1)] + [(500 + i, made[3], None) for i in range(80)]
    odd = [(900, None, 0), (901, [], 0), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (903, [float("nan")] * 6, 0), (904, [float("inf")] + [0.0] * 5, 0), (905, [1.0], 0)]
    got = whitening.whitened(vectors(spark, rows + odd), most=4).collect()
    listed = sorted({tuple(whole(v, 64, 1_000_000)) for v in made})
    n, sums, v = plain_fit(listed)
    values, axes = np.linalg.eigh(np.array(v, dtype=float))
    trace = float(sum(v[i][i] for i in range(6)))
    assert len(got) == 4 * len(rows) and {r.vec_id for r in got} == {r[0] for r in rows}
    by = {(r.vec_id, r.component): r for r in got}
    signs = {}
    for vec_id, vector, _ in rows:
        x = whole(vector, 64, 1_000_000)
        for c in range(1, 5):
            r = by[vec_id, c]
            assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            assert r.explained == pytest.approx(values[-c] / trace, rel=1e-9) and r.identity_error < 1e-9
            want = sum(float(Fraction(n * a - s, n)) * q for a, s, q in zip(x, sums, axes[:, -c], strict=True)) / math.sqrt(values[-c])
            signs.setdefault(c, 1 if want * r.whitened > 0 else -1)
            assert r.whitened == pytest.approx(signs[c] * want, rel=1e-9, abs=1e-9)


def test_few_directions_and_empty_tables(spark):
    assert whitening.whitened(vectors(spark, [(1, [1.0], 0)]).limit(0)).collect() == []
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0], 0)] * 9)).collect() == []  # one distinct vector
    line = whitening.whitened(vectors(spark, [(i, [float(i), 2.0 * i, 5.0], 0) for i in range(10)])).collect()
    assert {r.component for r in line} == {1} and len(line) == 10 and line[0].explained == pytest.approx(1)


def test_huge_entries_are_exact_or_null(spark):
    rows = [(0, [3e37, 1.0], 0), (1, [-2.0, 4.0], 0), (2, [0.5, -1e9], 0)]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2} and all(r.deviation is None or r.deviation >= 0 for r in got)


def test_residues_give_the_exact_scatter():
    draw = random.Random(3)
    x = np.array([[draw.randrange(-(10**9), 10**9) for _ in range(3)] for _ in range(20_000)], dtype=np.int64)
    moduli = whitening.primes(2 * len(x) * 10**18)
    parts = [(whitening.modular_scatter(x[:7000], p) + whitening.modular_scatter(x[7000:], p)) for p in moduli]
    ones = np.hstack([np.ones((len(x), 1), dtype=object), x.astype(object)])
    for i in range(4):
        for j in range(4):
            want = int((ones[:, i] * ones[:, j]).sum())
            assert whitening.reconstructed([int(part[i, j]) % p for part, p in zip(parts, moduli, strict=True)], moduli) == want
    assert all(p < 1 << whitening.BITS and all(p % q for q in range(2, 1025)) for p in moduli)


def plain_negatives(rows, asks, positives=5, negatives=3):
    """All pairs, by plain loops: rows are (vec_id, whole vector, label), each once."""
    last = lambda r: (r[0] is None, r[0] or 0)
    out = []
    for a in rows:
        if not asks(a[0]):
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[1], b[1], strict=True)), b) for b in rows if b is not a), key=lambda t: (-t[0], last(t[1])))
        for score, p in [t for t in scored if t[1][2] == a[2]][:positives]:
            fitting = [t for t in scored if t[1][2] != a[2] and 50 * score <= 100 * t[0] <= 95 * score]
            out += [(a[0], p[0], i + 1, b[0], score, s) for i, (s, b) in enumerate(fitting[:negatives])]
    return out


@pytest.mark.parametrize("sizes", [(64, 8192), (5, 40)])
def test_negatives_equal_all_pairs(spark, monkeypatch, sizes):
    for name, value in zip(("LISTS", "CHUNK"), sizes, strict=True):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives, "ROUNDS", (1, 3, 64))
    made = drawn(40, 8, 5)
    draw = random.Random(6)
    rows = [(i, [c + draw.gauss(0, 0.2) for c in made[i % 40]], i % 3) for i in range(260)]
    rows += [(1000 + i, made[0], 1) for i in range(60)]  # one vector in many rows: ties by vec_id
    rows += [(None, made[0], 2), (1007, made[2], 2)]
    rows = [(i, np.array(v, dtype=np.float32).tolist(), label) for i, v, label in rows]
    odd = [(2000, None, 0), (2010, made[1], None), (2020, [1.0, None] + [0.0] * 6, 1), (2030, [float("nan")] * 8, 1), (2040, [1.0], 1), rows[3], rows[3]]
    got = hard_negatives.mined(vectors(spark, rows + odd), F.col("vec_id") % 10 == 0).collect()
    want = plain_negatives([(i, whole(v, 256), label) for i, v, label in rows], lambda i: i is not None and i % 10 == 0)
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert len(want) > 100 and sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_negatives_of_empty_tables_and_of_lone_labels(spark):
    every = F.lit(True)
    assert hard_negatives.mined(vectors(spark, [(1, [1.0], 0)]).limit(0), every).collect() == []
    assert hard_negatives.mined(vectors(spark, [(1, [1.0], 0), (2, [1.0], 1)]), every).collect() == []
    assert hard_negatives.mined(vectors(spark, [(1, [3e38], 0), (2, [2e38], 0), (3, [4.0], 1)]), every).collect() == []


def test_blocks_of_anchors_and_chunks_are_not_broadcast(spark, monkeypatch):
    plans, kept = [], hard_negatives.saved
    monkeypatch.setattr(hard_negatives, "saved", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, *a))
    monkeypatch.setattr(hard_negatives, "ROUNDS", (64,))  # no later round, whose few k-th scores may be broadcast
    hard_negatives.mined(vectors(spark, [(i, v, i % 3) for i, v in enumerate(drawn(60, 8, 3))]), F.col("vec_id") % 10 == 0).collect()
    rounds = [p for p in plans if p.count("MapInArrow") == 2]
    below = [p.partition("BroadcastExchange")[2] for p in rounds]
    assert len(rounds) == 2 and not any("MapInArrow" in p for p in below)


def test_lists_beyond_the_bound_and_outside_the_window_are_not_visited():
    low, high = np.array([[0.0, 5.0, 40.0]]), np.array([[10.0, 20.0, 60.0]])
    one = lambda x: np.array([[x]], dtype=float)
    asked = lambda least, most, kth, end=3: hard_negatives.wanted(low, high, 0, end, one(least), one(most), one(kth))[0].tolist()
    assert asked(-99, 99, -np.inf) == [True, True, True] and asked(-99, 99, -np.inf, 1) == [False, False, True]
    assert asked(-99, 99, 20) == [False, True, True]  # a bound equal to the k-th score may hold a tie
    assert asked(-99, 99, 20.5) == [False, False, True] and asked(8, 30, -np.inf) == [True, True, False] and asked(1, 0, -np.inf) == [False] * 3


def test_bounds_hold_for_every_row_of_a_list():
    x = (np.array(drawn(500, 8, 9)) * 256).astype(np.int64)
    centres = hard_negatives.centroids(x, 6)
    near = hard_negatives.nearest(x, centres)
    radii = np.array([np.sqrt(((x[near == k] - centres[k]) ** 2).sum(axis=1)).max() for k in range(6)])
    low, high = hard_negatives.bounds(x[:50], centres, radii)
    scores = x[:50] @ x.T
    assert all((low[:, near[j]] <= scores[:, j]).all() and (scores[:, j] <= high[:, near[j]]).all() for j in range(500))
