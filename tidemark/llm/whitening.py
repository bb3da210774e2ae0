"""Whitening of vectors from an exact scatter matrix, which tasks compute in residues.

An entry c becomes the whole number x = floor(64 c) + 1000000. A sum of products of such numbers
over a large table fits no machine word and loses its last digits in doubles. So each task
multiplies its rows modulo several primes below 2^20: a product of residues is below 2^40, and
8192 of them add up exactly in a double, so the matrix product is the ordinary fast one. Sums of
residues are added over tasks by Spark; the Chinese remainder theorem gives the exact scatter from
(d + 1)^2 sums for each prime. Means, covariance and eigenvectors follow from it, once, on the
driver, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import saved, scratch
from tidemark.llm.vectors import matrix, of_one_size, whole_numbers

#: Residues are below 2^20 and CHUNK is 2^13, so that sums of products stay below 2^53.
BITS, CHUNK = 20, 1 << 13
#: Scaled entries are held within this; larger ones have no use in an embedding.
MOST = 1 << 40
ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def primes(bound: int) -> list[int]:
    """The largest primes below 2^BITS, as many as make a product above bound."""
    sieve = np.ones(1 << BITS, dtype=bool)
    sieve[:2] = False
    for i in range(2, 1 << (BITS // 2)):
        if sieve[i]:
            sieve[i * i :: i] = False
    out, product = [], 1
    for p in np.flatnonzero(sieve)[::-1].tolist():
        if product > bound:
            break
        out.append(p)
        product *= p
    return out


def modular_scatter(x: np.ndarray, p: int) -> np.ndarray:
    """The sum over rows of the outer products of (1, x), modulo p, exactly."""
    d = x.shape[1] + 1
    total = np.zeros((d, d), dtype=np.int64)
    for low in range(0, len(x), CHUNK):
        part = np.ones((min(CHUNK, len(x) - low), d))
        part[:, 1:] = x[low : low + CHUNK] % p
        total = (total + (part.T @ part).astype(np.int64)) % p
    return total


def reconstructed(residues: list[int], moduli: list[int]) -> int:
    """The number nearest zero that has these residues."""
    value, product = 0, 1
    for r, p in zip(residues, moduli, strict=True):
        value += product * ((r - value) * pow(product, -1, p) % p)
        product *= p
    return value - product if 2 * value > product else value


def _scatterer(d: int, moduli: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(moduli), d + 1, d + 1), dtype=np.int64)
        seen = 0
        for batch in batches:
            x = matrix(batch.column(0), d)
            seen += len(x)
            for k, p in enumerate(moduli):
                totals[k] = (totals[k] + modular_scatter(x, p)) % p
        if seen:
            i, j = np.triu_indices(d + 1)
            for k in range(len(moduli)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), k, dtype=np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(totals[k][i, j])], names=["k", "i", "j", "v"])

    return scatter


def exact_scatter(fit: DataFrame, d: int, n: int, most: int) -> list[list[int]]:
    """The scatter of (1, x) over the rows of fit, of column x, as whole numbers: its first row is n and the sums.

    n: rows at most; most: the largest absolute entry. The driver gets a row for each prime and
    pair of dimensions.
    """
    moduli = primes(2 * max(n, 1) * max(most, 1) ** 2)
    sums = fit.select("x").mapInArrow(_scatterer(d, moduli), "k int, i int, j int, v long").groupBy("i", "j", "k").agg(F.sum("v").alias("v"))
    found = {(r.i, r.j, r.k): r.v for r in sums.collect()}
    out = [[0] * (d + 1) for _ in range(d + 1)]
    for i in range(d + 1):
        for j in range(i, d + 1):
            out[i][j] = out[j][i] = reconstructed([found.get((i, j, k), 0) % p for k, p in enumerate(moduli)], moduli)
    return out


def components(scatter: list[list[int]], most: int) -> tuple[int, list[int], np.ndarray, np.ndarray, np.ndarray]:
    """n, the sums, unit eigenvectors as columns, eigenvalues falling, and their shares of the trace.

    A direction along which the rows don't differ can't be scaled to variance 1 and is left out.
    The largest entry of a vector is positive.
    """
    n, sums = scatter[0][0], scatter[0][1:]
    d = len(sums)
    if n < 2:
        return n, sums, np.zeros((d, 0)), np.zeros(0), np.zeros(0)
    centred = [[n * scatter[i + 1][j + 1] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    v = np.array([[c / (n * n) for c in row] for row in centred])  # of whole numbers, rounded once
    trace = sum(centred[i][i] for i in range(d)) / (n * n)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = np.flatnonzero(values > max(values[0], 0) * d * 1e-14)[:most]
    values, vectors = values[kept], vectors[:, kept]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(kept))] < 0, -1.0, 1.0)
    return n, sums, vectors, values, values / trace if trace else values


def _deviations(x: np.ndarray, n: int, sums: list[int], most: int) -> tuple[np.ndarray, list[int | None]]:
    """n * x - sums as doubles, and the sums of its squares: exact, null where beyond a long."""
    d = len(sums)
    if d * (2 * n * max(most, 1)) ** 2 < 1 << 63:
        whole = n * x - np.array(sums, dtype=np.int64)
        return whole.astype(np.float64), (whole * whole).sum(axis=1).tolist()
    whole = n * x.astype(object) - np.array(sums, dtype=object)
    squares = (whole * whole).sum(axis=1).tolist()
    return whole.astype(np.float64), [s if s < 1 << 63 else None for s in squares]


def whitened(rows: DataFrame, most: int = 16, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row per row with a whole, finite vector and component 1 to most: see ROWS.

    The fit list is each distinct x once, so copies of one vector weigh as one; whitened is the
    row's centred x along a component over the root of its eigenvalue; deviation is the exact sum
    over dimensions of (n x - sum)^2, null where it is beyond a long; identity_error is the largest
    absolute entry of the fit list's covariance of whitened minus the identity.

    Null, non-finite and empty vectors are left out, and so are vectors of another size than most
    have. Null ids and repeated rows are projected like others; extra columns are ignored. Fewer
    than two distinct vectors, or an empty table, give no rows; of vectors that differ in fewer
    directions than most, only these are components.
    """
    spark = rows.sparkSession
    named = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("_vector"))
    whole, d, count, top = of_one_size(whole_numbers(named, "_vector", scale, shift, MOST))
    empty = spark.createDataFrame([], ROWS)
    if not d:
        return empty
    folder = scratch(spark, "whitening")
    fit = saved(whole.select("x").distinct(), folder, "fit")
    n, sums, vectors, values, shares = components(exact_scatter(fit, d, count, top), most)
    k = len(values)
    if not k:
        return empty
    scaled = vectors / np.sqrt(values)

    def project(x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        apart, squares = _deviations(x, n, sums, top)
        return (apart / n) @ scaled, squares

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w, _ = project(matrix(batch.column(0), d))
            w = np.hstack([np.ones((len(w), 1)), w])
            total += w.T @ w
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "v"])

    sums_of = fit.mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    gram = np.zeros((k + 1, k + 1))
    for r in sums_of:
        gram[r.i, r.j] = r.v / n
    error = float(np.abs(gram[1:, 1:] - np.outer(gram[0, 1:], gram[0, 1:]) - np.eye(k)).max())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                part = batch.slice(low, CHUNK)
                w, squares = project(matrix(part.column(1), d))
                m = len(w)
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(squares, pa.int64()).take(at), pa.array(w.ravel()), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return whole.select("vec_id", "x").mapInArrow(write, ROWS)
