"""Hard negatives by exact search over inverted lists, visited by a bound on their scores.

Rows belong to the nearest of at most LISTS centroids, which are fitted on a bounded sample. A list
stores its centroid c and its radius r, the largest distance of a row from c. By Cauchy-Schwarz a
row's score with an anchor a lies within a.c - |a| r and a.c + |a| r. An anchor visits lists in
falling order of the upper bound, in rounds of growing size; it passes over lists whose range
misses its windows of wanted scores, and is done when the upper bound falls strictly below the
k-th score that it has. So the result is that of comparing all pairs. Lists are kept in chunks of
bounded size, dealt by hash, so that a list that holds most rows is many units of work. Blocks of
anchors meet chunks by a shuffle and a sort; neither is ever broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import saved, scratch
from tidemark.llm.vectors import matrix, of_one_size, whole_numbers

#: Lists; entries of the sample that centroids are fitted on; rows of a chunk, about; anchors of a block.
LISTS, SAMPLE_ENTRIES, CHUNK, BLOCK = 64, 1 << 20, 8192, 256
#: Places in the order of bounds at which a round ends.
ROUNDS = (4, 16, LISTS)
#: Scaled components are held within this, so that scores of up to 512 of them are longs.
MOST = 1 << 27
ROWS = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOR_ALL, FOR_NONE = (-(1 << 62), 1 << 62), (1, 0)


def centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's method from the first rows of the sample, which is in random order; empty lists keep their place."""
    made = sample[: max(1, min(lists, len(sample) // 8))].astype(np.float64)
    for _ in range(rounds):
        near = nearest(sample, made)
        sums = np.zeros_like(made)
        np.add.at(sums, near, sample)
        sizes = np.bincount(near, minlength=len(made))
        made = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], made)
    return made


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * (x.astype(np.float64) @ centres.T)).argmin(axis=1)


def _assigner(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), centres.shape[1])
            near = nearest(x, centres)
            far = np.sqrt(((x - centres[near]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(far)], names=[*batch.schema.names, "list", "far"])

    return assign


def bounds(a: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each row of a with any row of each list, with room for rounding."""
    a = a.astype(np.float64)
    middle, reach = a @ centres.T, np.sqrt((a * a).sum(axis=1))[:, None] * radii
    room = 1 + 1e-9 * (np.abs(middle) + reach)
    return middle - reach - room, middle + reach + room


def wanted(low: np.ndarray, high: np.ndarray, begin: int, end: int, least: np.ndarray, most: np.ndarray, kth: np.ndarray) -> np.ndarray:
    """Which lists (columns) an anchor (row) visits at places begin to end of the falling order of high.

    least, most and kth have a column for each window of scores; kth is -inf until k rows are found.
    """
    place = np.empty(high.shape, dtype=np.int64)
    np.put_along_axis(place, np.argsort(-high, axis=1, kind="stable"), np.arange(high.shape[1])[None, :].repeat(len(high), axis=0), axis=1)
    asked = np.zeros(high.shape, dtype=bool)
    for w in range(least.shape[1]):
        floor = np.maximum(least[:, w], kth[:, w])[:, None]
        asked |= (high >= floor) & (low <= most[:, w, None]) & (least[:, w] <= most[:, w])[:, None]
    return asked & (place >= begin) & (place < end)


def _router(centres: np.ndarray, radii: np.ndarray, chunks: list[int], begin: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                low, high = bounds(matrix(batch.column(2), centres.shape[1]), centres, radii)
                windows = len(batch.column(3)[0])
                least, most = (matrix(batch.column(i), windows).astype(np.float64) for i in (3, 4))
                kth = np.array([[-np.inf if v is None else v for v in row] for row in batch.column(5).to_pylist()], dtype=np.float64)
                asked = wanted(low, high, begin, end, least, most, kth)
                for k in np.flatnonzero(asked.any(axis=0)).tolist():
                    part = batch.take(pa.array(np.flatnonzero(asked[:, k])))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema) as out:
                        out.write_batch(part)
                    n = chunks[k]
                    yield pa.RecordBatch.from_arrays([pa.array([k] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([sink.getvalue().to_pybytes()] * n, pa.binary())], names=["list", "chunk", "asked"])

    return route


def best(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k largest fitting scores of each row; of equal ones, the first columns."""
    scores = np.where(fits, scores, np.iinfo(np.int64).min)
    rows, columns, every = [], [], np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        top = scores.argmax(axis=1)
        have = scores[every, top] > np.iinfo(np.int64).min
        if not have.any():
            break
        rows.append(every[have])
        columns.append(top[have])
        scores[every, top] = np.iinfo(np.int64).min
    return (np.concatenate(rows), np.concatenate(columns)) if rows else (np.zeros(0, dtype=np.int64),) * 2


def _scorer(d: int, exact: bool, same: bool, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = held = None
        for batch in batches:
            chunks = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for i, chunk in enumerate(chunks):
                if batch.column(3)[i].is_valid:  # comes before those that ask for it
                    rows = batch.column(3)[i].values
                    ids = rows.field("vec_id")
                    order = np.lexsort((np.asarray(ids.fill_null(0)), np.asarray(ids.is_null())))
                    at, held = chunk, (ids.take(pa.array(order)), np.asarray(rows.field("key"))[order], np.asarray(rows.field("label"))[order], matrix(rows.field("x"), d)[order])
                    continue
                if at != chunk:  # no row of the list is in this chunk
                    continue
                asked, (ids, keys, labels, x) = pa.ipc.open_stream(batch.column(2)[i].as_py()).read_next_batch(), held
                a = matrix(asked.column(2), d)
                scores = (a.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else a @ x.T
                fits = (np.asarray(asked.column(1))[:, None] == labels) == same
                fits &= np.asarray(asked.column(0))[:, None] != keys
                least, most = (matrix(asked.column(j), len(asked.column(3)[0])) for j in (3, 4))
                for w in range(least.shape[1]):
                    r, c = best(scores, fits & (scores >= least[:, w, None]) & (scores <= most[:, w, None]), k)
                    if len(r):
                        yield pa.RecordBatch.from_arrays([asked.column(0).take(pa.array(r)), pa.array(np.full(len(r), w, dtype=np.int32)), pa.array(scores[r, c]), ids.take(pa.array(c))], names=["key", "w", "score", "vec_id"])

    return score


class Lists:
    """Inverted lists of rows (vec_id, label, x, key) with centroids, radii and sizes; all in shared scratch tables."""

    def __init__(self, rows: DataFrame, d: int, top: int, folder: str):
        self.d, self.folder, self.exact = d, folder, d * top * top < 1 << 53
        sample = rows.select("x").orderBy(F.xxhash64("key", F.lit(1)), "key").limit(max(8, SAMPLE_ENTRIES // d))
        self.centres = centroids(matrix(sample.toArrow().column(0).combine_chunks(), d), LISTS)
        fields = "vec_id long, label long, x array<long>, key long, list int, far double"
        self.rows = saved(rows.select("vec_id", "label", "x", "key").mapInArrow(_assigner(self.centres), fields), folder, "assigned")
        found = {r.list: r for r in self.rows.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
        self.radii = np.array([found[k].far if k in found else 0.0 for k in range(len(self.centres))])
        self.chunks = [-(-found[k].n // CHUNK) if k in found else 0 for k in range(len(self.centres))]
        parts = F.element_at(F.array(*[F.lit(max(1, n)).cast("long") for n in self.chunks]), F.col("list") + 1)
        packed = self.rows.withColumn("chunk", F.pmod("key", parts)).groupBy("list", "chunk").agg(F.collect_list(F.struct("vec_id", "label", "x", "key")).alias("rows"))
        self.packed = saved(packed, folder, "lists")

    def _meeting(self, routed: DataFrame) -> DataFrame:
        """Chunks and the blocks of anchors that ask for them, each chunk just before its blocks, in one shuffle.

        Not a join: Spark takes the blocks for as small as the anchors, of which each chunk has a
        copy, and would broadcast them through the driver; a join would also pass a whole chunk on
        with each block.
        """
        blocks = routed.withColumn("rows", F.lit(None).cast(self.packed.schema["rows"].dataType))
        every = self.packed.select("list", "chunk", F.lit(None).cast("binary").alias("asked"), "rows").unionByName(blocks)
        return every.repartition("list", "chunk").sortWithinPartitions("list", "chunk", F.col("asked").isNotNull())

    def search(self, queries: DataFrame, windows: int, same: bool, k: int, name: str) -> DataFrame:
        """The first k rows for each query and window by falling score, then vec_id: key, w, place (from 1), score, vec_id.

        queries: key, label, x, least and most (arrays of windows scores, within which a row's score
        must lie). Rows must have the query's label if same, else another; the query's own row doesn't count.
        """
        hits, begin = None, 0
        for end in ROUNDS:
            if begin >= len(self.centres):
                break
            kth = F.array(*[F.lit(None).cast("long")] * windows)
            asked = queries.select("key", "label", "x", "least", "most", kth.alias("kth"))
            if hits is not None:
                full = hits.groupBy("key", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") == k)
                full = full.groupBy("key").agg(*[F.max(F.when(F.col("w") == w, F.col("s"))).alias(f"_{w}") for w in range(windows)])
                asked = queries.join(full, "key", "left").select("key", "label", "x", "least", "most", F.array(*[F.col(f"_{w}") for w in range(windows)]).alias("kth"))
            routed = asked.mapInArrow(_router(self.centres, self.radii, self.chunks, begin, end), "list int, chunk long, asked binary")
            scored = self._meeting(routed).mapInArrow(_scorer(self.d, self.exact, same, k), "key long, w int, score long, vec_id long")
            every = scored if hits is None else scored.unionByName(hits.select("key", "w", "score", "vec_id"))
            ordered = Window.partitionBy("key", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
            hits = saved(every.withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= k), self.folder, f"{name}-{end}")
            begin = end
        return hits


def mined(rows: DataFrame, anchors: F.Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """Hard negatives of the rows (vec_id, label, vector) for which anchors holds: see ROWS.

    A component becomes floor(scale * component); a score is the whole inner product with the
    anchor. An anchor's positives are the first rows of its label by falling score, then vec_id;
    for each, the first rows of other labels whose score is within low to high percent of the
    positive's are its negatives, ranked from 1. Positives without negatives have no row.

    Rows with a null label, or a null, empty, or not wholly finite vector take no part, nor do
    vectors of another size than most have. A row that is repeated in vec_id, label and vector
    counts once; different rows of one vec_id all count. A row without vec_id is no anchor and comes
    last among equal scores. Extra columns are ignored; an empty table gives no rows.
    """
    spark = rows.sparkSession
    named = rows.where(F.col("label").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vector).alias("_vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    whole, d, _, top = of_one_size(whole_numbers(named, "_vector", scale, 0, MOST))
    if not d:
        return spark.createDataFrame([], ROWS)
    folder = scratch(spark, "negatives")
    whole = whole.groupBy("vec_id", "label", "x").agg(F.max("asks").alias("asks")).withColumn("key", F.xxhash64("vec_id", "label", "x"))
    lists = Lists(whole, d, top, folder)
    asking = saved(whole.where("asks").select("key", "vec_id", "label", "x"), folder, "anchors")
    bound = lambda pair, i, n: F.array(*[F.lit(pair[i]).cast("long")] * n)
    near = lists.search(asking.withColumn("least", bound(FOR_ALL, 0, 1)).withColumn("most", bound(FOR_ALL, 1, 1)), 1, True, positives, "positives")
    near = near.select("key", (F.col("place") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    divided = lambda p: f"(positive_score * {p} - pmod(positive_score * {p}, 100L)) div 100"  # noqa: E731  rounded down
    edges = near.withColumn("least", F.expr(f"-({divided(-low)})")).withColumn("most", F.expr(divided(high)))
    of = lambda name, w, other: F.coalesce(F.max(F.when(F.col("w") == w, F.col(name))), F.lit(other).cast("long"))
    edges = edges.groupBy("key").agg(F.array(*[of("least", w, FOR_NONE[0]) for w in range(positives)]).alias("least"), F.array(*[of("most", w, FOR_NONE[1]) for w in range(positives)]).alias("most"))
    found = lists.search(asking.join(edges, "key"), positives, False, negatives, "negatives")
    found = found.join(near, ["key", "w"]).join(asking.select("key", F.col("vec_id").alias("anchor_id")), "key")
    return found.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
