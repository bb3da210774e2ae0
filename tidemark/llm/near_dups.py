"""Near duplicates: MinHash bands, sequential Bayesian pruning of signatures, exact verification.

Rows with one set of shingles form a class, and only classes are compared, so exact copies cost
nothing however many there are. Classes that share a band key are candidates:

- In a bucket of few classes all pairs are. Pairs whose signatures, compared batch by batch, leave
  less than MISS posterior probability of reaching the threshold go; the rest is verified on full
  sets.
- Larger buckets that share classes form one set, and each class of it is paired with one leader,
  the class in the most of these buckets. What differs between a class and its leader, D, then
  gives the pairs that are left. Two classes x and y link if the symmetric difference of D(x) and
  D(y) has at most a * (|x| + |y|) elements, a = (1 - t) / (1 + t). If at least one of them isn't
  linked with the leader L, D(x) and D(y) must overlap, by at least
      (|D(x)| + a * (|L| - |x|)) / 2  for any x that meets an unlinked one, and
      (|D(y)| - a * (|y| + |L|)) / (1 + a)  for an unlinked y that meets a linked one
  elements, and any two by at least |D(x)| - |x| * (1 - t) / t, as their sizes can't differ more. So,
  in one order of all elements, their prefixes share an element, with enough elements from there on
  in both. The order puts first what is rare in the differences of a sample of the leader's classes:
  a sample changes how many prefixes meet, not which links are found. By the triangle inequality of
  the Jaccard distance an unlinked y beyond twice the threshold's distance meets no linked one.

Elements of prefixes are the keys of the next level's buckets, which are treated in the same way:
pairs within small ones, a leader for the larger ones. Classes of one component aren't paired again,
so a bucket counts as small if few of its classes are outside its largest component. A class has one
leader a level, so a level writes a few elements a class. Elements that classes share are the new
leader's too and so leave their D; what is small doubles at each level besides, so levels end soon.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import dropped, saved, scratch
from tidemark.llm.words import Block, blocks, mixed, released, shingles

BANDS, BAND_ROWS = 25, 5
BATCH = 25
MISS = 1e-6
#: Classes of a bucket outside its largest component up to which all pairs are taken: of band keys,
#: and of elements (twice as many at each further level).
FEW, FEW_ELEMENTS = 15, 64
SIZE = BANDS * BAND_ROWS
#: Keys of dropped rows up to which they are broadcast (about 64 MB), and bytes of leaders' sets.
MOST_BROADCAST = 2_000_000
MOST_LEADER_BYTES = 32 << 20
#: Classes of a leader, about, whose differences put elements in order.
SAMPLE = 64
#: Pairs that a worker turns into Python objects at once.
SLICE = 512


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64)


def shingle_sets(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text of a block, sorted within it, and where each begins."""
    values, begins = shingles(block.hashes(), block.first, k)
    sets = [np.unique(values[begins[i] : begins[i + 1]]) for i in range(len(block))]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else values), starts


def _class_keys(sets: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    """16 bytes for each set, equal for equal sets; None for an empty one."""
    full = np.flatnonzero(np.diff(starts))
    out: list[bytes | None] = [None] * (len(starts) - 1)
    if len(full):
        halves = np.stack([np.add.reduceat(mixed(sets ^ np.uint64(c)), starts[full]) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)], axis=1)
        for i, row in zip(full.tolist(), halves, strict=True):
            out[i] = row.tobytes()
    return out


def signatures(sets: np.ndarray, starts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """MinHash values (uint32) of each set, `size` to a row; of an empty one all ones."""
    out = np.full((len(starts) - 1, size), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        at, odd, add = starts[full], _random(1, size) | np.uint64(1), _random(2, size)
        for p in range(size):
            out[full, p] = np.minimum.reduceat(((sets * odd[p] + add[p]) >> np.uint64(32)).astype(np.uint32), at)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature; bands don't share keys."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS).astype(np.uint64)
    total = np.zeros(parts.shape[:2], dtype=np.uint64) + _random(3, BANDS)
    for j, f in enumerate(_random(4, BAND_ROWS) | np.uint64(1)):
        total = mixed(total + parts[:, :, j] * f)
    return total.view(np.int64)


def least_matches(threshold: float, miss: float, batch: int = BATCH, size: int = SIZE) -> list[int]:
    """For each batch end, how many of the values so far must match for the posterior to leave `miss`.

    Matches are binomial in the similarity, which has a uniform prior.
    """
    x = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(batch, size + 1, batch):
        for m in range(n + 1):
            log = m * np.log(x) + (n - m) * np.log1p(-x)
            weight = np.exp(log - log.max())
            if weight[x >= threshold].sum() / weight.sum() >= miss:
                break
        out.append(m)
    return out


def _signer(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, block in blocks(batch.column(2), lower=True):
                sets, starts = shingle_sets(block, k)
                signature = signatures(sets, starts)
                keys = band_keys(signature)
                n = np.diff(starts)
                full = n > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(low, len(block)) for c in (0, 1)],
                        pa.array(n, pa.int64()),
                        pa.array(_class_keys(sets, starts), pa.binary()),
                        pa.array([s.tobytes() if f else None for s, f in zip(signature, full, strict=True)], pa.binary()),
                        pa.array([x if f else None for x, f in zip(keys, full, strict=True)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "digest", "sig", "keys"],
                )
        released()

    return sign


def _setter(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, block in blocks(batch.column(2), lower=True):
                sets, starts = shingle_sets(block, k)
                keys = _class_keys(sets, starts)
                rows = [(numbers[low + i], sets[starts[i] : starts[i + 1]].tobytes()) for i in range(len(block)) if keys[i] is not None and keys[i] == wanted[low + i]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["cls", "shingles"])
        released()

    return found


def _rows_of(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's values as one array of dtype, without a copy, and where each row's begin."""
    size = np.dtype(dtype).itemsize
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1] // size if len(column) else np.zeros(1, dtype=np.int32)
    return np.frombuffer(data, dtype=dtype, count=data.size // size) if data is not None else np.zeros(0, dtype=dtype), starts


def _pruner(threshold: float, miss: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    least = least_matches(threshold, miss)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_rows_of(batch.column(c), np.uint32) for c in (2, 3))
            a, b = (v[s[0] : s[-1]].reshape(-1, SIZE) for v, s in (x, y))
            left = np.arange(len(a))
            matched = np.zeros(len(a), dtype=np.int64)
            for j, m in enumerate(least):  # each batch is compared only for the pairs still open
                part = slice(j * BATCH, (j + 1) * BATCH)
                for low in range(0, len(left), 4096):
                    rows = left[low : low + 4096]
                    matched[rows] += (a[rows, part] == b[rows, part]).sum(axis=1)
                left = left[matched[left] >= m]
            kept = pa.array(left)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], names=["a", "b"])
        released()

    return prune


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a leader, its set and sets of its classes: the elements in several differences, and in how many."""
    for batch in batches:
        for i in range(len(batch)):
            own = np.frombuffer(batch.column(1)[i].as_py(), dtype=np.uint64)
            parts = [np.setxor1d(own, np.frombuffer(x.as_py(), dtype=np.uint64), assume_unique=True) for x in batch.column(2)[i].values or ()]
            values, counts = np.unique(np.concatenate([*parts, own[:0]]), return_counts=True)
            several = counts > 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).slice(i, 1) for c in (0, 1)], pa.array([values[several].tobytes()], pa.binary()), pa.array([counts[several].astype(np.uint32).tobytes()], pa.binary())],
                names=["cls", "shingles", "common", "counts"],
            )
    released()


def _frequency(d: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each element was counted; 0 if once at most."""
    if not len(common):
        return np.zeros(len(d), dtype=np.uint32)
    at = np.minimum(np.searchsorted(common, d), len(common) - 1)
    return np.where(common[at] == d, counts[at], 0)


def _linked(x: int, y: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (x + y - both)


def _verifier(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From a, b, led (b is a's leader), both sets and counts: linked, and for led pairs a's prefix of D.

    The first `short` elements of the prefix meet all others, the rest only those of linked classes;
    d is the size of D and n that of a.
    """
    t = percent / 100
    alpha = (1 - t) / (1 + t)

    def compared(x: np.ndarray, y: np.ndarray, led: bool, common: np.ndarray, counts: np.ndarray) -> tuple:
        both = np.intersect1d(x, y, assume_unique=True)
        n, m, k = len(x), len(y), len(both)
        link = _linked(n, m, k, percent)
        if not led:
            return link, None, 0, 0, n
        d = np.concatenate([np.setdiff1d(x, both, assume_unique=True), np.setdiff1d(y, both, assume_unique=True)])
        d = d[np.lexsort((d, _frequency(d, common, counts)))].view(np.int64)

        def prefix(overlap: float) -> int:
            return len(d) - max(1, int(np.ceil(max(overlap, len(d) - n * (1 - t) / t) - 1e-6))) + 1

        first = last = prefix((len(d) + alpha * (m - n)) / 2)
        union = n + m - k
        if not link and union - k <= 2 * (1 - t) * union + 1e-6:
            last = prefix((len(d) - alpha * (n + m)) / (1 + alpha))
        return link, d[: max(0, first, last)], first, len(d), n

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.bool_(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            led = batch.column(2).to_pylist()
            (x, xs), (y, ys), (common, cs) = (_rows_of(batch.column(c), np.uint64) for c in (3, 4, 5))
            counts, ns = _rows_of(batch.column(6), np.uint32)
            for low in range(0, len(led), SLICE):
                rows = range(low, min(low + SLICE, len(led)))
                got = [compared(x[xs[i] : xs[i + 1]], y[ys[i] : ys[i + 1]], led[i], common[cs[i] : cs[i + 1]], counts[ns[i] : ns[i + 1]]) for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(low, len(rows)) for c in (0, 1)], *[pa.array(c, t) for c, t in zip(zip(*got, strict=True), types, strict=True)]],
                    names=["a", "b", "linked", "prefix", "short", "d", "n"],
                )
        released()

    return verify


def components(links: DataFrame, folder: str) -> DataFrame:
    """node and comp, the smallest node of its component, for every node of links (a, b).

    Each round takes the smallest label among a node's neighbours and then that label's own label,
    so long chains shrink fast. Labels are written each round; counts alone reach the driver.
    """
    both = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), folder, "edges")
    labels = saved(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), folder, "labels-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.withColumnsRenamed({"node": "b", "comp": "c"}), "b").groupBy("a").agg(F.min("c").alias("c"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", F.least("comp", "c").alias("comp"), F.col("comp").alias("old"))
        low = saved(low, folder, f"low-{turn}")
        jump = low.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = saved(low.join(jump, "comp").select("node", F.least("comp", "up").alias("comp"), "old"), folder, f"labels-{turn}")
        if not new.where(F.col("comp") != F.col("old")).limit(1).count():
            return new.select("node", "comp")
        dropped(links.sparkSession, f"{folder}/labels-{turn - 1}")
        dropped(links.sparkSession, f"{folder}/low-{turn}")
        labels = new.select("node", "comp")


def joined_components(comps: DataFrame | None, links: DataFrame, folder: str) -> DataFrame:
    """node and comp as components() gives them for all earlier links (of comps) and these further ones.

    Links within a component say nothing new. Those between components, a few, are links of their
    labels, and only these are solved; every other component stays as it is.
    """
    if comps is None:
        return components(links, folder)
    for end in ("a", "b"):
        links = links.join(comps.withColumnsRenamed({"node": end, "comp": "_c"}), end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    between = saved(links.where("a <> b").select("a", "b").distinct(), folder, "between")
    if not between.limit(1).count():
        return comps
    solved = components(between, folder)
    moved = comps.join(solved.select(F.col("node").alias("comp"), F.col("comp").alias("_c")), "comp", "left").select("node", F.coalesce("_c", "comp").alias("comp"))
    fresh = solved.join(comps.select("node"), "node", "left_anti").select("node", "comp")  # classes that had no link before
    return saved(moved.unionByName(fresh), folder, "moved")


def _paired(buckets: DataFrame, comps: DataFrame | None, few: int, percent: int, folder: str) -> tuple[DataFrame, DataFrame | None]:
    """Pairs (a, b) of small buckets, and pairs (a, its leader b) of large ones, None without any.

    A bucket is small if at most `few` of its classes are outside the component that has the most
    of them: pairs within a component are settled, so a small bucket of n classes gives few * n
    pairs at most. buckets: key and cls, and for keys that are elements also role (1 for those that
    only meet a linked class's), linked, place of the element in D, d and n. Band keys promise
    nothing. Sizes are written before they are joined, so that a hot key's rows can be split
    between tasks.
    """
    if comps is None:
        sizes = buckets.groupBy("key").agg((F.count(F.lit(1)) - 1).alias("outside"), F.max("cls").alias("main"))
        buckets = buckets.withColumns({"comp": F.col("cls"), "role": F.lit(0), "linked": F.lit(False), **{c: F.lit(0).cast("long") for c in ("place", "d", "n")}})
    else:
        buckets = saved(buckets.join(comps.withColumnsRenamed({"node": "cls"}), "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), folder, "buckets")
        parts = buckets.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
        sizes = parts.groupBy("key").agg((F.sum("n") - F.max("n")).alias("outside"), F.max(F.struct("n", "comp"))["comp"].alias("main"))
    sizes = saved(sizes.where("outside > 0"), folder, "sizes")
    rows = saved(buckets.join(sizes, "key"), folder, "rows")
    small = rows.where(F.col("outside") <= few)
    other = small.select("key", *[F.col(c).alias(f"_{c}") for c in ("cls", "role", "linked", "comp", "place", "d", "n")])
    once = (F.col("_comp") == F.col("main")) | (F.col("cls") < F.col("_cls"))
    meet = (F.col("role") + F.col("_role") == 0) | ((F.col("role") + F.col("_role") == 1) & (F.col("linked") != F.col("_linked")))
    # what D(x) and D(y) can still share from this element on must be enough
    common = F.least(F.col("d") - F.col("place"), F.col("_d") - F.col("_place"))
    enough = (100 + percent) * (F.col("d") + F.col("_d") - 2 * common) <= (100 - percent) * (F.col("n") + F.col("_n"))
    pairs = small.where(F.col("comp") != F.col("main")).join(other, "key").where((F.col("comp") != F.col("_comp")) & once & meet & enough)
    pairs = saved(pairs.select(F.least("cls", "_cls").alias("a"), F.greatest("cls", "_cls").alias("b")).distinct(), folder, "pairs")
    large = rows.where(F.col("outside") > few).select("key", "cls", "outside")
    if not large.limit(1).count():
        return pairs, None
    lowest = saved(large.groupBy("key").agg(F.min("cls").alias("b")), folder, "lowest")
    together = components(large.join(lowest, "key").where("cls <> b").select(F.col("cls").alias("a"), "b"), f"{folder}/sets")
    fame = saved(large.groupBy("cls").agg(F.sum("outside").alias("fame")), folder, "fame")
    famous = saved(fame.join(together, fame["cls"] == together["node"]).select("cls", "comp", "fame"), folder, "famous")
    leaders = saved(famous.groupBy("comp").agg(F.max(F.struct("fame", "cls")).alias("top")).select("comp", F.col("top.cls").alias("b")), folder, "leaders")
    return pairs, saved(famous.join(leaders, "comp").where("cls <> b").select(F.col("cls").alias("a"), "b"), folder, "led")


def _leader_sets(led: DataFrame, sets: DataFrame, folder: str) -> DataFrame:
    """cls, shingles of every leader, and the elements that its classes' differences often hold."""
    sizes = saved(led.groupBy("b").agg(F.count(F.lit(1)).alias("n")), folder, "led-sizes")
    some = led.join(sizes, "b").where(F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / SAMPLE)) == 0).select("a", "b")
    parts = some.join(sets.withColumnsRenamed({"cls": "a", "shingles": "part"}), "a").groupBy("b").agg(F.collect_list("part").alias("parts"))
    own = sets.join(sizes.select(F.col("b").alias("cls")), "cls")
    every = own.join(parts.withColumnRenamed("b", "cls"), "cls", "left").select("cls", "shingles", F.coalesce("parts", F.array().cast("array<binary>")).alias("parts"))
    return saved(every.mapInArrow(_counter, "cls long, shingles binary, common binary, counts binary"), folder, "leader-sets")


def _with_sets(pairs: DataFrame, sets: DataFrame, of_b: DataFrame, led: bool) -> DataFrame:
    """a, b, led, both sets (x of a, y of b), and counts of elements if b is a leader."""
    own = pairs.join(sets.withColumnsRenamed({"cls": "a", "shingles": "x"}), "a")
    both = own.join(of_b.withColumnsRenamed({"cls": "b", "shingles": "y"}), "b")
    return both.select("a", "b", F.lit(led).alias("led"), "x", "y", *[F.col(c) if led else F.lit(None).cast("binary").alias(c) for c in ("common", "counts")])


def _classed(docs: DataFrame, percent: int, k: int, miss: float, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, n_shingles, digest), and classes (cls, digest, doc_id, text_hash, comp).

    A class has a number, cls, and the digest of its set; its doc_id is its smallest; comp is a
    class of its component, the same for all of it.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    signed = slim.mapInArrow(_signer(k), "doc_id long, text_hash long, n_shingles long, digest binary, sig binary, keys array<long>")
    signed = saved(signed, folder, "signed")
    usable = signed.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    least = F.min(F.struct("doc_id", "text_hash")).alias("least")
    classes = usable.groupBy("digest").agg(least, F.first("sig").alias("sig"), F.first("keys").alias("keys"))
    classes = saved(classes.select(F.monotonically_increasing_id().alias("cls"), "digest", "least.*", "sig", "keys"), folder, "classes")  # numbers are fixed from here on
    signed = saved(signed.select("doc_id", "text_hash", "n_shingles", "digest"), folder, "rows")
    dropped(spark, f"{folder}/signed")  # signatures are needed by class only
    buckets = classes.select("cls", F.explode("keys").alias("key"))
    comps: DataFrame | None = None
    sets: DataFrame | None = None
    level = 0
    while True:
        here = f"{folder}/level-{level}"
        pairs, led = _paired(buckets, comps, FEW if level == 0 else FEW_ELEMENTS << level - 1, percent, here)
        if sets is None:
            named = pairs.select(F.explode(F.array("a", "b")).alias("cls"))
            if led is not None:
                named = named.unionByName(led.select(F.explode(F.array("a", "b")).alias("cls")))
            wanted = classes.select("cls", "digest", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).join(named.distinct(), "cls")
            texts = slim.join(wanted.hint("merge"), (F.col("doc_id") == F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
            texts = texts.select("digest", "cls", "text").mapInArrow(_setter(k), "cls long, shingles binary")
            sets = saved(texts.groupBy("cls").agg(F.first("shingles").alias("shingles")), folder, "sets")
        sig = classes.select("cls", "sig")
        near = pairs.join(sig.withColumnsRenamed({"cls": "a", "sig": "x"}), "a").join(sig.withColumnsRenamed({"cls": "b", "sig": "y"}), "b").select("a", "b", "x", "y")
        full = _with_sets(near.mapInArrow(_pruner(percent / 100, miss), "a long, b long"), sets, sets, False)
        if led is not None:
            of_leaders = _leader_sets(led, sets, here)
            size = of_leaders.agg(F.sum(F.octet_length("shingles") + F.octet_length("common") + F.octet_length("counts"))).first()[0] or 0
            full = full.unionByName(_with_sets(led, sets, F.broadcast(of_leaders) if size <= MOST_LEADER_BYTES else of_leaders, True))
        seen = saved(full.mapInArrow(_verifier(percent), "a long, b long, linked boolean, prefix array<long>, short long, d long, n long"), here, "seen")
        comps = joined_components(comps, seen.where("linked").select("a", "b"), f"{here}/comps")
        if led is None:
            break
        elements = seen.where(F.size("prefix") > 0).select(F.col("a").alias("cls"), "b", F.posexplode("prefix").alias("place", "e"), "short", "linked", "d", "n")
        buckets = elements.select("cls", F.xxhash64("b", "e").alias("key"), (F.col("place") >= F.col("short")).cast("int").alias("role"), "linked", F.col("place").cast("long").alias("place"), "d", "n")
        level += 1
    return signed, saved(classes.select("cls", "digest", "doc_id", "text_hash").join(comps.withColumnsRenamed({"node": "cls"}), "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), folder, "classed")


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = 5, miss: float = MISS) -> DataFrame:
    """Link documents with Jaccard similarity of k-word shingles of at least percent / 100.

    Returns one row per document row: doc_id, n_shingles, component_id (the smallest doc_id
    reachable by links), kept (doc_id is component_id). Letters A-Z are lowered and words are runs
    of anything but ASCII white space. A text of fewer than k words has its whole sequence as its
    shingle; null, empty and blank texts have none and stand alone. Rows with a null doc_id are
    linked with nothing and kept, with a null component_id. Repeated rows share a component; texts
    of one doc_id that differ are linked by their texts alone. Extra columns are ignored; an empty
    table gives no rows. Only row counts reach the driver.
    """
    folder = scratch(docs.sparkSession, "near")
    signed, of_class = _classed(docs, percent, k, miss, folder)
    lowest = saved(of_class.groupBy("comp").agg(F.min("doc_id").alias("component_id")), folder, "lowest")
    named = saved(of_class.select("digest", "comp").join(lowest, "comp").select("digest", "component_id"), folder, "named")
    out = signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """docs with one row of each component left, that of the smallest doc_id; all columns stay.

    A row is judged by doc_id and text, so of one doc_id with several texts only those go whose
    component keeps another row (of one doc_id, the text with the smallest hash stays). Rows
    without words or without a doc_id all stay, but of rows repeated with one doc_id and text one
    stays.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "deduplicated")
    signed, of_class = _classed(docs, percent, k, MISS, folder)
    first = saved(of_class.groupBy("comp").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")), folder, "first")
    named = saved(of_class.select("digest", "comp").join(first, "comp").select("digest", "first"), folder, "named")
    judged = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").join(named, "digest")
    gone = judged.where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("text_hash") != F.col("first.text_hash"))).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    gone = saved(gone.distinct(), folder, "gone")
    again = saved(signed.where("doc_id IS NOT NULL").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), folder, "again")
    out = _without(docs, gone)
    if not again.limit(1).count():
        return out
    # only repeated rows are dealt out to find one of each
    key = F.struct(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))))
    repeated = _without(out, again, "left_semi").withColumn("_key", key).dropDuplicates(["_key"]).drop("_key")
    return _without(out, again).unionByName(repeated)


def _without(docs: DataFrame, keys: DataFrame, how: str = "left_anti") -> DataFrame:
    """docs without (or with only) the rows of the given _id and _hash.

    Keys alone, up to a checked number, spare a shuffle of all texts.
    """
    side = F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys.hint("merge")
    return docs.join(side, (docs["doc_id"].cast("long") == side["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == side["_hash"]), how)
