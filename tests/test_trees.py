"""Boosted trees from histograms against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import trees

ROWS = "fit int, bins array<int>, y double, w double"


def drawn(seed, n, fits=(1, 2)):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        bins = [draw.randrange(0, 5), draw.randrange(1, 4), draw.randrange(0, 3)]
        out.append((draw.choice(fits), bins, float(20 * bins[0] + (30 if bins[1] == 2 else 0) + draw.randrange(0, 9)), draw.choice((1.0, 0.5))))
    return out


def plain_split(rows, least):
    """The best (gain, feature, bin) of rows (bins, gradient, weight), by trying every cut."""
    best = None
    for f in range(len(rows[0][0])):
        for at in range(0, 6):
            left, right = ([r for r in rows if (r[0][f] <= at) == side] for side in (True, False))
            w = [sum(r[2] for r in part) for part in (left, right)]
            if min(w) < least or not min(w):
                continue
            g = [sum(r[1] * r[2] for r in part) for part in (left, right)]
            gain = g[0] ** 2 / w[0] + g[1] ** 2 / w[1] - sum(g) ** 2 / sum(w)
            if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-6)):
                best = gain, f, at
    return best


def plain_boost(rows, rounds, depth, rate, least):
    """Predictions for all bins of one fit's rows (bins, y, w)."""
    base = sum(y * w for _, y, w in rows) / sum(w for *_, w in rows)
    guess = [base] * len(rows)
    made = []
    for _ in range(rounds):
        nodes, splits = {1: list(range(len(rows)))}, {}
        for _ in range(depth):
            following = {}
            for node, at in nodes.items():
                found = plain_split([(rows[i][0], rows[i][1] - guess[i], rows[i][2]) for i in at], least) if at else None
                if found:
                    splits[node] = found[1:]
                go = lambda i, found=found: bool(found) and rows[i][0][found[1]] > found[2]
                following[2 * node], following[2 * node + 1] = [i for i in at if not go(i)], [i for i in at if go(i)]
            nodes = following
        leaves = {}
        for node, at in nodes.items():
            if at:
                leaves[node - (1 << depth)] = sum((rows[i][1] - guess[i]) * rows[i][2] for i in at) / sum(rows[i][2] for i in at)
                for i in at:
                    guess[i] += rate * leaves[node - (1 << depth)]
        made.append((splits, leaves))
    return base, made, guess


def test_boosted_trees_equal_plain_loops(spark):
    rows = drawn(3, 300)
    model = trees.boosted(spark.createDataFrame(rows, ROWS), rounds=3, depth=2, rate=0.5, least=5.0)
    for fit in (1, 2):
        mine = [(b, y, w) for f, b, y, w in rows if f == fit]
        base, made, guess = plain_boost(mine, 3, 2, 0.5, 5.0)
        assert model.base[fit] == pytest.approx(base)
        for tree, (splits, leaves) in zip(model.trees[fit], made, strict=True):
            assert tree.splits == splits and tree.leaves == pytest.approx(leaves)
        got = trees.predicted(spark.createDataFrame([(fit, b, i) for i, (b, *_) in enumerate(mine)], "fit int, bins array<int>, i int"), model, 2).collect()
        assert {r.i: r.prediction for r in got} == pytest.approx(dict(enumerate(guess)))


def test_quantile_leaves_and_coverage(spark):
    draw = random.Random(5)
    rows = [(1, [1 + i % 2], draw.random() * (10 if i % 2 else 100), 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, ROWS)
    for q in (0.1, 0.9):
        model = trees.boosted(df, rounds=2, depth=1, rate=1.0, quantile=q, width=0.1)
        below = trees.predicted(df, model, 1).groupBy(F.get("bins", F.lit(0)).alias("b")).agg(F.avg((F.col("y") <= F.col("prediction")).cast("int")).alias("share")).collect()
        assert all(r.share == pytest.approx(q, abs=0.03) for r in below)


def test_no_row_of_or_after_the_week_is_used(spark):
    rows = [(w, float(i % 4), float(10 * (i % 4) + w), i) for i in range(80) for w in range(1, 7)]
    fits = [3, 5]

    def fitted(changed):
        df = spark.createDataFrame([(w, x, y + (1000 if w >= changed else 0), i) for w, x, y, i in rows], "week int, x double, y double, i int")
        df = df.withColumn("bins", trees.binned({"x": [0.5, 1.5, 2.5]}))
        model = trees.boosted(trees.walked(df, "week", fits, 2.0), rounds=2, depth=2, rate=1.0)
        return trees.predicted(df.withColumn("fit", trees.serving(F.col("week"), fits)).where("fit IS NOT NULL"), model, 2).orderBy("week", "i").collect()

    first, later, now = fitted(99), fitted(5), fitted(3)
    assert [r.prediction for r in first] == [r.prediction for r in later]  # weeks 5 and 6 train no fit
    assert [r.prediction for r in first if r.week < 5] == [r.prediction for r in now if r.week < 5]
    assert [r.prediction for r in first if r.week >= 5] != [r.prediction for r in now if r.week >= 5]
    assert {(r.week, r.fit) for r in first} == {(3, 3), (4, 3), (5, 5), (6, 5)}


def test_recency_weights(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "week int")
    got = {(r.week, r.fit): r.w for r in trees.walked(df, "week", [2, 4], 1.0).collect()}
    assert got == {(1, 2): 1.0, (1, 4): 0.25, (2, 4): 0.5, (3, 4): 1.0}


def test_early_stopping_keeps_the_best_trees(spark):
    draw = random.Random(9)
    rows = [(1, [draw.randrange(1, 9), draw.randrange(1, 9)], draw.random() * 100, 1.0, i % 3 == 0) for i in range(240)]  # nothing to learn
    df = spark.createDataFrame(rows, f"{ROWS}, held boolean")
    model = trees.boosted(df, rounds=8, depth=2, rate=0.9, patience=2)
    losses = []
    for k in range(9):
        cut = trees.Model(model.base, {1: trees.boosted(df, rounds=k, depth=2, rate=0.9).trees[1]} if k else {1: []}, 0.9)
        losses.append(trees.predicted(df.where("held"), cut, 2).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0])
        if k >= 3 and losses.index(min(losses[1:])) <= k - 2:
            break
    assert len(model.trees[1]) == losses.index(min(losses[1:]))
    assert len(model.trees[1]) < 8


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (5.0,)], "x double")
    assert [r[0] for r in df.select(trees.binned({"x": [0.0, 3.0]})).collect()] == [[0], [0], [2], [3]]
    none = spark.createDataFrame([], ROWS)
    model = trees.boosted(none, rounds=2, depth=1, rate=1.0)
    assert model.base == {}
    asked = spark.createDataFrame([(1, [1])], "fit int, bins array<int>")
    assert trees.predicted(asked, model, 1).first().prediction is None


def test_trees_are_grown_from_rows_added_up(spark):
    rows = drawn(4, 40) * 50
    df = spark.createDataFrame(rows, ROWS).withColumn("held", F.lit(False))
    vectors, values = ({(f, tuple(b), *k(y)) for f, b, y, _ in rows} for k in (lambda y: (), lambda y: (y,)))
    for by_y, want in ((False, vectors), (True, values)):
        got = trees.summed(df, by_y)
        assert got.count() == len(want)
        assert got.agg(F.sum("w"), F.sum(F.col("w") * F.col("y"))).first() == pytest.approx((sum(r[3] for r in rows), sum(r[2] * r[3] for r in rows)))


def test_the_source_is_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            read.add(1)
            yield row

    df = spark.createDataFrame(spark.sparkContext.parallelize(drawn(6, 90), 2).mapPartitions(counted), ROWS)
    for quantile in (None, 0.5):
        read.value = 0
        trees.boosted(df, rounds=3, depth=2, rate=0.5, quantile=quantile)
        assert read.value == 90


def test_predictions_by_vector_of_bins(spark):
    df = spark.createDataFrame(drawn(7, 200), ROWS)
    model = trees.boosted(df.where("fit = 1"), rounds=2, depth=2, rate=0.5)
    got = trees.predicted_by_bins(df, {"p": model}, 2)
    order = ["fit", "bins", "y", "w"]
    assert got.orderBy(*order).collect() == trees.predicted(df, model, 2).withColumnRenamed("prediction", "p").select(got.columns).orderBy(*order).collect()
