"""Boosted regression trees for walk-forward fits, grown from histograms that Spark aggregates.

All refits are trained side by side: a row carries the fit that it trains, and a histogram is one
aggregate by fit, node, feature and bin, combined before it is shuffled. Only histograms' best
splits and leaf values reach the driver, at most 2^depth rows a fit and tree; rows never do. The
loss is the squared error, or the pinball loss of a quantile, whose leaves are quantiles of
residuals read off a histogram of them.

Rows of a fit with equal bins share every prediction, so trees are grown from equal rows added up
(summed): for the squared error from weights and means by vector of bins, for a quantile from
weights by bins and y. They are kept while trees are grown, so the source is read once. Predictions,
gradients and places in a tree are worked out by vector of bins and joined to the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A split to the left of which every bin lies: a node that isn't cut.
WHOLE = (0, 1 << 30)


@dataclass
class Tree:
    """Splits (feature, bin) by heap position from 1, bins up to it to the left; and leaf values from left to right."""

    depth: int
    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def row(self, rate: float) -> tuple[list[int], list[int], list[float]]:
        cuts = [self.splits.get(k, WHOLE) for k in range(1, 1 << self.depth)]
        return [c[0] for c in cuts], [c[1] for c in cuts], [rate * self.leaves.get(k, 0.0) for k in range(1 << self.depth)]


@dataclass
class Model:
    """By fit: the first guess, and the trees after it."""

    base: dict[int, float]
    trees: dict[int, list[Tree]]
    rate: float

    def frame(self, spark) -> DataFrame:
        rows = [(fit, base, [t.row(self.rate) for t in self.trees.get(fit, [])]) for fit, base in self.base.items()]
        return spark.createDataFrame(rows, "fit int, base double, trees array<struct<feature:array<int>,at:array<int>,leaf:array<double>>>")


def binned(features: dict[str, list[float]]) -> Column:
    """An array of a bin for each feature: 0 for NULL or NaN, else 1 and the number of cuts that the value is above."""
    out = []
    for name, cuts in features.items():
        v = F.col(name).cast("double")
        above = sum((F.when(v > c, 1).otherwise(0) for c in cuts), F.lit(1))
        out.append(F.when(v.isNull() | F.isnan(v), F.lit(0)).otherwise(above))
    return F.array(*out)


def cuts_of(rows: DataFrame, names: list[str], bins: int) -> dict[str, list[float]]:
    """Cut points at equal shares of rows, by approximate percentiles; take rows that every fit may know."""
    shares = [i / bins for i in range(1, bins)]
    got = rows.agg(*[F.percentile_approx(F.col(n).cast("double"), shares).alias(n) for n in names]).first()
    return {n: sorted(set(got[n] or [])) for n in names}


def walked(rows: DataFrame, week: str, fits: list[int], half_life: float | None = None) -> DataFrame:
    """Each row once for every fit after its week, with column fit and recency weight w; fits is a short, stated list.

    A row's weight halves with every half_life weeks before the last that the fit may know. Rows of
    or after a fit's week train nothing of it.
    """
    later = F.explode(F.filter(F.array(*[F.lit(f) for f in fits]), lambda f: f > F.col(week)))
    out = rows.withColumn("fit", later)
    return out.withColumn("w", F.pow(F.lit(0.5), (F.col("fit") - 1 - F.col(week)) / half_life) if half_life else F.lit(1.0))


def serving(week: Column, fits: list[int]) -> Column:
    """The newest fit at or before a row's week; NULL before the first."""
    return F.array_max(F.filter(F.array(*[F.lit(f) for f in fits]), lambda f: f <= week))


def node_of(bins: Column, tree: Column, levels: int) -> Column:
    """The heap position that a row reaches after some levels of a tree."""
    node = F.lit(1)
    for _ in range(levels):
        right = F.get(bins, F.get(tree["feature"], node - 1)) > F.get(tree["at"], node - 1)
        node = node * 2 + F.when(right, 1).otherwise(0)
    return node


def predicted(rows: DataFrame, model: Model, depth: int) -> DataFrame:
    """rows (fit, bins) with column prediction; NULL where the fit has no model. The model's table is a row a fit."""
    frame = model.frame(rows.sparkSession)
    out = rows.join(F.broadcast(frame), "fit", "left")
    total = F.aggregate("trees", F.col("base"), lambda total, t: total + F.get(t["leaf"], node_of(F.col("bins"), t, depth) - (1 << depth)))
    return out.withColumn("prediction", total).drop("base", "trees")


def predicted_by_bins(rows: DataFrame, models: dict[str, Model], depth: int) -> DataFrame:
    """rows (fit, bins) with a column of each model's prediction, worked out once for each fit and vector of bins.

    For few cuts a feature: the table of vectors, at most the product of their numbers of bins a fit, is broadcast.
    """
    cells = rows.select("fit", "bins").distinct()
    for name, model in models.items():
        cells = predicted(cells, model, depth).withColumnRenamed("prediction", name)
    return rows.join(F.broadcast(cells), ["fit", "bins"], "left")


def summed(rows: DataFrame, by_y: bool) -> DataFrame:
    """rows (fit, bins, y, w, held) with equal ones added up: their weight as w, and where y isn't one of the keys, their weighted mean as y."""
    if by_y:
        return rows.groupBy("fit", "bins", "held", "y").agg(F.sum("w").alias("w"))
    return rows.groupBy("fit", "bins", "held").agg((F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("y"), F.sum("w").alias("w"))


def histogram(rows: DataFrame, node: Column, gradient: Column) -> DataFrame:
    """fit, node, feature, bin: sums of weight (w) and of weighted gradient (g)."""
    each = rows.select("fit", node.alias("node"), "w", (F.col("w") * gradient).alias("g"), F.posexplode("bins").alias("feature", "bin"))
    return each.groupBy("fit", "node", "feature", "bin").agg(F.sum("w").alias("w"), F.sum("g").alias("g"))


def best_splits(hist: DataFrame, least: float) -> DataFrame:
    """fit, node, feature, bin, gain of each node's best cut: the largest drop of squared error, of equal ones the first feature and bin.

    Either side must weigh at least `least`; a node without such a cut, or without gain, has no row.
    Gains are compared as singles, so that the order of additions decides nothing.
    """
    so_far = Window.partitionBy("fit", "node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("fit", "node", "feature")
    sums = hist.select("fit", "node", "feature", "bin", *[F.sum(c).over(so_far).alias(f"l{c}") for c in "wg"], *[F.sum(c).over(whole).alias(c) for c in "wg"])
    rw, rg = F.col("w") - F.col("lw"), F.col("g") - F.col("lg")
    gain = F.col("lg") * F.col("lg") / F.col("lw") + rg * rg / rw - F.col("g") * F.col("g") / F.col("w")
    cut = sums.where((F.col("lw") >= least) & (rw >= least) & (rw > 0)).select("fit", "node", "feature", "bin", gain.cast("float").alias("gain")).where("gain > 0")
    top = F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))).alias("top")
    return cut.groupBy("fit", "node").agg(top).select("fit", "node", (-F.col("top.f")).alias("feature"), (-F.col("top.b")).alias("bin"), F.col("top.gain").alias("gain"))


def leaf_values(rows: DataFrame, node: Column, residual: Column, quantile: float | None, width: float) -> DataFrame:
    """fit, node, value: the weighted mean of residuals, or their quantile to within width, from a histogram."""
    each = rows.select("fit", node.alias("node"), "w", residual.alias("r"))
    if quantile is None:
        return each.groupBy("fit", "node").agg((F.sum(F.col("w") * F.col("r")) / F.sum("w")).alias("value"))
    counts = each.groupBy("fit", "node", F.floor(F.col("r") / width).alias("b")).agg(F.sum("w").alias("w"))
    so_far = F.sum("w").over(Window.partitionBy("fit", "node").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("w").over(Window.partitionBy("fit", "node"))
    reached = counts.withColumn("past", so_far >= quantile * whole).where("past")
    return reached.groupBy("fit", "node").agg(((F.min("b") + 0.5) * width).alias("value"))


def loss_of(residual: Column, quantile: float | None) -> Column:
    return residual * residual if quantile is None else F.greatest(residual * quantile, residual * (quantile - 1))


def boosted(rows: DataFrame, rounds: int, depth: int, rate: float, least: float = 1.0, quantile: float | None = None, width: float = 1.0, patience: int | None = None) -> Model:
    """Fit trees on rows (fit, bins, y, w; held: rows that only judge when to stop).

    A round is one aggregate of gradients by vector of bins, depth aggregates of those for the splits,
    and one of the rows for the leaves, over all fits together. With
    patience, a fit that has not improved on its held rows for so many rounds stops, and keeps the
    trees up to its best. Rows without y, or of weight 0, teach nothing. Without rows there is no fit.
    """
    if "held" not in rows.columns:
        rows = rows.withColumn("held", F.lit(False))
    rows = rows.select("fit", "bins", F.col("y").cast("double").alias("y"), "w", "held").where("y IS NOT NULL AND w > 0")
    tasks = rows.sparkSession.sparkContext.defaultParallelism * (4 if quantile is not None else 1)
    rows = summed(rows, quantile is not None).coalesce(tasks).persist()
    try:
        return _grown(rows, rounds, depth, rate, least, quantile, width, patience)
    finally:
        rows.unpersist()


def _grown(rows: DataFrame, rounds: int, depth: int, rate: float, least: float, quantile: float | None, width: float, patience: int | None) -> Model:
    """boosted() on rows added up. For the squared error a held row's loss is that of its mean: what it leaves out is the same every round."""
    spark = rows.sparkSession
    taught = rows.where("NOT held")
    cells = taught.select("fit", "bins").distinct().coalesce(spark.sparkContext.defaultParallelism).persist()
    base = {r.fit: r.value for r in leaf_values(taught, F.lit(0), F.col("y"), quantile, width).collect()}
    model = Model(base, {fit: [] for fit in base}, rate)
    best = {fit: (float("inf"), 0) for fit in base}
    live = set(base)
    for turn in range(1, rounds + 1):
        if not live:
            break
        residual = F.col("y") - F.col("prediction")
        guessed = predicted(cells.where(F.col("fit").isin(sorted(live))), model, depth)
        gradient = residual if quantile is None else F.when(residual > 0, quantile).otherwise(quantile - 1)
        sums = taught.join(guessed, ["fit", "bins"]).groupBy("fit", "bins").agg((F.sum(F.col("w") * gradient) / F.sum("w")).alias("g"), F.sum("w").alias("w")).coalesce(spark.sparkContext.defaultParallelism).persist()
        fresh = {fit: Tree(depth) for fit in live}
        grown = lambda df, fresh=fresh: df.join(F.broadcast(Model({f: 0.0 for f in fresh}, {f: [t] for f, t in fresh.items()}, 1.0).frame(spark).drop("base")), "fit")
        tree = F.get("trees", F.lit(0))
        for level in range(depth):
            hist = histogram(grown(sums), node_of(F.col("bins"), tree, level), F.col("g"))
            for r in best_splits(hist, least).collect():
                fresh[r.fit].splits[r.node] = (r.feature, r.bin)
        sums.unpersist()
        placed = grown(guessed).select("fit", "bins", "prediction", (node_of(F.col("bins"), tree, depth) - (1 << depth)).alias("node"))
        for r in leaf_values(taught.join(placed, ["fit", "bins"]), F.col("node"), residual, quantile, width).collect():
            fresh[r.fit].leaves[r.node] = r.value
        for fit, tree in fresh.items():
            model.trees[fit].append(tree)
        if patience is not None:
            judged = predicted(rows.where(F.col("held") & F.col("fit").isin(sorted(live))), model, depth)
            for r in judged.groupBy("fit").agg((F.sum(F.col("w") * loss_of(residual, quantile)) / F.sum("w")).alias("loss")).collect():
                if r.loss < best[r.fit][0]:
                    best[r.fit] = (r.loss, turn)
                elif turn - best[r.fit][1] >= patience:
                    live.discard(r.fit)
    if patience is not None:
        model.trees = {fit: trees[: best[fit][1]] if best[fit][0] < float("inf") else trees for fit, trees in model.trees.items()}
    cells.unpersist()
    return model
