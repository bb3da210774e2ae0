"""Aggregates: totals beside groups, correlations, regressions, intervals and accuracy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import rank_average


def with_total(df: DataFrame, keys: list[str], over: str, aggregates: list[Column], label: str = "ALL") -> DataFrame:
    """Aggregates by keys and `over`, and by keys alone under the label: one pass, grouping sets."""
    columns = [F.col(c) for c in (*keys, over)]
    grouped = df.groupingSets([columns, columns[:-1]], *columns).agg(F.grouping(over).alias("_total"), *aggregates)
    return grouped.withColumn(over, F.when(F.col("_total") == 1, F.lit(label)).otherwise(F.col(over))).drop("_total")


def spearman(df: DataFrame, keys: list[str], x: str, y: str, least: int = 2) -> DataFrame:
    """Rank correlation by group, for groups of at least `least` rows with both values."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = both.select(*keys, rank_average(keys, x).alias("_x"), rank_average(keys, y).alias("_y"))
    return ranked.groupBy(*keys).agg(F.corr("_x", "_y").alias("rho"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def slope(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """The least-squares slope of a value over its place in order."""
    placed = df.select(*keys, F.col(value), F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_i"))
    return placed.groupBy(*keys).agg(F.regr_slope(value, "_i").alias("slope"))


def pair_accuracy(df: DataFrame, keys: list[str], actual: str, predicted: str, row: str | None = None, blank: bool = False) -> DataFrame:
    """How many pairs of a group's rows a prediction puts in the right order; a tied prediction counts half.

    Pairs with equal actual values don't count, and neither do rows without an actual value; a group
    without pairs gives no row. Rows without a prediction don't count unless blank is set: then their
    pairs count, without credit, and the credit of a group is null if no pair has both predictions.
    Where row is given, rows of one value of it are not paired with each other, and rows without it
    don't count. An actual value that is NaN differs from all others, with half a credit a pair.

    No pairs are made: two ranks of the actual value part at one bit, the highest in which they
    differ. So rows are counted for each bit, in parts of equal higher bits, and a row with the bit
    has those below it without the bit as its right pairs: one row a bit, n log n for a group of n.
    These rows are dealt anew by bit and part, and sorted, not hashed: a group's own task would hold
    log n times what it read. Both shuffles are over a stated number of tasks. Rows that share their row value but
    differ in the actual one have second copies, whose pairs with each other are taken off again.
    """
    spark = df.sparkSession
    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    group = Window.partitionBy(*keys)
    for c in (actual, *([] if blank else [predicted]), *([] if row is None else [row])):
        df = df.where(F.col(c).isNotNull())
    none = F.lit(None).cast("long" if row is None else df.schema[row].dataType)
    same = Window.partitionBy(*keys, *([] if row is None else [row]))
    own = none if row is None else F.when(F.min(actual).over(same) < F.max(actual).over(same), F.col(row))
    odd = F.isnan(actual) if df.schema[actual].dataType.typeName() in ("float", "double") else F.lit(False)
    ranked = df.repartition(many, *keys).select(*keys, F.col(predicted).alias("_p"), own.alias("_own"), odd.alias("_odd"), (F.dense_rank().over(group.orderBy(actual)) - 1).alias("_rank"))
    bits = ranked.withColumn("_bits", F.length(F.bin(F.max("_rank").over(group))))
    copies = bits.withColumn("_own", F.explode(F.when(F.col("_own").isNull(), F.array(none)).otherwise(F.array(none, F.col("_own")))))
    rows = copies.withColumn("_bit", F.explode(F.sequence(F.lit(0), F.col("_bits") - 1)))
    high, part = F.expr("shiftright(_rank, _bit) & 1"), F.expr("shiftright(_rank, _bit + 1)")
    dealt = rows.select(*keys, "_bit", part.alias("_part"), "_own", "_p", "_odd", high.alias("_with")).repartition(many, *keys, "_bit", "_part")
    by_value = Window.partitionBy(*keys, "_bit", "_part", "_own").orderBy("_p")
    tied, whole = Window.partitionBy(*keys, "_bit", "_part", "_own", "_p"), by_value.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    without = 1 - F.col("_with")
    known = F.when(F.col("_p").isNotNull(), without).otherwise(0)
    placed = dealt.select(*keys, "_own", "_with", "_p", "_odd", F.sum(known).over(by_value).alias("_upto"), F.sum(known).over(tied).alias("_tied"), F.sum(known).over(whole).alias("_known"), F.sum(without).over(whole).alias("_all")).where("_with = 1")
    once = F.when(F.col("_own").isNull(), 1).otherwise(-1)
    said = F.when(F.col("_p").isNotNull(), once)
    right = F.when(F.col("_odd"), F.col("_known") / 2).otherwise(F.col("_upto") - F.col("_tied") / 2)
    sums = placed.groupBy(*keys).agg(F.sum(once * F.col("_all")).alias("pairs"), F.sum(said * F.col("_known")).alias("_told"), F.sum(said * right).alias("credit"))
    return sums.where("pairs > 0").select(*keys, "pairs", F.when(F.col("_told") > 0, F.col("credit")).alias("credit"))


def least_squares(df: DataFrame, inputs: list[str], target: str) -> list[float]:
    """Intercept and slopes of a linear fit: sums of products in Spark, one small system on the driver."""
    names = [F.lit(1.0), *[F.col(c).cast("double") for c in inputs], F.col(target).cast("double")]
    n = len(names)
    sums = df.dropna(subset=[*inputs, target]).agg(*[F.sum(names[i] * names[j]).alias(f"s{i}_{j}") for i in range(n) for j in range(i, n)]).first()
    m = np.array([[sums[f"s{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)])
    return np.linalg.lstsq(m[:-1, :-1], m[:-1, -1], rcond=None)[0].tolist()


def blocked_bootstrap(blocks: DataFrame, draws: int, seed: int) -> DataFrame:
    """One row: the mean paired difference and its 95 % interval, whole blocks redrawn (mean, low, high; NULL without blocks).

    blocks: block, n, diff (the sum of differences), a row a block. The k-th block of a draw is
    chosen by a digest of seed, draw and k, so draws are the same on any cluster; a row for each
    draw and block is made and summed in Spark.
    """
    order = Window.orderBy("block")  # a row a block, so one sort of few
    rows = blocks.select("n", "diff", (F.row_number().over(order) - 1).cast("long").alias("at"), F.count(F.lit(1)).over(Window.partitionBy()).alias("of"))
    each = rows.select("at", "of", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw"))
    digest = F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("draw").cast("string"), F.col("at").cast("string")).cast("binary")), 1, 8)
    picked = each.select("draw", (F.conv(digest, 16, 10).cast("long") % F.col("of")).alias("at"))
    means = picked.join(rows.select("at", "n", "diff"), "at").groupBy("draw").agg((F.sum("diff") / F.sum("n")).alias("mean"))
    whole = rows.agg((F.sum("diff") / F.sum("n")).alias("mean"))
    ends = means.agg(F.percentile("mean", 0.025).alias("low"), F.percentile("mean", 0.975).alias("high"))
    return ends.select(whole.scalar().alias("mean"), "low", "high")


def pinball(actual: Column, quantile: Column, level: float) -> Column:
    return F.greatest(level * (actual - quantile), (level - 1) * (actual - quantile))


def simplex_weights(df: DataFrame, predictions: list[str], actual: str, step: float = 0.01) -> list[float]:
    """Weights of at least 0 that sum to 1 with the least squared error, on a grid of steps.

    The error is a quadratic form, so one aggregate of products serves every grid point.
    """
    names = [F.col(c).cast("double") for c in (*predictions, actual)]
    k = len(names)
    sums = df.dropna(subset=[*predictions, actual]).agg(*[F.sum(names[i] * names[j]).alias(f"s{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    m = np.array([[sums[f"s{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
    count = round(1 / step)

    def grid(left: int, parts: int):
        if parts == 1:
            yield (left,)
            return
        for x in range(left + 1):
            for rest in grid(left - x, parts - 1):
                yield (x, *rest)

    points = np.array(list(grid(count, len(predictions)))) / count
    full = np.concatenate([points, -np.ones((len(points), 1))], axis=1)
    return points[np.einsum("ni,ij,nj->n", full, m, full).argmin()].tolist()
