"""Window operators. Every order ends in a key, since Spark's sort keeps no input order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return last_n(df, keys, order, 1)


def last_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key in the given order; the limit prunes before the sort is whole."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def newest_snapshot(df: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """All rows of each key's newest stamp."""
    return df.withColumn("_max", F.max(stamp).over(Window.partitionBy(*keys))).where(F.col(stamp) == F.col("_max")).drop("_max")


def share(value: str, keys: list[str]) -> Column:
    """A value's share of its group's total, NULL where that is 0."""
    return F.col(value) / F.nullif(F.sum(value).over(Window.partitionBy(*keys)), F.lit(0))


def rank_min(keys: list[str], order: Column, value: str) -> Column:
    """The rank with ties sharing the lowest; NULL values have none."""
    return F.when(F.col(value).isNotNull(), F.rank().over(Window.partitionBy(*keys).orderBy(order)))


def rank_of_all(df: DataFrame, value: str, name: str, parts: int = 200) -> DataFrame:
    """df with each row's rank in the whole table, the largest value first, ties sharing the lowest.

    No task gets the whole table: approximate percentiles cut it into ranges, a value is in one
    range only, and the sizes of the ranges above are added to the rank within one. At most `parts`
    cuts and sizes reach the driver. NULL values come last, as one range. df must give the same
    values when read again.
    """
    cuts = df.agg(F.percentile_approx(value, [i / parts for i in range(1, parts)])).first()[0] or []
    above = sum((F.when(F.col(value) < c, 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    cut = df.withColumn("_part", F.when(F.col(value).isNull(), len(cuts) + 1).otherwise(above))
    sizes = {r["_part"]: r["count"] for r in cut.groupBy("_part").count().collect()}
    starts = F.array(*[F.lit(sum(n for p, n in sizes.items() if p < i)).cast("long") for i in range(len(cuts) + 2)])
    within = F.rank().over(Window.partitionBy("_part").orderBy(F.col(value).desc_nulls_last()))
    return cut.withColumn(name, within + F.get(starts, F.col("_part"))).drop("_part")


def rank_average(keys: list[str], value: str) -> Column:
    """The rank with ties sharing their mean."""
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, value))
    return F.rank().over(Window.partitionBy(*keys).orderBy(value)) + (ties - 1) / 2


def before(keys: list[str], order: list[Column], n: int | None = None) -> Window:
    """The n rows before the current one, or all of them."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding if n is None else -n, -1)


def run_length(df: DataFrame, keys: list[str], order: list[Column], sign: str, cap: int) -> DataFrame:
    """Per key the length of the run of one sign at its end, signed and capped; 0 if a 0 or NULL ends it.

    The run is what comes after the last row whose sign differs from the final one.
    """
    back = df.withColumn("_s", F.coalesce(F.signum(sign), F.lit(0.0))).withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])))
    last = F.max_by("_s", -F.col("_n")).over(Window.partitionBy(*keys))
    marked = back.withColumn("_last", last)
    ended = F.min(F.when(F.col("_s") != F.col("_last"), F.col("_n")))
    size = F.coalesce(ended - 1, F.count(F.lit(1)))
    return marked.groupBy(*keys).agg((F.first("_last") * F.least(size, F.lit(cap))).cast("int").alias("run"))


def rolling_best(df: DataFrame, keys: list[str], order: list[Column], value: str, size: int = 3) -> DataFrame:
    """Per key the best mean of `size` rows in turn; with fewer rows their plain mean."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), F.avg(value).over(w.rowsBetween(1 - size, 0)).alias("_m"), F.row_number().over(w).alias("_n"))
    return rows.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("_n") >= size, F.col("_m"))), F.avg("_v")).alias("best"))
