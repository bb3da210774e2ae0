"""Joins beyond equality: cascades, nearest matches, step lookups, missing combinations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import latest


def unambiguous(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """key and value for the keys that have just one value."""
    return pairs.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.count_distinct(value).alias("_n")).where("_n = 1").drop("_n")


def cascade(df: DataFrame, lookups: list[tuple[str, DataFrame]], value: str) -> DataFrame:
    """value from the first of several lookups that knows the row.

    lookups: (df's key column, a DataFrame of key and value with one row a key), in order.
    """
    found = []
    for i, (key, pairs) in enumerate(lookups):
        name = f"_v{i}"
        side = pairs.toDF(f"_k{i}", name)
        df = df.join(side, df[key] == side[f"_k{i}"], "left").drop(f"_k{i}")
        found.append(F.col(name))
    return df.withColumn(value, F.coalesce(*found)).drop(*[f"_v{i}" for i in range(len(lookups))])


def nearest(df: DataFrame, rows: DataFrame, key: str, time: str, id_: str, most: int) -> DataFrame:
    """Each row of df with the row of its key that is closest in time, within `most`: adds id_ and gap.

    time is a whole number on both sides; of rows as close the smallest id_ counts, and df's rows
    without one are left out. Both sides lie in one stream by key and time, in which the nearest row
    is the last one before or the first one after, so nothing is paired.
    """
    near = rows.groupBy(key, time).agg(F.min(id_).alias("_id"))  # of one instant the smallest id
    left = df.select(key, time, F.struct("*").alias("_t"))
    both = left.unionByName(near.select(key, time, F.struct(time, "_id").alias("_row")), allowMissingColumns=True)
    w, past = Window.partitionBy(key), (Window.unboundedPreceding, 0)
    back = F.last("_row", ignorenulls=True).over(w.orderBy(time).rangeBetween(*past))
    ahead = F.last("_row", ignorenulls=True).over(w.orderBy(F.col(time).desc()).rangeBetween(*past))  # seen from the end
    gap = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.{time}") - F.col(time)).alias("gap"), F.col(f"{c}._id").alias(id_)))
    seen = both.withColumns({"_back": back, "_ahead": ahead}).where("_t IS NOT NULL").withColumn("_best", F.least(gap("_back"), gap("_ahead")))
    return seen.where(F.col("_best.gap") <= most).select("_t.*", f"_best.{id_}", "_best.gap")


def step_value(x: Column, steps: list[tuple[float, float]], beyond: float) -> Column:
    """The value of the first step whose upper edge is at or above x."""
    out = None
    for edge, value in steps:
        out = F.when(x <= edge, F.lit(value)) if out is None else out.when(x <= edge, F.lit(value))
    return out.otherwise(F.when(x.isNotNull(), F.lit(beyond)))


def missing_combinations(a: DataFrame, b: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of two small dimensions that a fact lacks (for explicit rows of nothing)."""
    return a.crossJoin(F.broadcast(b)).join(present.select(keys).distinct(), keys, "left_anti")


def coalesced_outer(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """A full outer join; of columns that both have, a's value counts where it is set."""
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    out = a.join(b.withColumnsRenamed({c: f"_b_{c}" for c in shared}), keys, "full_outer")
    return out.withColumns({c: F.coalesce(c, f"_b_{c}") for c in shared}).drop(*[f"_b_{c}" for c in shared])
