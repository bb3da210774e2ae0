"""The point-in-time gate: a target may only use rows known strictly before its cutoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(targets: DataFrame, rows: DataFrame, keys: list[str], cutoff: str, known_at: str) -> DataFrame:
    """Every pair of a target and a row of its keys with known_at < cutoff.

    rows' columns besides the keys must differ from the targets'. A shuffled join on the keys with
    the inequality as a residual; use it to aggregate many rows of each target.
    """
    gated = rows.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    cond = F.col(known_at) < F.col(cutoff)
    for k in keys:
        cond = cond & (targets[k] == gated[f"_k_{k}"])
    return targets.join(gated, cond, "left").drop(*[f"_k_{k}" for k in keys])


def latest_before(targets: DataFrame, rows: DataFrame, keys: list[str], cutoff: str, known_at: str, values: list[str], tie: str, strict: bool = True) -> DataFrame:
    """Each target with the newest row known before its cutoff: one shuffle, no pairs.

    Both sides are put in one stream by key and time, and the last row seen is carried forward.
    At equal times targets come before rows if strict, after them if not. Of rows known at one
    time the one with the largest tie counts. Adds values, and known_at of the row.
    """
    payload = F.struct(F.col(known_at).alias("_known"), *values)
    left = targets.select(F.struct("*").alias("_t"), *keys, F.col(cutoff).alias("_time"), F.lit(0 if strict else 1).alias("_side"), F.lit(None).cast(rows.schema[tie].dataType).alias("_tie"))
    right = rows.select(*keys, F.col(known_at).alias("_time"), F.lit(1 if strict else 0).alias("_side"), F.col(tie).alias("_tie"), payload.alias("_row"))
    stream = left.unionByName(right, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_time", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    seen = stream.withColumn("_seen", F.last("_row", ignorenulls=True).over(w)).where(F.col("_t").isNotNull())
    return seen.select("_t.*", F.col("_seen._known").alias(known_at), *[F.col(f"_seen.{v}").alias(v) for v in values])


def first_after(targets: DataFrame, rows: DataFrame, keys: list[str], time: str, known_at: str, values: list[str], tie: str) -> DataFrame:
    """Each target with the first row known strictly after its time; a tolerance is a filter on top."""
    payload = F.struct(F.col(known_at).alias("_known"), *values)
    left = targets.select(F.struct("*").alias("_t"), *keys, F.col(time).alias("_time"), F.lit(1).alias("_side"), F.lit(None).cast(rows.schema[tie].dataType).alias("_tie"))
    right = rows.select(*keys, F.col(known_at).alias("_time"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), payload.alias("_row"))
    stream = left.unionByName(right, allowMissingColumns=True)
    # seen from the end: a row at the target's own time comes after the target and is not seen
    w = Window.partitionBy(*keys).orderBy(F.col("_time").desc(), F.col("_side").desc(), F.col("_tie").desc()).rowsBetween(Window.unboundedPreceding, 0)
    seen = stream.withColumn("_seen", F.last("_row", ignorenulls=True).over(w)).where(F.col("_t").isNotNull())
    return seen.select("_t.*", F.col("_seen._known").alias(known_at), *[F.col(f"_seen.{v}").alias(v) for v in values])


def history(targets: DataFrame, rows: DataFrame, keys: list[str], cutoff: str, known_at: str, aggregates: list[Column], row_id: list[str]) -> DataFrame:
    """Aggregates over each target's gated rows; targets without any keep NULLs (0 for counts)."""
    return as_of(targets, rows, keys, cutoff, known_at).groupBy(*row_id).agg(*aggregates)


def truncated(rows: DataFrame, known_at: str, cutoff: Column) -> DataFrame:
    """What was known before an instant, as a physical cut: a gated result must not differ on it."""
    return rows.where(F.col(known_at) < cutoff)


def check_contract(rows: DataFrame, known_at: str) -> DataFrame:
    """One row: how many rows there are and how many break the contract that known_at is set."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(known_at).isNull()).alias("n_unknown"))
