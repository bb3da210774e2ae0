"""Matching rows of two tables over tiers of keys, by mutual uniqueness.

At a tier two rows match if they share a key that no other row of either pool has. Both leave the
pool, and the next tier goes on with what is left; nothing is guessed. Whether a key is unique on
both sides is a count by key, so no pairs are formed, however many rows share a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pool(rows: DataFrame, id_: str, tiers: dict[str, list[Column]], side: str) -> DataFrame:
    keys = [F.when(~_any_null(columns), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])).alias(f"_{name}") for name, columns in tiers.items()]
    return rows.select(F.col(id_).alias(side), *keys)


def _any_null(columns: list[Column]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | c.isNull()
    return out


def matched(left: DataFrame, left_id: str, left_tiers: dict[str, list[Column]], right: DataFrame, right_id: str, right_tiers: dict[str, list[Column]]) -> DataFrame:
    """left_id, right_id, tier and reason, one row for each row of left.

    tiers: name to the columns of its key, in order, the same names and types on both sides; a key
    with a NULL is none. reason is matched, or of the tiers that a row had a partner at, the last
    one's: shared (other rows of left claim the same partner) or ambiguous (several partners); or no
    partner. Ids must be set and unique.
    """
    if list(left_tiers) != list(right_tiers):
        raise ValueError("both sides need the same tiers")
    a, b = _pool(left, left_id, left_tiers, "left_id"), _pool(right, right_id, right_tiers, "right_id")
    a = a.withColumns({"right_id": F.lit(None).cast(b.schema["right_id"].dataType), "tier": F.lit(None).cast("string"), "reason": F.lit("no partner")})
    for name in left_tiers:
        key = f"_{name}"
        waiting = a.where(F.col("tier").isNull() & F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("claims"))
        free = b.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("partners"), F.min("right_id").alias("partner"))
        a = a.join(waiting.join(free, key).withColumnRenamed(key, "_key"), F.col("tier").isNull() & (F.col(key) == F.col("_key")), "left")
        one = (F.col("claims") == 1) & (F.col("partners") == 1)
        reason = F.when(one, "matched").when(F.col("partners") > 1, "ambiguous").when(F.col("partners") == 1, "shared").otherwise(F.col("reason"))
        a = a.withColumns({"right_id": F.when(one, F.col("partner")).otherwise(F.col("right_id")), "reason": reason, "tier": F.when(one, F.lit(name)).otherwise(F.col("tier"))}).drop("_key", "claims", "partners", "partner")
        b = b.join(a.where(F.col("tier") == name).select("right_id"), "right_id", "left_anti")
    return a.select("left_id", "right_id", "tier", "reason")
