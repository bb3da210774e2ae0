"""Whole-number vectors from columns of arrays, and their rows as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_numbers(rows: DataFrame, vector: str, scale: int, shift: int, most: int) -> DataFrame:
    """Rows whose vector is neither null nor empty and holds finite entries alone, with x in its place.

    x is floor(scale * entry) + shift as array<long>, of the entry as double; scale * entry is held
    within most either way, so that a finite but huge entry has a value too.
    """
    fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    held = lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(most))), F.lit(-float(most))))
    return rows.where(fine).withColumn("x", F.transform(vector, lambda c: held(c) + F.lit(shift).cast("long"))).drop(*([vector] if vector != "x" else []))


def of_one_size(rows: DataFrame) -> tuple[DataFrame, int, int, int]:
    """Rows of the size that most vectors x have (of equal counts the larger), that size, their number, and the largest absolute entry.

    Rows of other sizes have no place in a common space and are left out. One pass; the driver
    gets one row. An empty table gives size 0.
    """
    top = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))).alias("top"))
    found = top.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not found:
        return rows, 0, 0, 0
    d, n, most = found[0]
    return rows.where(F.size("x") == d), int(d), int(n), int(most)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a column of lists of d numbers each."""
    return np.asarray(column.flatten()).reshape(-1, d)
