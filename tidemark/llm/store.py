"""Shared scratch tables, exact ranking without large windows, and labelled samples."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import saved, scratch  # noqa: F401  the operators take them from here


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later step reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def ranked(df: DataFrame, keys: list[str], bucket: F.Column, order: list[F.Column], name: str, folder: str) -> DataFrame:
    """Adds name: the rank from 0 within keys, by bucket and then order, in two levels.

    No task gets a whole key: rows are numbered within (keys, bucket), and the sizes of the
    earlier buckets, a table of counts, are added. df must give the same rows when read again.
    """
    cut = df.withColumn("_bucket", bucket)
    inner = [*keys, "_bucket"]
    sizes = cut.groupBy(*inner).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), folder, f"starts-{name}-{uuid.uuid4().hex[:6]}")
    row = F.row_number().over(Window.partitionBy(*inner).orderBy(*order)) - 1
    numbered = cut.withColumn("_row", row)
    starts = starts.withColumnsRenamed({k: f"_s_{k}" for k in inner})
    joined = numbered.join(starts, _null_safe(inner), "left")
    return joined.withColumn(name, (F.col("_row") + F.col("_before")).cast("long")).drop("_row", "_before", "_bucket", *[f"_s_{k}" for k in inner])


def _null_safe(keys: list[str]) -> F.Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    return cond


def labelled(docs: DataFrame, labels: DataFrame, label: str, fold: int, held: int, most: int, columns: list[F.Column]) -> DataFrame:
    """At most about 2 * most labelled rows of the training fold, as many of each class as there are.

    The fold is crc32 of doc_id as text modulo fold; rows whose remainder is held are left out.
    Rows are taken by the hash of doc_id, so the sample does not depend on partitions. Rows with a
    null label or null doc_id are left out; a doc_id with several labels counts with its largest,
    one with several texts with its smallest.
    """
    train = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % fold != held))
    train = train.groupBy("doc_id").agg(F.max(label).alias("_label"))
    picked = None
    for value in (0, 1):
        part = train.where(F.col("_label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    few = F.broadcast(picked)  # at most 2 * most rows of two numbers
    rows = docs.select("doc_id", F.struct(*columns).alias("_row")).join(few, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("_label").alias("_label"), F.min("_row").alias("_row")).select("doc_id", "_label", "_row.*")
