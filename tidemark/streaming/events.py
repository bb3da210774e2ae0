"""Windowed counts with a watermark, and idempotent batch writes; keyed.py has rows that freeze and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.windows import latest
from tidemark.sources.sinks import Versioned


def stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", time: str = "ts") -> DataFrame:
    """Parquet files of a folder as a stream; the event time becomes a TIMESTAMP, which watermarks need."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder).withColumn(time, F.col(time).cast("timestamp"))


def tumbling(rows: DataFrame, keys: list[str], size: str, late: str, time: str = "ts") -> DataFrame:
    """Counts by window and key; rows later than `late` after the newest are left out."""
    counted = rows.withWatermark(time, late).groupBy(F.window(time, size), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), *keys, "n")


def upserting(rows: DataFrame, table: str, keys: list[str], checkpoint: str, time: str = "ts") -> StreamingQuery:
    """Take each batch into a versioned table by key, of a key's rows in a batch the newest; a batch that runs again changes nothing."""

    def take(batch: DataFrame, number: int) -> None:
        newest = latest(batch, keys, [F.col(time).desc_nulls_last(), F.xxhash64(*batch.columns)])
        Versioned(batch.sparkSession, table).upsert(newest, keys)

    return rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
