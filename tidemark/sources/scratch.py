"""Scratch tables: steps that are read more than once, written as Parquet under spark.checkpoint.dir."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Where that setting is absent, a session whose executors are threads of the driver (tests) takes
    a folder of this machine. A cluster has no folder that is surely shared, and gets an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base and re.match(r"local(\[|$)", context.master):
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        base = context.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write df as Parquet under folder and read it back: cuts lineage, survives lost executors."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
