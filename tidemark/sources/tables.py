"""Readers: explicit types at the scan, NaN as NULL, ids as text, optional tables as empty ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of a data folder; columns and filters reach its scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Float and double NaN become NULL, so that averages and ranks pass them over."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in floats})


def typed_csv(spark: SparkSession, path: str, ids: list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header under a fixed schema; columns named in ids are text whatever the schema says."""
    fields = [T.StructField(f.name, T.StringType() if f.name in ids else f.dataType) for f in schema]
    return spark.read.csv(path, header=True, schema=T.StructType(fields), mode="PERMISSIVE")


def json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON payloads under a fixed schema; a damaged document gives a row of NULLs and its text."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.json(path, schema=with_bad, mode="PERMISSIVE", multiLine=True)


def optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at path, or an empty one with the schema where nothing is published yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def overlaid(archive: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Archived rows, and the current ones whose keys the archive lacks."""
    return archive.unionByName(current.join(archive.select(keys), keys, "left_anti"), allowMissingColumns=True)
