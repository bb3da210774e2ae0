"""The numbered queries: each applies one operator to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, hard_negatives, licenses, near_dups, packing, quality_rules, quality_trees, records, repeats, secret_scan, sharding, toxicity, whitening


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(documents(spark, sf_dir), labels(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), 40)


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir), percent=85)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(documents(spark, sf_dir))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.scored(documents(spark, sf_dir), labels(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(embeddings(spark, sf_dir))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(embeddings(spark, sf_dir).withColumn("label", moved), F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_token_records, op3_packing, op4_sharding, op5_secret_scan, op6_quality_trees, op7_near_dups, op8_quality_rules, op9_decontamination, op10_license_scan, op11_whitening, op12_suffix_dedup, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {}
