"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns a
DataFrame that is written as Parquet and read again as the next one's docs. All but the last return
the columns of documents, further columns and such with clashing names too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, near_dups, packing, quality_rules, secret_scan
from tidemark.llm.store import saved, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or the learned decision list reject.

    A null or empty text has no words and goes; null doc_ids and repeated rows are judged by their
    texts; an empty table stays empty.
    """
    return quality_rules.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of copies and near copies, that of the smallest doc_id.

    Rows without words or without a doc_id stay; of rows repeated with one doc_id and text one
    stays; an empty table stays empty.
    """
    return near_dups.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item.

    Null and empty texts hold none and stay; null doc_ids and repeated rows are judged alike; without
    items, and on an empty table, nothing goes.
    """
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take assigned, access and random secrets out of the texts; every row stays.

    Null texts stay null, and texts without secrets are unchanged; n_chars follows the text.
    """
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts' token ids into sequences of 2048: a row for each piece.

    A null or empty text is its end id alone; repeated rows are packed each; an empty table gives no
    rows.
    """
    return packing.pack(docs, 2048)


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminate), ("secret_scan", secrets), ("packing", pack)]

#: The learned rules, and the tokenizer, have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of sf_dir."""
    folder = scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
