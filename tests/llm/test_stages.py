"""Every stage of the pipeline on odd rows, on an empty table, and the queries on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from .support import ODD, empty, labels, odd, prose

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("stages"))
    labels(spark, [(1, 1, 0), (2, 0, 1), (None, 1, 0)]).write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, prose(77, 30)), (None, "x"), (2, None)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_odd_rows_and_empty_tables(spark, folder, name, stage):
    docs = odd(spark)
    out = stage(spark, docs, folder)
    rows = out.collect()
    if name != "packing":
        assert out.schema.names == docs.schema.names  # columns with clashing names too
        n_null = sum(r.doc_id is None for r in rows)
        stays = {"quality_rules": None, "near_duplicates": len(ODD), "decontamination": docs.count(), "secret_scan": docs.count()}[name]
        assert stays is None or len(rows) + (1 if name == "near_duplicates" else 0) >= stays - 1
        assert name == "quality_rules" or n_null == 1
        assert {(r.kept, r.words) for r in rows} <= {("k", 1)}
    else:
        assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    none = stage(spark, empty(spark), folder)
    assert none.count() == 0 and none.columns == out.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_registered_queries_on_the_smallest_tables(spark):
    from tidemark.llm import queries

    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, query in queries.queries().items():
        rows = query(spark, SF).cache()
        count = rows.count()
        if "doc_id" in rows.columns and name not in ("op3_packing", "op9_decontamination"):
            assert count == n == rows.select("doc_id").distinct().count(), name
        else:
            assert count > 0 and rows.where(F.lit(True)).columns, name
        rows.unpersist()
