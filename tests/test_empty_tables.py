"""Every registered query on tables without rows gives its columns and does not fail."""

import os

import pytest

import __spark_entry__ as entry
from tidemark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    out = tmp_path_factory.mktemp("empty")
    for name in os.listdir(SF):
        spark.read.parquet(f"{SF}/{name}").limit(0).coalesce(1).write.parquet(f"{out}/{name}")
    return str(out)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_rows(spark, folder, name):
    got = entry.queries()[name](spark, folder)
    assert got.columns
    got.collect()
