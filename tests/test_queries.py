"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v.isoformat() if isinstance(v, datetime.datetime) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    if not Path(SF).exists():
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF), duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())


def test_entry(spark, duck):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
