"""Queries whose whole job shows only on rows that the given tables lack, against their SQL on made-up tables."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries when this file is run alone
from tidemark.plans import audits, matrix
from tidemark.plans.registry import QUERIES, SQL


def both(spark, tmp_path, name, tables):
    con = duckdb.connect()
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, str(tmp_path)).select(*want.columns)
    return sorted(map(tuple, got.collect()), key=repr), sorted(want.fetchall(), key=repr)


def test_blockers_are_all_rows_ahead(spark, tmp_path):
    rows = [(k, f"Näme {k}", 1, float(k // 2 - 3)) for k in range(20)]  # ties, some below 0, chains of over five
    rows += [(30, "a", 2, 1.0), (31, None, 2, 5.0), (32, None, 2, 6.0), (33, "b", 2, 2.0), (40, "c", None, 1.0), (41, "d", None, 2.0), (42, "e", 2, None)]
    got, want = both(spark, tmp_path, "r13_blockers", {"supplier": (rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")})
    assert got == want
    assert max(r[1].count("; ") for r in got if r[1]) == 17


def test_difference_is_of_all_orders(spark, tmp_path):
    customers = [(k,) for k in (1, 2, 2, 3, 4, None)]
    orders = [(1, "1-URGENT", "P"), (2, "5-LOW", "O"), (9, "1-URGENT", "P")]
    got, want = both(spark, tmp_path, "u02_difference", {"customer": (customers, "c_custkey long"), "orders": (orders, "o_custkey long, o_orderpriority string, o_orderstatus string")})
    assert got == want == [(3,), (4,), (None,)]


def test_pairs_without_a_prediction_count(spark, tmp_path):
    at, nan = lambda d: datetime(1995, 1, d, 7), float("nan")
    rows = [(k, k * 7 % 11 if k % 5 else None, float(k * k % 13), at(1 + k % 2)) for k in range(60)]
    rows += [(100, None, 1.0, at(5)), (101, 4, 2.0, at(5)), (102, None, 1.0, at(6)), (103, 3, 2.0, at(6)), (104, 5, 3.0, at(6)), (105, 1, 2.0, at(7)), (106, 2, 2.0, at(7))]
    rows += [(110, 3, None, at(1)), (111, 3, 4.0, None), (112, 3, 5.0, None), (None, 3, 5.0, at(1)), (None, 4, 6.0, at(1)), (114, 3, nan, at(1)), (115, 9, nan, at(1)), (116, None, nan, at(1))]
    rows += [rows[1], rows[3], (7, 2, 40.0, at(2)), (7, 9, 1.0, at(2)), (10, 2, 4.5, at(1)), (11, None, 0.5, at(2))]  # copies, and one key with several prices
    got, want = both(spark, tmp_path, "j13_pair_accuracy", {"orders": (rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz")})
    assert got == want and got[2:] == [("1995-01-05", 1, None), ("1995-01-06", 3, 1.0)]


def events(odd=True):
    """Users with many events, one event, none for weeks, and where odd: without a stamp, with only such ones, without a user, below 0."""
    rows = [(k, datetime(2024, 1, 1 + k * 7 % 29, k % 24, k % 60), k * k % 37, ("view", "error", "purchase", "click", "signup")[k % 5], float(k % 50) + 0.25) for k in range(300)]
    rows += [(300, datetime(2024, 1, 5, 23), 48, "view", 1.0), (301, datetime(2024, 1, 12), 49, "error", 4.0), (302, datetime(2024, 1, 30), 50, "purchase", 2.0)]
    if odd:
        rows += [(310 + k, None, (3, 4, 64, 65, 66, 66)[k], "view", 3.0) for k in range(6)] + [(320, datetime(2024, 1, 9), None, "error", 1.0), (321, None, None, "view", 1.0), (322, datetime(2024, 1, 9), -5, "click", 1.0)]
    return [(*r, '{"k": 1}') for r in rows], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@pytest.mark.parametrize("name", ["g24_matrix", "g15_streak", "g22_opponent_out"])
def test_the_matrix_of_odd_events(spark, tmp_path, name):
    got, want = both(spark, tmp_path, name, {"events": events()})
    assert got == want and len(got) > 100


def test_targets_of_the_matrix_pass_two_shuffles(spark):
    plan = matrix.matrix_of(spark.createDataFrame(*events()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2 and "SortMergeJoin" not in plan


def test_the_leaky_copy_passes_no_further_shuffle(spark):
    rows = spark.createDataFrame(*events())
    got = audits.leaky({"events": rows})
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 2
    full = matrix.matrix_of(rows)
    ever = {r.user_id: r.m for r in full.groupBy("user_id").agg(F.round(F.avg("y"), 6).alias("m")).collect()}
    want = {(r.user_id, r.day): (r.y, ever[r.user_id]) for r in full.collect()}
    assert {(r.user_id, r.day): (r.today, r.mean_ever) for r in got.collect()} == want
