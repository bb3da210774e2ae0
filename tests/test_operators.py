import hashlib
import itertools
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import aggregates, gate, joins, windows
from tidemark.sources import sinks
from tidemark.sources.tables import nan_to_null, optional, overlaid
from tidemark.streaming import events as streaming


def test_gate_hides_the_cutoff_itself(spark):
    at = datetime(2024, 1, 10)
    targets = spark.createDataFrame([(1, "x", at), (2, "y", at)], "t int, k string, cutoff timestamp")
    past = spark.createDataFrame([("x", at, 1), ("x", datetime(2024, 1, 9, 23, 59, 59, 999999), 2), ("x", datetime(2024, 1, 1), 3)], "k string, known timestamp, v int")
    newest = {r.t: r.v for r in gate.latest_before(targets, past, ["k"], "cutoff", "known", ["v"], "v").collect()}
    assert newest == {1: 2, 2: None}
    loose = {r.t: r.v for r in gate.latest_before(targets, past, ["k"], "cutoff", "known", ["v"], "v", strict=False).collect()}
    assert loose == {1: 1, 2: None}
    counts = {r.t: r.n for r in gate.history(targets, past, ["k"], "cutoff", "known", [F.count("v").alias("n")], ["t"]).collect()}
    assert counts == {1: 2, 2: 0}


def test_gate_result_does_not_change_on_truncated_input(spark):
    rows = [("x", datetime(2024, 1, d), d) for d in range(1, 20)]
    past = spark.createDataFrame(rows, "k string, known timestamp, v int")
    targets = past.select(F.col("v").alias("t"), "k", F.col("known").alias("cutoff")).where("t <= 10")
    full = gate.latest_before(targets, past, ["k"], "cutoff", "known", ["v"], "v")
    cut = gate.latest_before(targets, gate.truncated(past, "known", F.lit(datetime(2024, 1, 10))), ["k"], "cutoff", "known", ["v"], "v")
    assert full.exceptAll(cut).count() == 0 and cut.exceptAll(full).count() == 0


def test_run_length_stops_at_zero_and_null(spark):
    rows = [("a", 1, 1.0), ("a", 2, -1.0), ("a", 3, -2.0), ("b", 1, 1.0), ("b", 2, None), ("c", 1, 3.0), ("c", 2, 1.0)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    assert {r.k: r.run for r in windows.run_length(df, ["k"], [F.col("i")], "v", 6).collect()} == {"a": -2, "b": 0, "c": 2}


def test_rank_average_and_spearman(spark):
    df = spark.createDataFrame([("g", 1.0, 1.0), ("g", 1.0, 2.0), ("g", 2.0, 3.0), ("h", 1.0, 1.0)], "g string, x double, y double")
    assert sorted(r.r for r in df.select(windows.rank_average(["g"], "x").alias("r")).collect()) == [1.0, 1.5, 1.5, 3.0]
    assert [r.g for r in aggregates.spearman(df, ["g"], "x", "y", 3).collect()] == ["g"]


def test_pair_accuracy_counts_every_pair(spark):
    rng = np.random.default_rng(5)
    rows = [(g, int(y), int(p)) for g, n in (("a", 1), ("b", 2), ("c", 90), ("d", 40)) for y, p in zip(rng.integers(0, 30, n), rng.integers(0, 12, n), strict=True)]
    rows += [("e", 1, 1), ("e", 1, 2), ("f", None, 1), ("f", 2, None), ("f", 3, 3)]
    want = {}
    for (g, y, p), (h, z, q) in itertools.combinations(rows, 2):
        if g == h and None not in (y, p, z, q) and y != z:
            n, c = want.get(g, (0, 0.0))
            want[g] = n + 1, c + (0.5 if p == q else float((p < q) == (y < z)))
    got = aggregates.pair_accuracy(spark.createDataFrame(rows, "g string, y int, p int"), ["g"], "y", "p").collect()
    assert {r.g: (r.pairs, r.credit) for r in got} == want


def test_pair_accuracy_deals_a_group_over_tasks(spark):
    df = spark.range(3000).select(F.lit("a").alias("g"), F.col("id").alias("y"), (F.col("id") * 7 % 3001).alias("p"))
    out = aggregates.pair_accuracy(df, ["g"], "y", "p")
    assert out.first().pairs == 3000 * 2999 // 2
    shuffles = [x for x in out._jdf.queryExecution().executedPlan().toString().split("\n") if "hashpartitioning(" in x]
    assert any("_bit" in x and "_part" in x for x in shuffles)


def test_rank_of_all_is_the_rank_of_one_window(spark):
    rng = np.random.default_rng(6)
    values = [*[float(v) for v in rng.integers(0, 400, 900)], *[7.0] * 300, None, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    for parts in (1, 7, 200):
        for r in windows.rank_of_all(df, "v", "place", parts).collect():
            assert r.place == 1 + (sum(v is not None for v in values) if r.v is None else sum(v is not None and v > r.v for v in values))
    assert windows.rank_of_all(df.limit(0), "v", "place").count() == 0


def test_simplex_and_least_squares(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 3 + 1).cast("double").alias("b")).withColumn("y", 0.25 * F.col("a") + 0.75 * F.col("b"))
    assert aggregates.simplex_weights(df, ["a", "b"], "y") == pytest.approx([0.25, 0.75])
    assert aggregates.least_squares(df, ["a"], "b") == pytest.approx([1.0, 3.0])


def test_names_and_ids(spark):
    df = spark.createDataFrame([("8151.0", "D.J. O'Neil-Smith Jr."), ("nan", ""), (None, None), (" 7 ", "Ann  III")], "i string, n string")
    rows = df.select(S.norm_id(F.col("i")).alias("i"), S.name_key(F.col("n")).alias("n")).collect()
    assert [tuple(r) for r in rows] == [("8151", "dj oneil smith"), (None, ""), (None, None), ("7", "ann")]


def test_upsert_and_replace_twice_change_nothing(spark, tmp_path):
    table = sinks.Versioned(spark, f"file://{tmp_path}/t")
    old = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "b", 3)], "p int, k string, v int")
    new = spark.createDataFrame([(1, None, 9), (3, "c", 4)], "p int, k string, v int")
    table.upsert(old, ["p", "k"])
    table.upsert(new, ["p", "k"])
    once = sorted(map(tuple, table.read().collect()), key=repr)
    table.upsert(new, ["p", "k"])
    assert once == sorted(map(tuple, table.read().collect()), key=repr) == sorted([(1, "a", 1), (1, None, 9), (2, "b", 3), (3, "c", 4)], key=repr)
    table.replace(spark.createDataFrame([(1, "z", 0)], "p int, k string, v int"), ["p"])
    assert sorted(r.k for r in table.read().collect()) == ["b", "c", "z"]
    table.replace(new.limit(0), ["p"])
    assert table.read().count() == 3 and table.read(back=1).count() == 4


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k int, v double")
    assert [r.v for r in nan_to_null(df).orderBy("k").collect()] == [None, 1.0]
    assert optional(spark, f"file://{tmp_path}/none", df.schema).count() == 0
    assert sorted(r.v for r in overlaid(df.where("k = 2"), df.withColumn("v", F.lit(5.0)), ["k"]).collect()) == [1.0, 5.0]


def test_stream_upsert_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1), 5), (2, datetime(2024, 1, 2), 6), (2, datetime(2024, 1, 1), 1)], "id int, ts timestamp, v int")
    rows.write.parquet(f"{tmp_path}/in")
    for turn in range(2):
        s = streaming.stream(spark, f"{tmp_path}/in", rows.schema)
        streaming.upserting(s, f"file://{tmp_path}/out", ["id"], f"{tmp_path}/check{turn}").awaitTermination()
    assert sorted((r.id, r.v) for r in sinks.Versioned(spark, f"file://{tmp_path}/out").read().collect()) == [(1, 5), (2, 6)]


def test_stream_windows_drop_late_rows(spark, tmp_path):
    schema = "id int, ts timestamp"
    for k, day in enumerate((1, 10, 1)):
        spark.createDataFrame([(k, datetime(2024, 1, day, 5))], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        s = streaming.stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
        counts = streaming.tumbling(s, [], "1 day", "1 hour")
        counts.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.start, r.n) for r in out] == [(datetime(2024, 1, 1), 1)]


def test_bootstrap_equals_plain_draws(spark):
    rows = [(f"day {k:02}", 3 + k % 4, float(k * k % 17 - 8)) for k in range(12)]
    got = aggregates.blocked_bootstrap(spark.createDataFrame(rows, "block string, n long, diff double").repartition(3), 200, 5).first()
    means = []
    for draw in range(200):
        picks = [rows[int(hashlib.md5(f"5-{draw}-{k}".encode()).hexdigest()[:8], 16) % 12] for k in range(12)]
        means.append(sum(r[2] for r in picks) / sum(r[1] for r in picks))
    assert got["mean"] == pytest.approx(sum(r[2] for r in rows) / sum(r[1] for r in rows))
    assert (got.low, got.high) == (pytest.approx(np.quantile(means, 0.025)), pytest.approx(np.quantile(means, 0.975)))
    assert tuple(aggregates.blocked_bootstrap(spark.createDataFrame([], "block string, n long, diff double"), 20, 5).first()) == (None, None, None)


def test_nearest_in_time_is_the_closest_of_all(spark):
    rng = np.random.default_rng(4)
    left = [(int(k), int(t), i) for i, (k, t) in enumerate(zip(rng.integers(0, 4, 60), rng.integers(0, 100, 60), strict=True))]
    right = [(int(k), int(t), 1000 + i) for i, (k, t) in enumerate(zip(rng.integers(0, 3, 40), rng.integers(0, 100, 40), strict=True))]
    got = {r.i: (r.other, r.gap) for r in joins.nearest(spark.createDataFrame(left, "k int, t long, i int"), spark.createDataFrame(right, "k int, t long, other long"), "k", "t", "other", 5).collect()}
    want = {}
    for k, t, i in left:
        near = sorted((abs(t - s), o) for kk, s, o in right if kk == k and abs(t - s) <= 5)
        if near:
            want[i] = (near[0][1], near[0][0])
    assert got == want and len(want) > 10
