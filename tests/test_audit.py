"""The leakage audit on small builders, honest and leaky."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.audit import Audit, differences
from tidemark.plans import matrix

T0 = datetime(2024, 1, 1)


def day(n, micros=0):
    return T0 + timedelta(days=n, microseconds=micros)


@pytest.fixture
def store(spark):
    facts = spark.createDataFrame([(k, float(10 * k + t), day(t)) for k in (1, 2) for t in range(6)], "k int, v double, known timestamp_ntz")
    targets = spark.createDataFrame([(k, day(t)) for k in (1, 2) for t in range(1, 6)], "k int, cut timestamp_ntz")
    return {"facts": facts, "targets": targets}


def gated(strict):
    def build(store):
        facts = store["facts"].withColumnRenamed("k", "fk")
        known = F.col("known") < F.col("cut") if strict else F.col("known") <= F.col("cut")
        joined = store["targets"].join(facts, (F.col("k") == F.col("fk")) & known, "left")
        return joined.groupBy("k", "cut").agg(F.count("v").alias("n"), F.sum("v").alias("total"))

    return build


def audit(build, store):
    return Audit(build, store, ["k", "cut"], {"facts": "known"}, F.col("cut"))


def planted(spark, at):
    return {"facts": spark.createDataFrame([(1, 5000.0, at)], "k int, v double, known timestamp_ntz")}


def reported(spark, build, store):
    rows = audit(build, store).report(F.lit(day(3)), {"facts": {"v": F.col("v") + 1}}, planted(spark, day(3)), planted(spark, day(3, -1))).collect()
    return {r.check: (r.differing, r.columns, r.passed) for r in rows}


def test_an_honest_builder_passes(spark, store):
    assert reported(spark, gated(True), store) == {"truncation": (0, [], True), "perturbation": (0, [], True), "planted at the cutoff": (0, [], True), "planted before it": (1, ["n"], True)}


def test_knowing_the_instant_itself_is_caught(spark, store):
    got = reported(spark, gated(False), store)
    assert got["perturbation"] == (2, ["total"], False) and got["planted at the cutoff"] == (1, ["n"], False)


def test_knowing_the_future_is_caught(spark, store):
    def build(s):
        return gated(True)(s).join(s["facts"].groupBy("k").agg(F.max("v").alias("best")), "k")

    got = reported(spark, build, store)
    assert got["truncation"] == (4, ["best"], False) and not got["perturbation"][2]


def test_a_builder_that_knows_nothing_fails_the_last_check(spark, store):
    got = reported(spark, lambda s: s["targets"].withColumn("one", F.lit(1)), store)
    assert [got[c][2] for c in ("truncation", "perturbation", "planted at the cutoff", "planted before it")] == [True, True, True, False]


def test_differences_by_kind_and_first_column(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "x"), (3, None, "x"), (None, 4.0, "x"), (5, 5.0, "x"), (6, 6.0, "x")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y"), (3, 0.0, "z"), (None, 4.0, "x"), (6, 6.0, "x"), (6, 6.0, "x"), (7, 7.0, "x")], "k int, v double, s string")
    assert {(r.k, r.kind, r.first_column) for r in differences(a, b, ["k"]).collect()} == {(2, "changed", "s"), (3, "changed", "v"), (5, "missing", None), (6, "repeated", None), (7, "extra", None)}
    assert differences(a, a, ["k"]).count() == 0 == differences(a.limit(0), a.limit(0), ["k"]).count()
    with pytest.raises(ValueError, match="columns"):
        differences(a, b.drop("s"), ["k"])


def test_families_are_chosen_by_name():
    assert matrix.columns_of(["streak", "history"])[:2] == ["n_before", "mean_n"] and len(matrix.columns_of(list(matrix.FEATURES))) >= 55
    with pytest.raises(ValueError, match="nope"):
        matrix.columns_of(["nope", "role"])


def test_a_window_over_everything_is_a_leak(spark, store):
    def build(s):
        ever = F.avg("v").over(Window.partitionBy("k"))
        return s["targets"].join(s["facts"].select(F.col("k").alias("fk"), F.col("known").alias("cut_"), ever.alias("ever")), (F.col("k") == F.col("fk")) & (F.col("cut") == F.col("cut_"))).select("k", "cut", "ever")

    assert not reported(spark, build, store)["truncation"][2]


def test_a_report_builds_the_store_once_and_agrees_with_its_checks(spark, store):
    built = []

    def build(s):
        built.append(s)
        return gated(False)(s).unionByName(gated(True)(s).where("k = 2 AND n > 3")).where("n > 1")

    changes, at, before = {"facts": {"v": F.col("v") + 1}}, planted(spark, day(3)), planted(spark, day(3, -1))
    got = reported(spark, build, store)
    assert len(built) == 5
    a = audit(build, store)
    found = {"truncation": a.truncated(F.lit(day(3))), "perturbation": a.perturbed(F.lit(day(3)), changes), "planted at the cutoff": a.planted(F.lit(day(3)), at), "planted before it": a.planted(F.lit(day(3)), before)}
    for check, rows in found.items():
        rows = rows.collect()
        assert got[check][:2] == (len(rows), sorted({r.first_column for r in rows} - {None}))
