"""Keyed streams: the order in which rows come changes nothing."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.streaming import keyed
from tidemark.streaming.events import stream

START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def run(spark, folder, schema, batches, made):
    """Feed batches one by one to a stream of `made` and return what it has written in the end."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        s = stream(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
        made(s).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").collect()


@pytest.mark.parametrize("seed", range(5))
def test_frozen_rows_do_not_depend_on_order(spark, tmp_path, seed):
    keyed.use_keyed_state(spark)
    schema = "k string, ts timestamp, starts timestamp, v double"
    rows = [("a", at(1), at(50), 1.0), ("a", at(30), at(40), 2.0), ("a", at(39), at(40), 3.0), ("a", at(40), at(40), 9.0), ("b", at(5), at(60), 4.0), ("c", at(70), at(65), 5.0), ("d", at(8), at(500), 6.0)]
    random.Random(seed).shuffle(rows)
    end = [[("z", at(h), at(900), 0.0)] for h in (200, 201)]  # moves the watermark on
    got = run(spark, str(tmp_path), schema, [rows[:3], rows[3:], *end], lambda s: keyed.frozen(s, "k", "starts", "v", "72 hours"))
    assert sorted((r.k, r.starts, r.v) for r in got) == [("a", at(40), 3.0), ("b", at(60), 4.0)]


@pytest.mark.parametrize("seed", range(2))
def test_as_of_join_of_streams_equals_a_loop(spark, tmp_path, seed):
    keyed.use_keyed_state(spark)
    draw = random.Random(100)
    facts = [(draw.choice("ab"), None, at(draw.randrange(60)), i, float(i)) for i in range(25)]
    targets = [(draw.choice("abc"), i, at(draw.randrange(1, 60)), None, None) for i in range(12)]
    schema = "k string, target long, ts timestamp, tie long, v double"
    rows = facts + targets
    random.Random(seed).shuffle(rows)
    end = [[("z", None, at(h), 0, 0.0)] for h in (300, 301)]

    def made(s):
        return keyed.as_of(s.where("target IS NOT NULL").withColumnRenamed("ts", "cutoff"), s.where("target IS NULL").withColumnRenamed("ts", "known_at"), "k", "cutoff", "target", "known_at", "v", "tie", "72 hours")

    got = {r.target: (r.k, r.cutoff, r.known_at, r.v) for r in run(spark, str(tmp_path), schema, [rows[:19], rows[19:], *end], made)}
    for k, target, cutoff, *_ in targets:
        before = [(f[2], f[3], f[4]) for f in facts if f[0] == k and f[2] < cutoff]
        best = max(before, default=(None, None, None))
        assert got[target] == (k, cutoff, best[0], best[2])
    assert len(got) == len(targets)
