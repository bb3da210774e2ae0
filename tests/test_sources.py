"""Readers and sinks on files: ids as text, damaged payloads, run logs, kept results and schema sidecars."""

import pytest
from pyspark.sql import types as T

from tidemark.plans import matrix
from tidemark.sources import sinks, tables


def test_csv_keeps_ids_as_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,n,x\n0815,3,1.5\n8151.0,,bad\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType())])
    assert [tuple(r) for r in tables.typed_csv(spark, f"file://{tmp_path}/t.csv", ["id"], schema).collect()] == [("0815", 3, 1.5), ("8151.0", None, None)]


def test_damaged_json_gives_its_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1, "more": [2]}')
    (tmp_path / "b.json").write_text("{broken")
    rows = {(r.k, r._corrupt_record) for r in tables.json_rows(spark, f"file://{tmp_path}/*.json", T.StructType([T.StructField("k", T.LongType())])).collect()}
    assert rows == {(1, None), (None, "{broken")}


def test_run_logs_are_added_to_and_summed_up(spark, tmp_path):
    kind = "run int, step int, severity string"
    for rows in ([(1, 1, "ok"), (1, 2, "warning"), (1, 3, "warning")], [(2, 1, "ok"), (3, 1, "odd"), (3, 2, "crash"), (3, 3, "ok")]):
        sinks.append_log(spark.createDataFrame(rows, kind), f"file://{tmp_path}/log")
    got = {r.run: (r.steps, r.worst, r.first_step) for r in sinks.run_summary(spark.read.parquet(f"file://{tmp_path}/log")).collect()}
    assert got == {1: (3, "warning", 2), 2: (1, "ok", 1), 3: (3, "crash", 2)}
    assert sinks.run_summary(spark.createDataFrame([(4, 1, "odd")], kind)).first().worst == "error"


def test_results_are_built_once_a_key(spark, tmp_path):
    made = []
    results = sinks.Results(spark, f"file://{tmp_path}/kept")

    def build(n):
        made.append(n)
        return spark.range(n)

    one, two = {"table": "orders", "version": 3}, {"version": 4, "table": "orders"}
    assert results.get(one, lambda: build(3)).count() == 3 == results.get(dict(reversed(one.items())), lambda: build(9)).count()
    assert results.get(two, lambda: build(4)).count() == 4 and made == [3, 4]
    assert results.pruned([two]) == 1 and results.get(one, lambda: build(5)).count() == 5 and made == [3, 4, 5]
    with pytest.raises(RuntimeError):
        results.get({"k": 1}, lambda: (_ for _ in ()).throw(RuntimeError("fails")))
    assert results.get({"k": 1}, lambda: build(2)).count() == 2  # a build that failed left nothing that counts


def test_sidecar_names_every_column(spark):
    types = dict.fromkeys([*matrix.KEYS, *matrix.LABELS, *matrix.columns_of(list(matrix.FEATURES))], "double")
    rows = {r.column: (r.role, r.family) for r in sinks.schema_rows(spark, matrix.FEATURES, matrix.KEYS, matrix.LABELS, types).collect()}
    assert rows["day"] == ("key", None) and rows["y"] == ("label", None) and rows["vacated"] == ("feature", "role") and len(rows) == len(types)
    for bad in ({**types, "stray": "int"}, {c: t for c, t in types.items() if c != "edge"}):
        with pytest.raises(ValueError, match="stray|edge"):
            sinks.schema_rows(spark, matrix.FEATURES, matrix.KEYS, matrix.LABELS, bad)
