"""Audits of the feature matrix and of a copy that leaks on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.audit import Audit, Builder, Store
from tidemark.plans import matrix
from tidemark.plans.registry import query
from tidemark.sources.tables import table

CUT = "2024-01-15"


def features(store: Store) -> DataFrame:
    """The matrix without its labels, which are of the day itself."""
    return matrix.matrix_of(store["events"]).drop(*matrix.LABELS)


def leaky(store: Store) -> DataFrame:
    """A copy with two leaks: the day's own count, and a mean over all days of the user."""
    ever = F.avg("n").over(Window.partitionBy("user_id"))
    return matrix.matrix_of(store["events"], {"today": F.col("n"), "mean_ever": F.round(ever, 6)}).drop(*matrix.LABELS)


def audited(spark: SparkSession, d: str, build: Builder) -> DataFrame:
    """The report on a builder at CUT; planted events are of the user with the smallest id of that day's."""
    events = table(spark, d, "events")
    instant = F.lit(CUT).cast("timestamp_ntz")
    there = events.where(F.to_date("ts") == F.lit(CUT).cast("date")).groupBy().agg(F.min("user_id").alias("user_id"), F.min("event_id").alias("event_id"))
    row = there.select((-F.col("event_id") - 1).alias("event_id"), "user_id", F.lit("error").alias("event_type"), F.lit(1000.0).alias("value"), F.lit('{"k": 1}').alias("props"))
    at, before = (row.withColumn("ts", F.lit(t).cast("timestamp_ntz")).select(*events.columns) for t in (f"{CUT} 00:00:00", "2024-01-14 23:59:59.999999"))
    swapped = F.when(F.col("event_type") == "error", "view").otherwise("error")
    audit = Audit(build, {"events": events}, matrix.KEYS, {"events": "ts"}, F.col("day").cast("timestamp_ntz"))
    return audit.report(instant, {"events": {"value": F.col("value") * 3 + 7, "event_type": swapped}}, {"events": at}, {"events": before})


@query("""select unnest(['truncation', 'perturbation', 'planted at the cutoff', 'planted before it']) as "check", unnest([true, true, true, true]) as passed, unnest([false, false, false, true]) as differs from (select count(*) as n from events) where n > 0""")
def y12_audit(spark: SparkSession, d: str) -> DataFrame:
    """Whether the matrix passes each check of the leakage audit at one instant."""
    return audited(spark, d, features).select("check", "passed", (F.col("differing") > 0).alias("differs"))


@query("""select unnest(['truncation', 'perturbation', 'planted at the cutoff', 'planted before it']) as "check", unnest([false, true, false, true]) as passed, unnest(['mean_ever', null, 'mean_ever,today', null]) as leak from (select count(*) as n from events) where n > 0""")
def y12_leaky_audit(spark: SparkSession, d: str) -> DataFrame:
    """The same audit of a builder that leaks: which check catches it, and in which of the leaking columns rows first differ."""
    caught = F.array_join(F.array_sort(F.array_intersect("columns", F.array(F.lit("today"), F.lit("mean_ever")))), ",")
    return audited(spark, d, leaky).select("check", "passed", F.when(~F.col("passed"), caught).alias("leak"))
