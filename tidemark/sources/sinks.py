"""Idempotent writes. A path is never overwritten while it is read: the new state is written beside
it, and the pointer to the current state moves only once it is whole."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def anti(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of old whose keys new lacks; NULL keys are equal to each other."""
    other = new.select([F.col(k).alias(k) for k in keys]).distinct()
    return old.join(other, _same(old, other, keys), "left_anti")


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new in place of those with the same keys."""
    return anti(old, new, keys).unionByName(new, allowMissingColumns=True)


def replaced_partitions(old: DataFrame, new: DataFrame, partition: list[str]) -> DataFrame:
    """old with every partition that new has rows of replaced; an empty new changes nothing."""
    return anti(old, new, partition).unionByName(new, allowMissingColumns=True)


def frozen_merged(old: DataFrame, new: DataFrame, keys: list[str], event: str, starts: str, now: Column, margin_minutes: int = 10) -> DataFrame:
    """Rows of events that start by now plus the margin keep their old values; others take the new.

    Adds frozen. New rows of a frozen event, or with a frozen row's keys, are left out.
    """
    frozen = old.where(F.col(starts) <= now + F.make_dt_interval(mins=F.lit(margin_minutes)))
    fresh = anti(anti(new, frozen, keys), frozen, [event])
    return frozen.withColumn("frozen", F.lit(True)).unionByName(fresh.withColumn("frozen", F.lit(False)), allowMissingColumns=True)


class Versioned:
    """A Parquet table of which each write makes a new version; readers see the last whole one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def versions(self) -> list[str]:
        """Whole versions, oldest first: those whose write has left its _SUCCESS mark."""
        store, top = self._files()
        if not store.exists(top):
            return []
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        names = [s.getPath().getName() for s in store.listStatus(top)]
        return sorted(n for n in names if store.exists(path(f"{top.toString()}/{n}/_SUCCESS")))

    def read(self, back: int = 0) -> DataFrame | None:
        """The last version, or the one `back` writes before it."""
        names = self.versions()
        return self.spark.read.parquet(f"{self.root}/versions/{names[-1 - back]}") if len(names) > back else None

    def write(self, df: DataFrame) -> None:
        df.write.parquet(f"{self.root}/versions/{len(self.versions()):08d}-{uuid.uuid4().hex[:8]}")

    def upsert(self, new: DataFrame, keys: list[str]) -> None:
        old = self.read()
        self.write(new if old is None else upserted(old, new, keys))

    def replace(self, new: DataFrame, partition: list[str]) -> None:
        old = self.read()
        if new.limit(1).count():
            self.write(new if old is None else replaced_partitions(old, new, partition))


#: Severities of a run log, mildest first.
SEVERITIES = ("ok", "warning", "error", "crash")


def append_log(df: DataFrame, path: str) -> None:
    """Run log rows are only ever added."""
    df.write.mode("append").parquet(path)


def run_summary(log: DataFrame) -> DataFrame:
    """One row a run: steps, the worst severity (an unknown one counts as error), and the first step that had it.

    log: run, step (whole numbers), severity. A run whose last word is a crash has crash as its worst.
    """
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity")), F.lit(0).cast("long")), F.lit(3).cast("long"))
    worst = log.withColumn("rank", rank).groupBy("run").agg(F.count(F.lit(1)).alias("steps"), F.max(F.struct("rank", (-F.col("step")).alias("s"))).alias("w"))
    return worst.select("run", "steps", F.get(F.array(*[F.lit(s) for s in SEVERITIES]), (F.col("w.rank") - 1).cast("int")).alias("worst"), (-F.col("w.s")).alias("first_step"))


class Results:
    """Built tables kept by what they were built from: a key of names and values, such as table versions and parameters.

    A result lies in a folder named by the key's digest, with the key beside it as readable text; it
    counts only once its write is whole. The same key gives the kept table, another is built anew.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, key: dict[str, object]) -> str:
        text = json.dumps(key, sort_keys=True, default=str)
        return f"{self.root}/{hashlib.sha256(text.encode()).hexdigest()[:32]}"

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def get(self, key: dict[str, object], build: Callable[[], DataFrame]) -> DataFrame:
        path = self.path(key)
        if not self._exists(f"{path}/rows/_SUCCESS"):
            self.spark.createDataFrame([(json.dumps(key, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/key")
            build().write.mode("overwrite").parquet(f"{path}/rows")
        return self.spark.read.parquet(f"{path}/rows")

    def pruned(self, keep: list[dict[str, object]]) -> int:
        """Delete the results of all other keys; returns how many."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        store = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in store.listStatus(target)] if store.exists(target) else []
        gone = [n for n in names if n not in {self.path(k).rsplit("/", 1)[1] for k in keep}]
        for n in gone:
            store.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}"), True)
        return len(gone)


def schema_rows(spark: SparkSession, families: dict[str, list[str]], keys: list[str], labels: list[str], types: dict[str, str]) -> DataFrame:
    """A sidecar of a table of features: column, role (key, label, feature), family and type, one row a column.

    A ValueError names columns of the table that belong to no role, and features that it lacks.
    """
    role = {**dict.fromkeys(keys, ("key", None)), **dict.fromkeys(labels, ("label", None)), **{c: ("feature", f) for f, cs in families.items() for c in cs}}
    if stray := sorted(set(types) ^ set(role)):
        raise ValueError(f"columns of no role, or missing: {', '.join(stray)}")
    return spark.createDataFrame([(c, *role[c], t) for c, t in types.items()], "column string, role string, family string, type string")
