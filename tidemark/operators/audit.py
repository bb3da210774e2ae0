"""Leakage audit: a builder is run on altered stores, and rows that must not change are compared by key.

A builder is a function from named tables to rows of keys and features. Each check alters what was
known at or after an instant (cut off, changed, or planted), and no row whose cutoff is at or before
it may differ; the last check plants a row just before the instant, and some row must differ, or
the audit would prove nothing. A report builds the unaltered store once for all checks, and the rows of
all stores meet in one shuffle by key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Store = dict[str, DataFrame]
Builder = Callable[[Store], DataFrame]


def _stacked(tables: list[tuple[Column, DataFrame]], keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The rows of all tables with the name of their side, and the names of the columns that aren't keys."""
    names = [c for c in tables[0][1].columns if c not in keys]
    if any(sorted(names) != sorted(c for c in t.columns if c not in keys) for _, t in tables):
        raise ValueError("the tables have different columns")
    out = None
    for side, t in tables:
        part = t.select(*keys, *names, side.alias("_side"))
        out = part if out is None else out.unionByName(part)
    return out, names


def _met(rows: DataFrame, sides: dict[str, list[str]], keys: list[str], names: list[str]) -> DataFrame:
    """One row a key, of which NULLs are equal: how many rows each side has (_n_side), and one of them (_v_side).

    sides: by name, the values of _side that belong to it. Rows are shuffled by key once; there equal
    ones are added up first, so that what doesn't differ between sides is held once.
    """
    count = {s: F.count_if(F.col("_side").isin(of)).alias(f"_n_{s}") for s, of in sides.items()}
    equal = rows.repartition(*keys).groupBy(*keys, *names).agg(*count.values())
    one = [F.first(F.when(F.col(f"_n_{s}") > 0, F.struct(*names)), ignorenulls=True).alias(f"_v_{s}") for s in sides]
    return equal.groupBy(*keys).agg(*[F.sum(f"_n_{s}").alias(f"_n_{s}") for s in sides], *one)


def _kind(a: str, b: str) -> Column:
    """How side b differs from a in a row of _met; NULL where it doesn't."""
    n, m = F.col(f"_n_{a}"), F.col(f"_n_{b}")
    changed = ~F.col(f"_v_{a}").eqNullSafe(F.col(f"_v_{b}"))
    return F.when(n + m == 0, None).when(m == 0, "missing").when(n == 0, "extra").when((n > 1) | (m > 1), "repeated").when(changed, "changed")


def _first_column(a: str, b: str, names: list[str]) -> Column:
    """The first column in which the rows of two sides differ."""
    return F.coalesce(*[F.when(~F.col(f"_v_{a}.{c}").eqNullSafe(F.col(f"_v_{b}.{c}")), c) for c in names], F.lit(None).cast("string"))


def differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in which b differs from a: keys, kind (missing, extra, changed), and the first column that does.

    A key with several rows in either table is of kind repeated. Columns must have the same names.
    """
    rows, names = _stacked([(F.lit("a"), a), (F.lit("b"), b)], keys)
    met = _met(rows, {"a": ["a"], "b": ["b"]}, keys, names).withColumn("kind", _kind("a", "b")).where("kind IS NOT NULL")
    return met.select(*keys, "kind", F.when(F.col("kind") == "changed", _first_column("a", "b", names)).alias("first_column"))


@dataclass
class Audit:
    """What a builder is audited with.

    known_at: each table's column of the instant at which its rows became known; a table without
    one is left as it is. cutoff: of a built row, the instant before which it may know things.
    """

    build: Builder
    store: Store
    keys: list[str]
    known_at: dict[str, str]
    cutoff: Column

    def _rows(self, store: Store, instant: Column, strictly: bool = False) -> DataFrame:
        return self.build(store).where(self.cutoff < instant if strictly else self.cutoff <= instant)

    def _cut(self, instant: Column) -> Store:
        return {n: t.where(F.col(self.known_at[n]) < instant) if n in self.known_at else t for n, t in self.store.items()}

    def _changed(self, instant: Column, changes: dict[str, dict[str, Column]]) -> Store:
        changed = dict(self.store)
        for n, columns in changes.items():
            t = changed[n]
            changed[n] = t.withColumns({c: F.when(F.col(self.known_at[n]) >= instant, v.cast(t.schema[c].dataType)).otherwise(F.col(c)) for c, v in columns.items()})
        return changed

    def _with(self, rows: Store) -> Store:
        return {n: t.unionByName(rows[n], allowMissingColumns=True) if n in rows else t for n, t in self.store.items()}

    def truncated(self, instant: Column) -> DataFrame:
        """Rows with an earlier cutoff that differ if what was known from the instant on is cut off.

        Rows at the instant itself may owe their being there to what is cut off, so perturbed()
        has those.
        """
        return differences(self._rows(self.store, instant, True), self._rows(self._cut(instant), instant, True), self.keys)

    def perturbed(self, instant: Column, changes: dict[str, dict[str, Column]]) -> DataFrame:
        """Rows with a cutoff up to the instant that differ if columns known from it on are changed."""
        return differences(self._rows(self.store, instant), self._rows(self._changed(instant, changes), instant), self.keys)

    def planted(self, instant: Column, rows: Store) -> DataFrame:
        """Rows with a cutoff up to the instant that differ if further rows are put into tables."""
        return differences(self._rows(self.store, instant), self._rows(self._with(rows), instant), self.keys)

    def report(self, instant: Column, changes: dict[str, dict[str, Column]], at: Store, before: Store) -> DataFrame:
        """One row a check: check, differing rows, the columns in which rows first differ, and whether it is passed.

        changes: what to alter from the instant on; at and before: rows to plant exactly at the
        instant, and just before it. Only the row planted before it may, and must, show.
        """
        base = self._rows(self.store, instant)
        early = F.when(self.cutoff < instant, "early").otherwise("late")
        cut, changed = self._rows(self._cut(instant), instant, True), self._rows(self._changed(instant, changes), instant)
        planted = {side: self._rows(self._with(rows), instant) for side, rows in (("at", at), ("before", before))}
        rows, names = _stacked([(early, base), (F.lit("cut"), cut), (F.lit("changed"), changed), *[(F.lit(s), t) for s, t in planted.items()]], self.keys)
        met = _met(rows, {"base": ["early", "late"], "early": ["early"], **{s: [s] for s in ("cut", "changed", *planted)}}, self.keys, names)
        checks = {"truncation": ("early", "cut", False), "perturbation": ("base", "changed", False), "planted at the cutoff": ("base", "at", False), "planted before it": ("base", "before", True)}
        kinds = met.select("*", *[_kind(a, b).alias(f"_kind_{b}") for a, b, _ in checks.values()])
        found = kinds.agg(*[F.count(f"_kind_{b}").alias(f"_differing_{b}") for _, b, _ in checks.values()], *[F.collect_set(F.when(F.col(f"_kind_{b}") == "changed", _first_column(a, b, names))).alias(f"_columns_{b}") for a, b, _ in checks.values()])
        lines = [F.struct(F.lit(n).alias("check"), F.col(f"_differing_{b}").alias("differing"), F.array_sort(f"_columns_{b}").alias("columns"), ((F.col(f"_differing_{b}") > 0) == F.lit(wanted)).alias("passed")) for n, (_, b, wanted) in checks.items()]
        return found.select(F.inline(F.array(*lines)))
