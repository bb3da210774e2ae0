"""Walk-forward linear fits from running sums, nested stages, and seeded searches judged on shared sums."""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def predicted(rows: DataFrame, keys: list[str], period: str, x: str, y: str, name: str) -> DataFrame:
    """rows with column name: y from x by the line fitted on all earlier periods of the row's keys.

    A line needs five sums, so periods are reduced to those, and running sums of periods give every
    refit in one pass. A row of which x or y is NULL teaches nothing; NULL where x is, or before a
    line can be fitted (no earlier rows, or a single x among them).
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = rows.where(a.isNotNull() & b.isNotNull())
    sums = both.groupBy(*keys, period).agg(F.count(F.lit(1)).alias("_n"), F.sum(a).alias("_x"), F.sum(b).alias("_y"), F.sum(a * a).alias("_xx"), F.sum(a * b).alias("_xy"))
    periods = rows.select(*keys, period).distinct().join(sums, [*keys, period], "left")
    past = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, -1)
    n, sx, sy, sxx, sxy = (F.sum(c).over(past) for c in ("_n", "_x", "_y", "_xx", "_xy"))
    slope = (sxy - sx * sy / n) / F.nullif(sxx - sx * sx / n, F.lit(0.0))
    lines = periods.select(*keys, period, slope.alias("_b"), (sx / n).alias("_mx"), (sy / n).alias("_my"))
    return rows.join(lines, [*keys, period], "left").withColumn(name, F.col("_my") + F.col("_b") * (a - F.col("_mx"))).drop("_b", "_mx", "_my")


def two_stages(rows: DataFrame, keys: list[str], period: str, x: str, between: str, y: str) -> DataFrame:
    """rows with stage_one, between from x, and stage_two, y from stage_one; each by earlier periods alone.

    Stage two is fitted on stage one's own out-of-sample predictions, never on its fitted values nor
    on between itself, so what it learns is how far they can be trusted.
    """
    return predicted(predicted(rows, keys, period, x, between, "stage_one"), keys, period, "stage_one", y, "stage_two")


@dataclass(frozen=True)
class Trial:
    """A ridge model: which columns, and the penalty."""

    columns: tuple[int, ...]
    penalty: float


def drawn_trials(n: int, columns: int, penalties: list[float], seed: int) -> list[Trial]:
    """n different trials, or as many as there are, in a seeded order."""
    draw = random.Random(seed)
    every = min(n, ((1 << columns) - 1) * len(penalties))
    out: dict[Trial, None] = {}
    while len(out) < every:
        mask = draw.randrange(1, 1 << columns)
        out[Trial(tuple(i for i in range(columns) if mask >> i & 1), draw.choice(penalties))] = None
    return list(out)


def product_sums(rows: DataFrame, columns: list[Column], held: Column) -> dict[bool, np.ndarray]:
    """Sums of products of (1, columns) over held rows and over the others: one aggregate, whatever the number of trials."""
    named = rows.select(held.alias("held"), F.lit(1.0).alias("c0"), *[c.cast("double").alias(f"c{i + 1}") for i, c in enumerate(columns)]).dropna()
    k = len(columns) + 1
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = named.groupBy("held").agg(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"s{i}_{j}") for i, j in pairs]).collect()
    out = {side: np.zeros((k, k)) for side in (False, True)}
    for r in found:
        for i, j in pairs:
            out[r.held][i, j] = out[r.held][j, i] = r[f"s{i}_{j}"]
    return out


def solved(sums: np.ndarray, trial: Trial) -> np.ndarray:
    """Coefficients of (1, columns) for the last column, 0 for columns that the trial leaves out; the first isn't penalised."""
    use = [0, *[c + 1 for c in trial.columns]]
    left = sums[np.ix_(use, use)] + trial.penalty * np.diag([0.0] + [1.0] * len(trial.columns))
    out = np.zeros(len(sums) - 1)
    out[use] = np.linalg.lstsq(left, sums[use, -1], rcond=None)[0]
    return out


def squared_error(sums: np.ndarray, coefficients: np.ndarray) -> float:
    """The mean squared error on the rows behind the sums."""
    w = np.append(-coefficients, 1.0)
    return float(w @ sums @ w / sums[0, 0]) if sums[0, 0] else float("inf")


@dataclass(frozen=True)
class Judged:
    trial: Trial
    turn: int
    error: float


def halving(rows: DataFrame, columns: list[Column], held: Column, trials: list[Trial], by: Column, shares: tuple[float, ...] = (0.25, 0.5, 1.0)) -> list[Judged]:
    """Successive halving: each round judges the trials left on a larger share of rows, and the better half goes on.

    columns: the predictors, then the target. A share takes the rows whose hash of by is below it,
    so a round's rows are among the next one's. A round is one job, however many trials it judges:
    all of them are solved from the same sums. Returns every trial with the round that it reached and
    its error there; the winner comes first. Ties go by the order of trials.
    """
    place = F.pmod(F.xxhash64(by), F.lit(1 << 20)) / float(1 << 20)
    left, out = list(trials), []
    for turn, share in enumerate(shares, 1):
        sums = product_sums(rows if share >= 1 else rows.where(place < share), columns, held)
        judged = sorted((Judged(t, turn, squared_error(sums[True], solved(sums[False], t))) for t in left), key=lambda j: j.error)
        stay = len(judged) if turn == len(shares) else max(1, -(-len(judged) // 2))
        out += judged[stay:]
        left = [j.trial for j in judged[:stay]]
    return [*judged, *sorted(out, key=lambda j: (-j.turn, j.error))]


@dataclass(frozen=True)
class Variant:
    """A ridge model to be tried: its columns, each row's weight, and the penalty."""

    name: str
    columns: list[str]
    weight: Column
    penalty: float


def weekly_errors(rows: DataFrame, variants: list[Variant], y: str, period: str, periods: list[int]) -> DataFrame:
    """name, period, n and mean squared error of every variant in every period, fitted on earlier periods alone.

    rows: y, the period (whole numbers) and all columns; NULLs count as 0 in columns, and rows
    without y are left out. periods is a short, stated list. One aggregate by period gives the sums
    of products of all variants' columns, from which every fit and every error follows; they reach
    the driver, periods times columns squared.
    """
    spark = rows.sparkSession
    names = [*dict.fromkeys(c for v in variants for c in v.columns), y]
    named = rows.where(F.col(y).isNotNull()).select(F.col(period).cast("int").alias("p"), F.lit(1.0).alias("c0"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"c{i + 1}") for i, c in enumerate(names)])
    k = len(names) + 1
    i, j = np.triu_indices(k)
    found = named.groupBy("p").agg(F.array(*[F.sum(F.col(f"c{a}") * F.col(f"c{b}")) for a, b in zip(i.tolist(), j.tolist(), strict=True)]).alias("s")).collect()
    sums = {}
    for r in found:
        full = np.zeros((k, k))
        full[i, j] = full[j, i] = r.s
        sums[r.p] = full
    pairs = [(p, t) for t in periods for p in sums if p < t and t in sums]
    at = spark.createDataFrame(pairs or [(None, None)], "p int, t int").select("p", "t", F.array(*[v.weight.cast("double") for v in variants]).alias("w"))
    weights = {(r.p, r.t): r.w for r in at.collect()}
    out = []
    for n, v in enumerate(variants):
        use = [0, *[names.index(c) + 1 for c in v.columns], k - 1]
        for t in periods:
            past = [p for p in sums if p < t]
            if t in sums and past:
                taught = sum(weights[p, t][n] * sums[p][np.ix_(use, use)] for p in past)
                own = sums[t][np.ix_(use, use)]
                out.append((v.name, t, int(own[0, 0]), squared_error(own, solved(taught, Trial(tuple(range(len(v.columns))), v.penalty)))))
    return spark.createDataFrame(out, "name string, period int, n long, error double")


def verdicts(errors: DataFrame, primary: str, least_gain: float = 0.0, least_wins: float = 0.5) -> DataFrame:
    """One row a variant: mean gain in error over the primary, its standard error over periods, the share of periods won, and the verdict.

    A variant is adopted if its mean gain exceeds least_gain and two standard errors, and it wins in
    more than least_wins of the periods; it is rejected if its mean gain is below minus two standard
    errors, and open otherwise.
    """
    base = errors.where(F.col("name") == primary).select("period", F.col("error").alias("base"))
    gains = errors.where(F.col("name") != primary).join(base, "period").withColumn("gain", F.col("base") - F.col("error"))
    out = gains.groupBy("name").agg(F.count(F.lit(1)).alias("periods"), F.avg("gain").alias("gain"), (F.stddev_samp("gain") / F.sqrt(F.count(F.lit(1)))).alias("se"), F.avg((F.col("gain") > 0).cast("int")).alias("won"))
    se = 2 * F.coalesce("se", F.lit(0.0))
    verdict = F.when((F.col("gain") > F.greatest(F.lit(least_gain), se)) & (F.col("won") > least_wins), "adopt").when(F.col("gain") < -se, "reject").otherwise("open")
    return out.withColumn("verdict", verdict)
