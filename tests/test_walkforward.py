"""Nested walk-forward stages and seeded searches against plain fits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import candidates
from tidemark.operators import walkforward

ROWS = "k string, t int, x double, m double, y double, i int"


def drawn(n=240):
    draw = random.Random(4)
    out = []
    for i in range(n):
        x = draw.random() * 10
        m = 3 * x + draw.gauss(0, 1)
        out.append(("ab"[i % 2], 1 + i // 40, x, m if i % 17 else None, 2 * m + draw.gauss(0, 1), i))
    return out


def line(points):
    """(slope, mean x, mean y) or None."""
    if len({p[0] for p in points}) < 2:
        return None
    x, y = np.array(points).T
    b = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()
    return b, x.mean(), y.mean()


def plain(rows):
    one, two = {}, {}
    for k, t, x, *_, i in rows:
        fit = line([(a, m) for kk, tt, a, m, *_ in rows if kk == k and tt < t and m is not None])
        one[i] = fit and fit[2] + fit[0] * (x - fit[1])
    for k, t, *_, i in rows:
        fit = line([(one[j], y) for kk, tt, _, _, y, j in rows if kk == k and tt < t and one[j] is not None])
        two[i] = fit and one[i] is not None and fit[2] + fit[0] * (one[i] - fit[1])
    return one, two


def test_two_stages_equal_plain_fits(spark):
    rows = drawn()
    one, two = plain(rows)
    for r in walkforward.two_stages(spark.createDataFrame(rows, ROWS), ["k"], "t", "x", "m", "y").collect():
        for got, want in ((r.stage_one, one[r.i]), (r.stage_two, two[r.i])):
            assert got is None if not want else got == pytest.approx(want)
    assert sum(bool(v) for v in two.values()) == 160  # periods 1 and 2 have none


def test_later_labels_change_no_earlier_row(spark):
    rows = drawn()
    changed = [(k, t, x, m + 100 if t >= 4 and m is not None else m, y - 50 if t >= 4 else y, i) for k, t, x, m, y, i in rows]
    got = [{r.i: (r.stage_one, r.stage_two) for r in walkforward.two_stages(spark.createDataFrame(v, ROWS), ["k"], "t", "x", "m", "y").collect()} for v in (rows, changed)]
    close = lambda i: all(a is b is None or (a is not None and b is not None and a == pytest.approx(b, rel=1e-9)) for a, b in zip(got[0][i], got[1][i], strict=True))  # noqa: E731  sums may be added in another order
    assert all(close(i) for _, t, *_, i in rows if t <= 4) and not any(close(i) for _, t, *_, i in rows if t > 4)


def test_search_finds_what_the_whole_grid_finds(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 4))
    y = x @ [2.0, 0.0, -1.0, 0.0] + draw.normal(size=3000) * 0.3
    df = spark.createDataFrame([(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "i int, a double, b double, c double, d double, y double")
    columns, held = [F.col(c) for c in "abcdy"], F.col("i") % 4 == 0
    penalties = [0.0, 10.0, 1000.0, 100_000.0]
    trials = walkforward.drawn_trials(60, 4, penalties, 1)
    assert len(set(trials)) == 60 == len(walkforward.drawn_trials(999, 4, penalties, 1)) and trials == walkforward.drawn_trials(60, 4, penalties, 1)
    judged = walkforward.halving(df, columns, held, trials, F.col("i"))
    test = np.arange(3000) % 4 == 0
    errors = {}
    for t in trials:
        use = list(t.columns)
        a = np.hstack([np.ones((3000, 1)), x[:, use]])
        w = np.linalg.solve(a[~test].T @ a[~test] + t.penalty * np.diag([0.0] + [1.0] * len(use)), a[~test].T @ y[~test])
        errors[t] = ((y[test] - a[test] @ w) ** 2).mean()
    assert judged[0].trial == min(trials, key=errors.get) and judged[0].error == pytest.approx(errors[judged[0].trial])
    assert len(judged) == 60 and [sum(j.turn == k for j in judged) for k in (1, 2, 3)] == [30, 15, 15]
    assert walkforward.halving(df.limit(0), columns, held, trials[:2], F.col("i"))[0].error == float("inf")


FAMILIES = {"role": ["rank", "share"], "history": ["n", "mean"]}


@pytest.mark.parametrize(
    ("text", "columns"),
    [("+family:role", ["n", "x", "rank", "share"]), ("-family:history", ["x"]), ("+cols: share, n", ["n", "x", "share"]), ("-cols:n", ["x"]), ("recent:4", ["n", "x"]), ("param:penalty=5", ["n", "x"])],
)
def test_candidates_change_columns(text, columns):
    assert candidates.parsed(text, FAMILIES, ("penalty",)).applied(["n", "x"]) == columns


@pytest.mark.parametrize("text", ["", "recent", "recent:", "recent:0", "recent:2x0", "recent:two", "+family:nope", "+cols:n,nope", "-cols:nope", "param:depth=3", "param:penalty", "param:penalty=much", "grow:3", "+family role"])
def test_wrong_candidates_are_named(text):
    with pytest.raises(ValueError, match=repr(text).replace("+", r"\+")):
        candidates.parsed(text, FAMILIES, ("penalty",))


def test_weights_of_recent_periods(spark):
    df = spark.range(1, 7).withColumn("w", candidates.parsed("recent:2x3.5", {}).weight(F.col("id"), F.lit(6)))
    assert [r.w for r in df.orderBy("id").collect()] == [1.0] * 4 + [3.5] * 2
    assert candidates.parsed("recent:3", {}).factor == candidates.RECENT and candidates.parsed("param:k=2", {}, ("k",)).value("k", 9) == 2 and candidates.parsed("param:k=2", {}, ("k",)).value("j", 9) == 9


def test_weekly_errors_and_verdicts(spark):
    draw = np.random.default_rng(7)
    week, a, b = draw.integers(1, 6, 500), draw.normal(size=500), draw.normal(size=500)
    y = 2 * a + 3 * b + draw.normal(size=500) * 0.1
    df = spark.createDataFrame([(int(w), float(p), float(q), float(v)) for w, p, q, v in zip(week, a, b, y, strict=True)], "week int, a double, b double, y double")
    weight = candidates.parsed("recent:2x3", {}).weight(F.col("p"), F.col("t") - 1)
    tried = [walkforward.Variant("primary", ["a"], F.lit(1.0), 0.0), walkforward.Variant("+cols:b", ["a", "b"], F.lit(1.0), 0.0), walkforward.Variant("recent:2x3", ["a"], weight, 5.0), walkforward.Variant("param", ["a"], F.lit(1.0), 1e6)]
    errors = walkforward.weekly_errors(df, tried, "y", "week", [1, 3, 5])
    got = {(r.name, r.period): (r.n, r.error) for r in errors.collect()}
    for name, cols, w_of, penalty in (("primary", [a], lambda p, t: 1.0, 0.0), ("+cols:b", [a, b], lambda p, t: 1.0, 0.0), ("recent:2x3", [a], lambda p, t: np.where(p > t - 3, 3.0, 1.0), 5.0)):
        assert (name, 1) not in got
        for t in (3, 5):
            x, past, now = np.stack([np.ones(500), *cols], axis=1), week < t, week == t
            w = np.broadcast_to(w_of(week[past], t), past.sum())
            left = (x[past] * w[:, None]).T @ x[past] + penalty * np.diag([0.0] + [1.0] * len(cols))
            c = np.linalg.solve(left, (x[past] * w[:, None]).T @ y[past])
            assert got[name, t] == (now.sum(), pytest.approx(((y[now] - x[now] @ c) ** 2).mean()))
    verdict = {r.name: r.verdict for r in walkforward.verdicts(errors, "primary").collect()}
    assert verdict["+cols:b"] == "adopt" and verdict["param"] == "reject"
