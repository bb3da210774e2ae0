"""Play tables, published lines and matching over tiers against plain loops."""

import random
from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import matching, plays

PLAYS = "game int, team int, opponent int, red boolean, carrier long, on_field array<long>, against array<long>"


def drawn(n=200):
    draw = random.Random(2)
    some = lambda: draw.choice([None, [], draw.sample(range(6), 3), draw.sample(range(6), 3), [1, 1, 2]])
    return [(draw.randrange(3), t := draw.randrange(2), 1 - t, draw.random() < 0.3, draw.choice([None, 0, 1, 2]), some(), some()) for _ in range(n)]


def test_play_tables_equal_plain_counts(spark):
    rows = drawn()
    df = spark.createDataFrame(rows, PLAYS)
    carries, red = Counter((g, t, c) for g, t, _, _, c, *_ in rows if c is not None), Counter((g, t, c) for g, t, _, r, c, *_ in rows if c is not None and r)
    got = {(r.game, r.team, r.player): r for r in plays.usage(df, ["red"]).collect()}
    assert {k: r.carries for k, r in got.items()} == carries and all(r.red == red[k] for k, r in got.items())
    of_team = Counter((g, t) for g, t, _, _, c, *_ in rows if c is not None)
    assert all(r.carries_share == pytest.approx(r.carries / of_team[k[:2]], abs=1e-6) for k, r in got.items())
    totals = {(r.game, r.team): r for r in plays.team_totals(df, ["red"]).collect()}
    for (g, t), r in totals.items():
        mine = [x for x in rows if x[:2] == (g, t)]
        assert (r.plays, r.red, r.plays_known, r.red_known) == (len(mine), sum(x[3] for x in mine), sum(bool(x[5]) for x in mine), sum(bool(x[5]) and x[3] for x in mine))
        assert r.carries == sum(v.carries for k, v in got.items() if k[:2] == (g, t))  # shares' sums are the totals of the plays
    on, known = Counter(), Counter()
    for g, t, o, r, _, own, other in rows:
        for side, team, who in (("own", t, own), ("other", o, other)) if own else ():
            for kind in ["plays"] + ["red"] * r:
                known[g, team, side, kind] += 1
                on.update((g, team, side, p, kind) for p in set(who or []))
    part = plays.participation(df, ["red"]).collect()
    assert {(r.game, r.team, r.side, r.player) for r in part} == {k[:4] for k in on}
    for r in part:
        for kind in ("plays", "red"):
            assert r[f"{kind}_on"] == on[r.game, r.team, r.side, r.player, kind]
            assert r[f"{kind}_on"] + r[f"{kind}_off"] == known[r.game, r.team, r.side, kind]
    assert all(f(df.limit(0), ["red"]).count() == 0 for f in (plays.usage, plays.team_totals, plays.participation))


def test_unpublished_games_say_nothing_and_published_ones_without_a_line_are_zero(spark):
    played = [(1, 10, date(2024, 1, 2)), (1, 11, date(2024, 1, 4)), (1, 12, date(2024, 1, 9)), (2, 10, date(2024, 1, 2))]
    coverage = [(10, date(2024, 1, 5)), (12, date(2024, 1, 12))]  # 11 never comes out
    lines = [(1, 10, 4), (1, 11, 9)]
    targets = [(1, date(2024, 1, 5)), (1, date(2024, 1, 6)), (1, date(2024, 1, 13)), (2, date(2024, 1, 13)), (3, date(2024, 1, 13))]
    out = plays.published_lines(
        spark.createDataFrame(targets, "player int, at date"), spark.createDataFrame(played, "player int, game int, day date"), spark.createDataFrame(coverage, "game int, published date"), spark.createDataFrame(lines, "player int, game int, hits int"), "hits"
    )
    got = {(r.player, r["at"].day): (r.last_value, r.mean_value, r.games) for r in out.collect()}
    assert got == {(1, 5): (None, None, 0), (1, 6): (4, 4.0, 1), (1, 13): (0, 2.0, 2), (2, 13): (0, 0.0, 1), (3, 13): (None, None, 0)}


def plain_match(left, right, tiers):
    """Round by round: pairs of which both sides have exactly one partner."""
    waiting, free, out = dict(left), dict(right), {i: (None, None, "no partner") for i in left}
    for name, cols in tiers.items():
        key = lambda row, cols=cols: None if any(row[c] is None for c in cols) else tuple(row[c] for c in cols)
        lefts, rights = defaultdict(list), defaultdict(list)
        for side, rows in ((lefts, waiting), (rights, free)):
            for i, row in rows.items():
                side[key(row)].append(i)
        for k, ids in lefts.items():
            if k is None or k not in rights:
                continue
            for i in ids:
                if len(ids) == len(rights[k]) == 1:
                    out[i] = (rights[k][0], name, "matched")
                else:
                    out[i] = (None, None, "ambiguous" if len(rights[k]) > 1 else "shared")
        for i, (j, tier, _) in out.items():
            if tier == name:
                del waiting[i], free[j]
    return out


def test_matching_equals_plain_rounds(spark):
    draw = random.Random(8)
    person = lambda: {"name": draw.choice(["ann", "bob", "cy", None]), "club": draw.choice("xyz"), "age": draw.randrange(20, 50)}
    left, right = {i: person() for i in range(80)}, {1000 + i: person() for i in range(30)}
    tiers = {"all": ["name", "club", "age"], "name and club": ["name", "club"], "age": ["age"]}
    frames = [spark.createDataFrame([(i, r["name"], r["club"], r["age"]) for i, r in rows.items()], "id long, name string, club string, age int") for rows in (left, right)]
    columns = {n: [F.col(c) for c in cs] for n, cs in tiers.items()}
    got = {r.left_id: (r.right_id, r.tier, r.reason) for r in matching.matched(frames[0], "id", columns, frames[1], "id", columns).collect()}
    want = plain_match(left, right, tiers)
    assert got == want and {w[2] for w in want.values()} >= {"matched", "ambiguous", "shared"}
    assert {r.reason for r in matching.matched(frames[0], "id", columns, frames[1].limit(0), "id", columns).collect()} == {"no partner"}
    with pytest.raises(ValueError, match="tiers"):
        matching.matched(frames[0], "id", columns, frames[1], "id", {"age": [F.col("age")]})
