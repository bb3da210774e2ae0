"""Payloads of leagues: parts that are missing, damaged or of another type."""

from tidemark.sources import payloads

TEXTS = [
    (1, '{"id": 1, "settings": {"slots": {"RB": 2, "BENCH": 5}, "weights": {"yards": 0.1, "score": 6}}, "teams": [{"id": 7, "players": [{"id": 70, "slot": "RB", "points": {"1": 3.5, "2": 0}}, {"id": 71, "slot": "BENCH"}]}], "schedule": [{"id": 1, "home": {"team": 7, "points": {"15": 90.5, "16": 80}}, "away": {"team": 8, "points": {"15": 91, "16": 70}}}, {"id": 2, "home": {"team": 7, "points": {"17": 1}}}]}'),
    (2, '{"schedule": "none yet", "teams": [], "settings": {}}'),
    (3, "{damaged"),
    (4, None),
    (5, '{"schedule": [{"id": 9, "home": {"team": "x", "points": {"1": 5}}, "away": {"team": 3, "points": {"bye": "?"}}}, 17]}'),
]


def test_matchups_players_and_settings(spark):
    rows = payloads.opened(spark.createDataFrame(TEXTS, "league long, text string"), "text")
    got = {tuple(r) for r in payloads.matchups(rows, "league").where("league = 1").collect()}
    assert got == {(1, 1, "home", 7, 8, 15, 90.5, 2), (1, 1, "home", 7, 8, 16, 80.0, 2), (1, 1, "away", 8, 7, 15, 91.0, 2), (1, 1, "away", 8, 7, 16, 70.0, 2), (1, 2, "home", 7, None, 17, 1.0, 1)}
    assert {r.league for r in payloads.matchups(rows, "league").collect()} <= {1, 5}
    assert {tuple(r) for r in payloads.players(rows, "league").collect()} == {(1, 7, 70, "RB", 1, 3.5), (1, 7, 70, "RB", 2, 0.0), (1, 7, 71, "BENCH", None, None)}
    assert {tuple(r) for r in payloads.settings(rows, "league").collect()} == {(1, 7, 2, 2, "score"), *[(k, 0, 0, 0, None) for k in (2, 3, 4, 5)]}
    assert payloads.matchups(rows.limit(0), "league").count() == payloads.players(rows.limit(0), "league").count() == 0
