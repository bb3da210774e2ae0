"""League payloads as VARIANT: match-ups, points by period, rosters and settings, without a fixed schema.

A payload is one JSON text a league: {"id", "settings": {"slots": {"NAME": n}, "weights": {"STAT": w}}, "teams": [{"id",
"name", "players": [{"id", "slot", "points": {"PERIOD": x}}]}], "schedule": [{"id", "home": {"team", "points": {"PERIOD": x}},
"away": {...}}]}. Any part may be missing; what isn't there, or has another type, is NULL or gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def opened(rows: DataFrame, text: str) -> DataFrame:
    """rows with column payload: the parsed text, NULL where it is damaged."""
    return rows.withColumn("payload", F.try_parse_json(text))


def _at(v: str | Column, path: str, kind: str) -> Column:
    return F.try_variant_get(F.col(v) if isinstance(v, str) else v, path, kind)


def matchups(rows: DataFrame, league: str) -> DataFrame:
    """league, matchup, side, team, opponent, period, points, periods: a row for each side and period that has points.

    A match-up that lasts several periods has a row for each; periods says how many it has.
    """
    each = rows.select(league, F.explode(_at("payload", "$.schedule", "array<variant>")).alias("m"))
    side = lambda a, b: F.struct(F.lit(a).alias("side"), _at("m", f"$.{a}.team", "long").alias("team"), _at("m", f"$.{b}.team", "long").alias("opponent"), _at("m", f"$.{a}.points", "map<string,double>").alias("points"))
    both = each.select(league, _at("m", "$.id", "long").alias("matchup"), F.explode(F.array(side("home", "away"), side("away", "home"))).alias("s"))
    flat = both.where("s.team IS NOT NULL").select(league, "matchup", "s.side", "s.team", "s.opponent", F.size("s.points").alias("periods"), F.explode("s.points").alias("period", "points"))
    return flat.select(league, "matchup", "side", "team", "opponent", F.col("period").try_cast("int").alias("period"), "points", "periods")


def players(rows: DataFrame, league: str) -> DataFrame:
    """league, team, player, slot, period, points: a row for each player and period; players without points have one with NULLs."""
    teams = rows.select(league, F.explode(_at("payload", "$.teams", "array<variant>")).alias("t"))
    each = teams.select(league, _at("t", "$.id", "long").alias("team"), F.explode(_at("t", "$.players", "array<variant>")).alias("p"))
    out = each.select(league, "team", _at("p", "$.id", "long").alias("player"), _at("p", "$.slot", "string").alias("slot"), F.explode_outer(_at("p", "$.points", "map<string,double>")).alias("period", "points"))
    return out.withColumn("period", F.col("period").try_cast("int"))


def settings(rows: DataFrame, league: str) -> DataFrame:
    """league, slots (in all), starters (without bench and reserve), weights: how many stats score, best_stat: the dearest one."""
    slots = _at("payload", "$.settings.slots", "map<string,int>")
    weights = F.map_entries(_at("payload", "$.settings.weights", "map<string,double>"))
    total = lambda m: F.aggregate(F.coalesce(F.map_values(m), F.array().cast("array<int>")), F.lit(0), lambda a, n: a + F.coalesce(n, F.lit(0)))
    starters = F.map_filter(slots, lambda k, _: ~k.isin("BENCH", "RESERVE"))
    best = F.get(F.array_sort(F.transform(weights, lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("k")))), F.lit(0))["k"]
    return rows.select(league, total(slots).alias("slots"), total(starters).alias("starters"), F.coalesce(F.size(weights), F.lit(0)).alias("weights"), best.alias("best_stat"))
