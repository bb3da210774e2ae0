"""Usage, team and participation tables from plays, and lines that are published by games.

A play has game, team, opponent, flags of what kind it was, carrier (who had it, or NULL), and the
players on the field for either side. No table of players is joined with plays: participants are
exploded from the play itself, sums are combined before they are shuffled, and team totals stand
beside a player's by a window over sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usage(plays: DataFrame, flags: list[str]) -> DataFrame:
    """game, team, player, carries, and carries of each flag, with the share of the team's (NULL where it has none)."""
    sums = plays.where("carrier IS NOT NULL").groupBy("game", "team", F.col("carrier").alias("player")).agg(F.count(F.lit(1)).alias("carries"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    team = Window.partitionBy("game", "team")
    return sums.withColumns({f"{c}_share": F.round(F.col(c) / F.nullif(F.sum(c).over(team), F.lit(0)), 6) for c in ("carries", *flags)})


def team_totals(plays: DataFrame, flags: list[str]) -> DataFrame:
    """game, team, opponent, plays, carries, plays of each flag, and the plays of which the players on the field are known."""
    covered = F.coalesce(F.size("on_field") > 0, F.lit(False))
    return plays.groupBy("game", "team", "opponent").agg(F.count(F.lit(1)).alias("plays"), F.count("carrier").alias("carries"), *[F.count_if(F.col(f)).alias(f) for f in flags], F.count_if(covered).alias("plays_known"), *[F.count_if(F.col(f) & covered).alias(f"{f}_known") for f in flags])


def participation(plays: DataFrame, flags: list[str]) -> DataFrame:
    """game, team, player, side, and the plays on the field, and off it, in all and of each flag.

    side is own for the players of the team that has the play, other for those against it. A player
    listed twice in a play counts once; plays whose players aren't known count for nobody. Off the
    field are the known plays of the side in the game that a player was not on for, so a player has
    a row in games with at least one play on the field.
    """
    kinds = ["plays", *flags]
    known = plays.where(F.size("on_field") > 0).withColumn("plays", F.lit(True))
    sides = F.array(F.struct(F.lit("own").alias("side"), F.col("team").alias("of"), F.array_distinct("on_field").alias("who")), F.struct(F.lit("other").alias("side"), F.col("opponent").alias("of"), F.array_distinct(F.coalesce("against", F.array().cast("array<bigint>"))).alias("who")))
    each = known.select("game", *kinds, F.explode(sides).alias("s")).select("game", F.col("s.of").alias("team"), F.col("s.side").alias("side"), *kinds, F.explode("s.who").alias("player"))
    on = each.groupBy("game", "team", "side", "player").agg(*[F.count_if(F.col(k)).alias(f"{k}_on") for k in kinds])
    totals = known.select("game", *kinds, F.explode(sides).alias("s")).groupBy("game", F.col("s.of").alias("team"), F.col("s.side").alias("side")).agg(*[F.count_if(F.col(k)).alias(f"_{k}") for k in kinds])
    return on.join(totals, ["game", "team", "side"]).withColumns({f"{k}_off": F.col(f"_{k}") - F.col(f"{k}_on") for k in kinds}).drop(*[f"_{k}" for k in kinds])


def published_lines(targets: DataFrame, played: DataFrame, coverage: DataFrame, lines: DataFrame, value: str, n: int = 3) -> DataFrame:
    """targets (player, at) with the newest published line, the mean of the newest n, and how many of the games count.

    played: player, game, day. coverage: game and published, the instant at which the game's lines
    came out; a game without a row never did. lines: player, game and value. A game that isn't
    published before the target says nothing; one that is, without a line of the player, is a 0.
    Games must be published in the order of their days. Adds last_value, mean_value (NULL without a
    published game) and games.
    """
    rows = played.join(coverage, "game").join(lines.select("player", "game", F.col(value).alias("v")), ["player", "game"], "left")
    order = Window.partitionBy("player").orderBy("published", "day", "game")
    recent = F.collect_list("v").over(order.rowsBetween(1 - n, 0))
    rows = rows.withColumn("v", F.coalesce("v", F.lit(0))).select("player", "published", "day", "game", recent.alias("recent"), F.row_number().over(order).alias("games"))
    left = targets.select("player", F.col("at").alias("_time"), F.lit(0).alias("_side"), F.struct("*").alias("_t"))
    right = rows.select("player", F.col("published").alias("_time"), F.lit(1).alias("_side"), F.struct("recent", "games").alias("_row"), "day", "game")
    # at one instant the target comes first: what is published then isn't known yet
    seen = Window.partitionBy("player").orderBy("_time", "_side", "day", "game").rowsBetween(Window.unboundedPreceding, 0)
    out = left.unionByName(right, allowMissingColumns=True).withColumn("_seen", F.last("_row", ignorenulls=True).over(seen)).where("_t IS NOT NULL")
    recent = F.col("_seen.recent")
    mean = F.aggregate(recent, F.lit(0.0), lambda a, x: a + x) / F.size(recent)
    return out.select("_t.*", F.element_at(recent, -1).alias("last_value"), F.when(F.col("_seen").isNotNull(), mean).alias("mean_value"), F.coalesce(F.col("_seen.games"), F.lit(0)).alias("games"))
