"""Platform payloads, built from tables and read back without a schema: a region's nations are a league, months are periods.

Nation n meets the next one of its region in the match-up of two months; the nation's suppliers are its players.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.sources import payloads
from tidemark.sources.tables import table

_POINTS = """
g as (select c_nationkey as team, month(o_orderdate) as period, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as points from orders join customer on c_custkey = o_custkey group by all),
n as (select n_nationkey as team, n_regionkey as league, row_number() over (partition by n_regionkey order by n_nationkey) - 1 as place from nation),
pairs as (select a.league, a.team as home, b.team as away from n a join n b on a.league = b.league and a.place % 2 = 0 and b.place = a.place + 1)"""


def _payloads(spark: SparkSession, d: str) -> DataFrame:
    """One row a league with its JSON text; a few nations and twelve periods each, whatever the size of the tables."""
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    points = orders.groupBy(F.col("c_nationkey").alias("team"), F.month("o_orderdate").alias("period")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("points"))
    block = points.groupBy("team", F.floor((F.col("period") - 1) / 2).alias("block")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("period").cast("string"), "points"))).alias("points"))
    place = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("team"), F.col("n_regionkey").alias("league"), "n_name", place.alias("place"))
    sides = nations.join(block, "team").withColumn("pair", F.floor(F.col("place") / 2)).withColumn("one", F.struct("team", "points"))
    games = sides.groupBy("league", "pair", "block").agg(F.max(F.when(F.col("place") % 2 == 0, F.struct(F.lit(1), "team"))).isNotNull().alias("has_home"), F.max_by("one", -F.col("place")).alias("home"), F.max_by("one", "place").alias("away"), F.count(F.lit(1)).alias("k"))
    schedule = games.where("k = 2").groupBy("league").agg(F.collect_list(F.struct((F.col("pair") * 10 + F.col("block")).alias("id"), "home", "away")).alias("schedule"))
    settings = F.struct(F.create_map(*[F.lit(x) for x in ("ONE", 1, "TWO", 2, "BENCH", 4)]).alias("slots"), F.create_map(F.lit("yards"), F.lit(0.1), F.lit("score"), F.lit(6.0), F.concat(F.lit("odd"), (F.col("league") % 2).cast("string")), F.col("league").cast("double") + 4).alias("weights"))
    suppliers = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("team")).agg(F.count(F.lit(1)).alias("k"), F.max("s_acctbal").alias("best"), F.max_by("s_suppkey", F.struct("s_acctbal", -F.col("s_suppkey"))).alias("id"))
    player = F.array(F.struct(F.col("id"), F.lit("ONE").alias("slot"), F.create_map(F.lit("1"), F.col("best"), F.lit("x"), F.col("k").cast("double")).alias("points")), F.struct((-F.col("id") - 1).alias("id"), F.lit("BENCH").alias("slot"), F.lit(None).cast("map<string,double>").alias("points")))
    teams = nations.join(suppliers, "team").groupBy("league").agg(F.collect_list(F.struct(F.col("team").alias("id"), F.col("n_name").alias("name"), player.alias("players"))).alias("teams"))
    leagues = nations.select("league").distinct().join(schedule, "league", "left").join(teams, "league", "left")
    return leagues.select("league", F.to_json(F.struct(F.col("league").alias("id"), settings.alias("settings"), "teams", "schedule")).alias("text"))


@query(f"""with {_POINTS}, s as (select league, home as team, away as opponent, 'home' as side from pairs union all select league, away, home, 'away' from pairs),
r as (select s.league, s.side, s.team, s.opponent, g.period, g.points, (g.period - 1) // 2 as block, count(*) over (partition by s.team, (g.period - 1) // 2) as periods from s join g on g.team = s.team)
select r.league, r.side, r.team, r.opponent, r.period, r.points, r.periods from r where exists (select 1 from g where g.team = r.opponent and (g.period - 1) // 2 = r.block)""")
def n07_matchups(spark: SparkSession, d: str) -> DataFrame:
    """Points by period of match-ups that last two periods, both sides, from each league's payload."""
    return payloads.matchups(payloads.opened(_payloads(spark, d), "text"), "league").drop("matchup")


@query("""
with b as (select s_nationkey as team, arg_max(s_suppkey, (s_acctbal, -s_suppkey)) as id, max(s_acctbal) as best, count(*) as k from supplier group by 1)
select n_regionkey as league, team, id as player, 'ONE' as slot, 1 as period, best as points from b join nation on n_nationkey = team union all select n_regionkey, team, id, 'ONE', null, cast(k as double) from b join nation on n_nationkey = team
union all select n_regionkey, team, -id - 1, 'BENCH', null, null from b join nation on n_nationkey = team
""")
def n07_players(spark: SparkSession, d: str) -> DataFrame:
    """Rosters with points by period; a period that is no number, and players without points, have NULLs."""
    return payloads.players(payloads.opened(_payloads(spark, d), "text"), "league")


@query("""select distinct n_regionkey as league, 7 as slots, 3 as starters, 3 as weights, case when n_regionkey + 4 > 6 then 'odd' || (n_regionkey % 2) when n_regionkey + 4 = 6 then 'odd0' else 'score' end as best_stat from nation""")
def n09_settings(spark: SparkSession, d: str) -> DataFrame:
    """Each league's number of slots, of those that start, of stats that score, and the stat that weighs most."""
    return payloads.settings(payloads.opened(_payloads(spark, d), "text"), "league")
