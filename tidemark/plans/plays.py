"""Plays, published lines and matched people, on stand-ins from orders, events, customers and suppliers.

An order is a play: its month is the game, its customer's region the team, its lines' suppliers are on
the field, those of the even line numbers against the odd ones; an order with a single line has
no known players, and the supplier of the dearest line carries it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import matching, plays
from tidemark.plans.registry import query
from tidemark.sources.tables import table

FLAGS = ["urgent", "large"]
_PLAYS = """
l as (select l_orderkey, count(*) as k, case when count(*) > 1 then list(l_suppkey) filter (l_linenumber % 2 = 1) end as on_field, case when count(*) > 1 then list(l_suppkey) filter (l_linenumber % 2 = 0) end as against, arg_max(l_suppkey, (l_extendedprice, -l_linenumber)) as carrier from lineitem group by 1),
p as (select year(o_orderdate) * 12 + month(o_orderdate) as game, n_regionkey as team, (n_regionkey + 1) % 5 as opponent, o_orderpriority = '1-URGENT' as urgent, o_totalprice > 200000 as large, case when o_orderstatus <> 'P' then carrier end as carrier, on_field, against
  from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey left join l on l_orderkey = o_orderkey)"""


def _plays(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("k"), *[F.collect_list(F.when(F.col("l_linenumber") % 2 == side, F.col("l_suppkey"))).alias(name) for side, name in ((1, "on_field"), (0, "against"))],
        F.max_by("l_suppkey", F.struct("l_extendedprice", -F.col("l_linenumber"))).alias("carrier"),
    )
    team = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("n_regionkey").alias("team"))
    rows = table(spark, d, "orders").join(team, "o_custkey").join(lines, "o_orderkey", "left")
    return rows.select(
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("game"), "team", ((F.col("team") + 1) % 5).alias("opponent"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"), (F.col("o_totalprice") > 200_000).alias("large"),
        F.when(F.col("o_orderstatus") != "P", F.col("carrier")).alias("carrier"), *[F.when(F.col("k") > 1, F.col(c)).alias(c) for c in ("on_field", "against")],
    )


@query(f"""with {_PLAYS}, u as (select game, team, carrier as player, count(*) as carries, count(*) filter (urgent) as urgent, count(*) filter (large) as large from p where carrier is not null group by all)
select *, {", ".join(f"round({c} / nullif(sum({c}) over (partition by game, team), 0), 6) as {c}_share" for c in ("carries", *FLAGS))} from u""")
def s18_usage(spark: SparkSession, d: str) -> DataFrame:
    """Who carried how many plays of a team and game, in all and by kind, and the share of the team's."""
    return plays.usage(_plays(spark, d), FLAGS)


@query(f"""with {_PLAYS} select game, team, opponent, count(*) as plays, count(carrier) as carries, count(*) filter (urgent) as urgent, count(*) filter (large) as large, count(*) filter (len(on_field) > 0) as plays_known, count(*) filter (urgent and len(on_field) > 0) as urgent_known, count(*) filter (large and len(on_field) > 0) as large_known from p group by all""")
def s18_team(spark: SparkSession, d: str) -> DataFrame:
    """Plays of a team and game, in all and by kind, and those of which the players are known."""
    return plays.team_totals(_plays(spark, d), FLAGS)


@query(f"""with {_PLAYS}, k as (select *, row_number() over () as id from p where len(on_field) > 0),
s as (select id, game, team, 'own' as side, urgent, large, list_distinct(on_field) as who from k union all select id, game, opponent, 'other', urgent, large, list_distinct(against) from k),
t as (select game, team, side, count(*) as n, count(*) filter (urgent) as u, count(*) filter (large) as l from s group by all),
e as (select id, game, team, side, urgent, large, unnest(who) as player from s)
select e.game, e.team, e.side, e.player, count(*) as plays_on, count(*) filter (urgent) as urgent_on, count(*) filter (large) as large_on, any_value(t.n) - count(*) as plays_off, any_value(t.u) - count(*) filter (urgent) as urgent_off, any_value(t.l) - count(*) filter (large) as large_off
from e join t on t.game = e.game and t.team = e.team and t.side = e.side group by all""")
def s18_participation(spark: SparkSession, d: str) -> DataFrame:
    """Who was on the field, and off it, for how many of a game's plays, on either side."""
    return plays.participation(_plays(spark, d), FLAGS)


@query("""
with d as (select user_id as player, user_id % 16 as team, cast(ts as date) as day, count(*) as n, count(*) filter (event_type = 'error') as errors from events group by all),
cov as (select distinct team * 100000 + date_diff('day', date '2024-01-01', day) as game, day + cast(((5 - isodow(day) + 6) % 7) + 1 as integer) as published from d where not (team % 5 = 0 and day between date '2024-01-08' and date '2024-01-14')),
played as (select player, team * 100000 + date_diff('day', date '2024-01-01', day) as game, day, errors from d),
r as (select t.player, t.day as at, p.day, p.errors, row_number() over (partition by t.player, t.day order by c.published desc, p.day desc) as k from played t join played p on p.player = t.player join cov c on c.game = p.game and c.published < t.day)
select t.player, t.day as at, max(case when r.k = 1 then r.errors end) as last_value, avg(case when r.k <= 3 then r.errors end) as mean_value, count(r.k) as games from played t left join r on r.player = t.player and r.at = t.day group by all
""")
def s20_charting(spark: SparkSession, d: str) -> DataFrame:
    """Charted errors entering each day played: games come out on Fridays, some never do, and only users with errors have lines."""
    rows = table(spark, d, "events").groupBy(F.col("user_id").alias("player"), (F.col("user_id") % 16).alias("team"), F.to_date("ts").alias("day")).agg(F.count_if(F.col("event_type") == "error").alias("errors"))
    rows = rows.withColumn("game", F.col("team") * 100_000 + F.date_diff("day", F.lit("2024-01-01").cast("date")))
    skipped = (F.col("team") % 5 == 0) & F.col("day").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"))
    coverage = rows.where(~skipped).select("game", S.next_weekday(F.col("day"), "Fri").alias("published")).distinct()
    targets = rows.select("player", F.col("day").alias("at"))
    return plays.published_lines(targets, rows.select("player", "game", "day"), coverage, rows.where("errors > 0"), "errors")


_TIERS = ("number_nation", "number", "nation_balance")
_MATCH = """
c as (select c_custkey as id, cast(right(c_name, 6) as bigint) % 400 as num, c_nationkey as nat, cast(round(c_acctbal / 500) as bigint) as bal from customer), s as (select s_suppkey as id, cast(right(s_name, 6) as bigint) as num, s_nationkey as nat, cast(round(s_acctbal / 500) as bigint) as bal from supplier)"""


def _tier_sql(i: int, on: list[str]) -> str:
    keys = ", ".join(on)
    left, right = f"a{i}", f"b{i}"
    return f"""x{i} as (select {keys}, count(*) as claims from {left} group by all), y{i} as (select {keys}, count(*) as partners, min(id) as partner from {right} group by all),
    r{i} as (select a.id, y.partners, x.claims, case when x.claims = 1 and y.partners = 1 then y.partner end as partner from {left} a join x{i} x using ({keys}) join y{i} y using ({keys})),
    a{i + 1} as (select * from {left} where id not in (select id from r{i} where partner is not null)), b{i + 1} as (select * from {right} where id not in (select partner from r{i} where partner is not null))"""


@query(f"""with {_MATCH}, a0 as (select * from s), b0 as (select * from c), {_tier_sql(0, ["num", "nat"])}, {_tier_sql(1, ["num"])}, {_tier_sql(2, ["nat", "bal"])},
e as ({" union all ".join(f"select id, {i} as t, '{n}' as tier, partners, claims, partner from r{i}" for i, n in enumerate(_TIERS))}),
l as (select id, arg_max(case when partner is not null then 'matched' when partners > 1 then 'ambiguous' else 'shared' end, t) as reason, max(partner) as right_id, max(case when partner is not null then tier end) as tier from e group by id)
select s.id as left_id, l.right_id, l.tier, coalesce(l.reason, 'no partner') as reason from s left join l on l.id = s.id""")
def j14_matched(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers matched to customers over three tiers of keys, mutual and unique; a customer is claimed once."""
    six = lambda c: F.substring(c, -6, 6).cast("long")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), (six("c_name") % 400).alias("num"), F.col("c_nationkey").alias("nat"), F.round(F.col("c_acctbal") / 500).cast("long").alias("bal"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), six("s_name").alias("num"), F.col("s_nationkey").alias("nat"), F.round(F.col("s_acctbal") / 500).cast("long").alias("bal"))
    tiers = dict(zip(_TIERS, ([F.col(x) for x in on] for on in (["num", "nat"], ["num"], ["nat", "bal"])), strict=True))
    return matching.matched(s, "id", tiers, c, "id", tiers)
