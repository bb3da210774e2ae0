"""Sources with stamps of their own, fact tables, and scores built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.plans.registry import query
from tidemark.sources.tables import table

#: Codes of sides that moved, and the weights of the composed score.
MOVED = {"F": "FIN", "O": "OPN"}
WEIGHTS = {"qty": 0.1, "back": -2.0, "n": 1.0}


def _month(c: str):
    return (F.year(c) * 12 + F.month(c)).cast("long")


def _money(c: str):
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


@query("""
with x as (select p_size * 2 as k, min(p_partkey) as id from part where p_size is not null group by 1)
select l_returnflag, count(id) as mapped, count(*) - count(id) as unmapped, count(distinct id) as ids from lineitem left join x on k = cast(l_quantity as bigint) group by 1
""")
def s11_crosswalked(spark: SparkSession, d: str) -> DataFrame:
    """Rows under another house's ids: mapped by a crosswalk with one row an id (the smallest of several), and how many have none. One row a flag."""
    x = table(spark, d, "part").where("p_size IS NOT NULL").groupBy((F.col("p_size") * 2).cast("long").alias("k")).agg(F.min("p_partkey").alias("id"))
    rows = table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("k")).groupBy("l_returnflag", "k").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(x, "k", "left").groupBy("l_returnflag").agg(
        F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n"))), F.lit(0)).alias("mapped"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unmapped"), F.count_distinct("id").alias("ids")
    )


@query("""
with k as (select l_orderkey, max(l_shipdate) as kickoff from lineitem group by 1)
select o_orderkey, coalesce(case when o_orderstatus = 'F' then o_orderdate end, kickoff - interval 24 hours) as known_at, o_orderstatus = 'F' as reported, nullif(trim(case when o_orderpriority like '5%' then '  ' else ' ' || o_orderpriority || ' ' end), '') as report from orders left join k on l_orderkey = o_orderkey
""")
def s13_reports(spark: SparkSession, d: str) -> DataFrame:
    """Reports known when they were changed, else a day before the start; blank ones are NULL. One row an order; NULL known_at if it has neither."""
    k = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("kickoff"))
    done = F.col("o_orderstatus") == "F"
    text = F.when(F.col("o_orderpriority").startswith("5"), F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")))
    known = F.coalesce(F.when(done, F.col("o_orderdate")), F.col("kickoff") - F.expr("interval 24 hours"))
    return table(spark, d, "orders").join(k, "o_orderkey", "left").select("o_orderkey", known.alias("known_at"), done.alias("reported"), F.nullif(F.trim(text), F.lit("")).alias("report"))


@query("""
with e as (select user_id, ts, event_type, date_diff('day', date '2024-01-01', cast(ts as date)) // 7 as week from events),
ko as (select user_id, week, min(ts) as ko from e where event_type = 'view' group by all), latest as (select week, max(ko) as last_ko from ko group by 1),
weekly as (select user_id, week, count(*) as n from e where event_type = 'purchase' group by all)
select user_id, week, n, coalesce(ko, last_ko) as known_at, 'weekly' as form from weekly left join ko using (user_id, week) left join latest using (week)
union all select user_id, null, null, ts, 'snapshot' from e where event_type = 'signup'
""")
def s14_two_formats(spark: SparkSession, d: str) -> DataFrame:
    """Charts in two formats: weekly ones known at the team's start, or the week's last start if it has none; snapshots known at their own stamp."""
    e = table(spark, d, "events").withColumn("week", F.floor(F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7))
    by = e.where(F.col("event_type").isin("view", "purchase")).groupBy("user_id", "week").agg(F.min(F.when(F.col("event_type") == "view", F.col("ts"))).alias("ko"), F.count_if(F.col("event_type") == "purchase").alias("n"))
    last = by.groupBy("week").agg(F.max("ko").alias("last_ko"))
    weekly = by.where("n > 0").join(last, "week", "left").select("user_id", "week", "n", F.coalesce("ko", "last_ko").alias("known_at"), F.lit("weekly").alias("form"))
    snapshots = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("known_at"), F.lit("snapshot").alias("form"))
    return weekly.unionByName(snapshots, allowMissingColumns=True)


@query("select l_suppkey, count(*) as rows, count(distinct year(l_shipdate)) as seasons, max(l_shipdate) as newest from lineitem where l_shipdate < timestamp '1999-01-01' group by 1")
def s16_career(spark: SparkSession, d: str) -> DataFrame:
    """Counts before a cutoff over all seasons: by season first, then over seasons."""
    season = table(spark, d, "lineitem").where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")).groupBy("l_suppkey", F.year("l_shipdate").alias("season")).agg(F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("newest"))
    return season.groupBy("l_suppkey").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("seasons"), F.max("newest").alias("newest"))


@query("""
select o_orderkey, 'home' as side, case o_orderstatus when 'F' then 'FIN' when 'O' then 'OPN' else o_orderstatus end as code, o_custkey as lead from orders
union all select o_orderkey, 'away', case left(o_orderpriority, 1) when 'F' then 'FIN' when 'O' then 'OPN' else left(o_orderpriority, 1) end, o_custkey + 1 from orders
""")
def s19_long(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of each game as rows, codes of sides that moved replaced; one scan, no union."""
    code = lambda c: S.mapped(c, MOVED, c)
    home = F.struct(F.lit("home").alias("side"), code(F.col("o_orderstatus")).alias("code"), F.col("o_custkey").alias("lead"))
    away = F.struct(F.lit("away").alias("side"), code(F.left("o_orderpriority", F.lit(1))).alias("code"), (F.col("o_custkey") + 1).alias("lead"))
    return table(spark, d, "orders").select("o_orderkey", F.inline(F.array(home, away)))


def _player_weeks(spark: SparkSession, d: str) -> DataFrame:
    """One row a supplier and month of shipments."""
    rows = table(spark, d, "lineitem").groupBy("l_suppkey", _month("l_shipdate").alias("week"))
    return rows.agg(_money("l_quantity").alias("qty"), _money("l_extendedprice").alias("price"), F.count_if(F.col("l_returnflag") == "R").alias("back"), F.count(F.lit(1)).alias("n"))


_WEEKS = "pw as (select l_suppkey, year(l_shipdate) * 12 + month(l_shipdate) as week, cast(sum(cast(l_quantity as decimal(18,2))) as double) as qty, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price, count(*) filter (l_returnflag = 'R') as back, count(*) as n from lineitem group by all)"


@query(f"with {_WEEKS} select l_suppkey, week, qty, price, back, n, s_name, s_nationkey, back / n as back_share, 0.1 * qty - 2.0 * back + 1.0 * n as score from pw left join supplier on s_suppkey = l_suppkey")
def r02_player_weeks(spark: SparkSession, d: str) -> DataFrame:
    """The weekly fact: measures, counts with 0 for none, the dimension's columns (NULL for unknown ids) and a score."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    return _player_weeks(spark, d).join(s, "l_suppkey", "left").select("l_suppkey", "week", "qty", "price", "back", "n", "s_name", "s_nationkey", (F.col("back") / F.col("n")).alias("back_share"), S.linear_score(WEIGHTS).alias("score"))


@query("""
with o as (select c_custkey, c_mktsegment, count(o_orderkey) as n, cast(coalesce(sum(cast(o_totalprice as decimal(18,2))), 0) as double) as spent from customer left join orders on o_custkey = c_custkey group by all),
p as (select c_mktsegment, quantile_cont(n, 0.95) as p95 from o group by 1)
select c_custkey, round(least(n / nullif(p95, 0), 1.0), 9) as score, case when n >= 0.8 * p95 then 'START' when n = 0 then 'OUT' when n >= 0.4 * p95 then 'FLEX' else 'SIT' end as call from o join p using (c_mktsegment)
""")
def r09_start_sit(spark: SparkSession, d: str) -> DataFrame:
    """Opportunities against the segment's 95th percentile, at most 1, and the call that follows. The percentile is taken over counts by value, which are few."""
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    o = table(spark, d, "customer").join(orders, "c_custkey", "left").select("c_custkey", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n"))
    values = o.groupBy("c_mktsegment", "n").agg(F.count(F.lit(1)).alias("times"))
    p = values.groupBy("c_mktsegment").agg(F.percentile("n", 0.95, F.col("times")).alias("p95"))
    n, p95 = F.col("n"), F.col("p95")
    call = S.first_that_holds([(n >= 0.8 * p95, "START"), (n == 0, "OUT"), (n >= 0.4 * p95, "FLEX")], "SIT")
    return o.join(p, "c_mktsegment").select("c_custkey", F.round(F.least(n / F.nullif(p95, F.lit(0.0)), F.lit(1.0)), 9).alias("score"), call.alias("call"))


@query(f"""
with {_WEEKS}, w as (select s_nationkey as team, pw.* from pw join supplier on s_suppkey = l_suppkey), t as (select distinct team, week from w), f as (select team, l_suppkey, min(week) as first, sum(1.5 * back + n) as pts, count(*) as played from w group by all)
select l_suppkey, played, count(t.week) as team_games, round(pts / count(t.week), 9) as expected from f join t on t.team = f.team and t.week >= f.first group by l_suppkey, played, pts
""")
def r12_expected(spark: SparkSession, d: str) -> DataFrame:
    """Points a team game from the first one played: games missed count as none. Team games from a week on are a rank, so no inequality joins."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("team"))
    w = _player_weeks(spark, d).join(s, "l_suppkey")
    games = w.select("team", "week").distinct().withColumn("team_games", F.row_number().over(Window.partitionBy("team").orderBy(F.desc("week"))).cast("long"))
    f = w.groupBy("team", "l_suppkey").agg(F.min("week").alias("week"), F.sum(1.5 * F.col("back") + F.col("n")).alias("pts"), F.count(F.lit(1)).alias("played"))
    return f.join(games, ["team", "week"]).select("l_suppkey", "played", "team_games", F.round(F.col("pts") / F.col("team_games"), 9).alias("expected"))


@query("select l_orderkey, l_linenumber, case l_returnflag when 'R' then l_quantity when 'A' then l_extendedprice / 1000 end as volume, case l_returnflag when 'R' then 'units' when 'A' then 'thousands' end as measure from lineitem")
def r28_volume(spark: SparkSession, d: str) -> DataFrame:
    """The volume that suits the kind of row; kinds without one have NULL."""
    kind = F.col("l_returnflag")
    volume, measure = F.when(kind == "R", F.col("l_quantity")).when(kind == "A", F.col("l_extendedprice") / 1000), F.when(kind == "R", "units").when(kind == "A", "thousands")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", volume.alias("volume"), measure.alias("measure"))


@query(f"""
with {_WEEKS}, y as (select s_nationkey as team, l_suppkey, (week - 1) // 12 as season, sum(cast(qty as decimal(18,2))) as q, sum(cast(price as decimal(18,2))) as p, sum(n) as n from pw join supplier on s_suppkey = l_suppkey group by all),
s as (select l_suppkey, season, n, cast(q as double) / cast(sum(q) over t as double) as qs, cast(p as double) / cast(sum(p) over t as double) as ps from y window t as (partition by team, season))
select l_suppkey, cast(season as bigint) as season, round(qs, 9) as unit_share, round(ps, 9) as price_share, case when n >= 20 then round((qs + ps) / 2, 9) end as dominator from s
""")
def r30_market_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the team's units and price by season; their mean only for those with 20 rows or more."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("team"))
    y = _player_weeks(spark, d).join(s, "l_suppkey").groupBy("team", "l_suppkey", F.floor((F.col("week") - 1) / 12).alias("season")).agg(F.sum(F.col("qty").cast("decimal(18,2)")).alias("q"), F.sum(F.col("price").cast("decimal(18,2)")).alias("p"), F.sum("n").alias("n"))
    whole = y.groupBy("team", "season").agg(F.sum("q").alias("tq"), F.sum("p").alias("tp"))
    qs, ps = (F.col(a).cast("double") / F.col(b).cast("double") for a, b in (("q", "tq"), ("p", "tp")))
    return y.join(whole, ["team", "season"]).select("l_suppkey", "season", F.round(qs, 9).alias("unit_share"), F.round(ps, 9).alias("price_share"), F.when(F.col("n") >= 20, F.round((qs + ps) / 2, 9)).alias("dominator"))


@query("""
with w as (select s_suppkey, s_suppkey * 40 as id, replace(s_name, 'Supplier', 'Customer') as name from supplier)
select s_suppkey, coalesce(a.c_custkey, b.c_custkey) as mine, a.c_custkey is not null as by_id from w left join customer a on a.c_custkey = id left join customer b on a.c_custkey is null and b.c_name = name
""")
def r31_own_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows that are meant: by id, and by name only where the id finds none; NULL where neither does."""
    c = table(spark, d, "customer")
    w = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") * 40).alias("id"), F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("name"))
    first = w.join(c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("a")), "id", "left").withColumn("name", F.when(F.col("a").isNull(), F.col("name")))
    both = first.join(c.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("b")), "name", "left")
    return both.select("s_suppkey", F.coalesce("a", "b").alias("mine"), F.col("a").isNotNull().alias("by_id"))


@query(f"""
with {_WEEKS}, p as (select l_suppkey, week, qty, n, back, sum(qty) over w / nullif(count(*) over w, 0) as eq, sum(n) over w / nullif(count(*) over w, 0) as en, sum(back) over w / nullif(count(*) over w, 0) as eb from pw window w as (partition by l_suppkey order by week rows between 3 preceding and 1 preceding))
select l_suppkey, week, round(0.1 * eq - 2.0 * eb + en, 6) as composed, round(0.1 * qty - 2.0 * back + n, 6) as actual from p where eq is not null
""")
def y06_composed(spark: SparkSession, d: str) -> DataFrame:
    """Each component predicted by its mean over the three rows before, then scored together; first rows have no prediction and are left out."""
    w = Window.partitionBy("l_suppkey").orderBy("week").rowsBetween(-3, -1)
    p = _player_weeks(spark, d).select("l_suppkey", "week", S.linear_score(WEIGHTS).alias("actual"), *[F.avg(c).over(w).alias(c) for c in WEIGHTS]).where("qty IS NOT NULL")
    return p.select("l_suppkey", "week", F.round(S.linear_score(WEIGHTS), 6).alias("composed"), F.round("actual", 6).alias("actual"))
