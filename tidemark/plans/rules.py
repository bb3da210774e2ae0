"""Smaller rules: aliases, due work, schedules and their stamps, blends, codes, orders, archives and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.sources.tables import table

#: Play probabilities by designation, as the status rules have them here; slots in their order; aliases of types.
PLAY = {"error": 0.0, "click": 0.5, "signup": 0.75}
SLOTS = ("purchase", "signup", "click", "view")
ALIASES = {"ECONOMY": "econ", "STANDARD": "std", "PROMO": "promo"}


def picked(df: DataFrame, names: list[str], other: object = None) -> Column:
    """The first of the named columns that df has and that isn't NULL, else other."""
    return F.coalesce(*[F.col(c) for c in names if c in df.columns], F.lit(other))


@query("select p_partkey, coalesce(p_size, 0) as size, coalesce(p_brand, p_type) as kind, 0 as nothing from part")
def p03_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Columns under any of several names, of which the table has some or none."""
    part = table(spark, d, "part")
    return part.select("p_partkey", picked(part, ["size", "p_size"], 0).alias("size"), picked(part, ["brand", "p_brand", "p_type"]).alias("kind"), picked(part, ["weight", "p_weight"], 0).alias("nothing"))


@query("""
with s as (select user_id, count(*) as n, max(ts) as newest, count(*) filter (event_type = 'purchase') as bought, avg(value) filter (ts >= timestamp '2024-01-16') as late, avg(value) filter (ts < timestamp '2024-01-16') as early, rank() over (order by count(*) desc) as place from events group by user_id)
select user_id from s where ((n <= 60 and bought >= 1) or place <= 10) and (late > early or place <= 10) and newest >= timestamp '2024-01-25'
""")
def p06_watchlist(spark: SparkSession, d: str) -> DataFrame:
    """Users worth watching: few events but a purchase, or among the first ten; rising, or among the first ten; seen lately. A NULL comparison holds for nobody."""
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    s = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"), F.count_if(F.col("event_type") == "purchase").alias("bought"), F.avg(F.when(late, F.col("value"))).alias("late"), F.avg(F.when(~late, F.col("value"))).alias("early"))
    # to be in the first ten is to have as many events as the tenth: one number
    first_ten = F.col("n") >= F.lit(s.orderBy(F.col("n").desc()).limit(10).agg(F.min("n")).first()[0])
    kept = ((F.col("n") <= 60) & (F.col("bought") >= 1) | first_ten) & ((F.col("late") > F.col("early")) | first_ten) & (F.col("newest") >= F.lit("2024-01-25").cast("timestamp_ntz"))
    return s.where(kept).select("user_id")


@query("""
with snap as (select l_orderkey as k, max(l_shipdate) as taken from lineitem where l_shipdate < timestamp '1998-01-01' group by 1)
select o_orderkey from orders left join snap on k = o_orderkey where o_orderdate > timestamp '1998-01-01' and o_orderdate <= timestamp '1998-01-01' + interval 720 hours and (taken is null or taken < timestamp '1998-01-01' - interval 48 hours)
""")
def p10_due(spark: SparkSession, d: str) -> DataFrame:
    """Orders due within 720 hours of an instant whose newest snapshot is missing or older than 48 hours."""
    now = F.lit("1998-01-01").cast("timestamp_ntz")
    snap = table(spark, d, "lineitem").where(F.col("l_shipdate") < now).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("taken"))
    due = table(spark, d, "orders").where((F.col("o_orderdate") > now) & (F.col("o_orderdate") <= now + F.expr("interval 720 hours")))
    return due.join(snap, "o_orderkey", "left").where(F.col("taken").isNull() | (F.col("taken") < now - F.expr("interval 48 hours"))).select("o_orderkey")


@query("""
with r as (select user_id, ts, event_id, value, event_type, count(value) over w as trail from events window w as (partition by user_id order by ts, event_id rows between 3 preceding and 1 preceding))
select event_id, trail = 3 as full_trail, event_type in ('purchase', 'signup') as deep from r where value is not null and trail > 0
""")
def p13_evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Rows that count for an evaluation: a value and at least one before it; whether all three are there, and those of depth."""
    trail = F.count("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-3, -1))
    rows = table(spark, d, "events").withColumn("trail", trail).where("value IS NOT NULL AND trail > 0")
    return rows.select("event_id", (F.col("trail") == 3).alias("full_trail"), F.col("event_type").isin("purchase", "signup").alias("deep"))


@query("""
select c_custkey, case c_mktsegment when 'AUTOMOBILE' then 1.0 when 'BUILDING' then 2.0 when 'FURNITURE' then 3.0 when 'HOUSEHOLD' then 4.0 when 'MACHINERY' then 5.0 end::double as ordinal,
  (c_mktsegment = 'AUTOMOBILE')::int::double as is_automobile, (c_mktsegment = 'BUILDING')::int::double as is_building from customer
""")
def p15_encoded(spark: SparkSession, d: str) -> DataFrame:
    """Ordinal and one-hot columns of a known set of codes; unknown codes have no ordinal and no one."""
    codes = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    place = F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", F.nullif(place, F.lit(0)).cast("double").alias("ordinal"), *[(F.col("c_mktsegment") == c).cast("double").alias(f"is_{c.lower()}") for c in codes[:2]])


@query("""
with m as (select l_suppkey as k, avg(l_quantity) as pts, year(l_shipdate) as season, month(l_shipdate) as week from lineitem group by all),
c as (select season, week from m group by all order by count(*) desc, season desc, week desc limit 1)
select s_suppkey, pts from supplier left join (select k, pts from m join c using (season, week)) on k = s_suppkey
""")
def j28_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Each supplier with the figures of the most common (season, week), the latest of equally common ones."""
    m = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("week")).agg(F.avg("l_quantity").alias("pts"))
    common = m.groupBy("season", "week").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("season"), F.desc("week")).limit(1)
    return table(spark, d, "supplier").join(m.join(F.broadcast(common), ["season", "week"]), "s_suppkey", "left").select("s_suppkey", "pts")


@query("""
with x as (select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, o_totalprice as v, (o_orderkey % 3)::double as a, (o_orderkey % 5)::double as b from orders),
s as (select y, count(*)::double n, sum(a) sa, sum(b) sb, sum(a*a) saa, sum(b*b) sbb, sum(a*b) sab, sum(v) sv, sum(a*v) sav, sum(b*v) sbv from x group by y),
c as (select y, saa - sa*sa/n as caa, sbb - sb*sb/n as cbb, sab - sa*sb/n as cab, sav - sa*sv/n as cav, sbv - sb*sv/n as cbv, sa/n as ma, sb/n as mb, sv/n as mv from s),
f as (select *, (cav*cbb - cbv*cab) / nullif(caa*cbb - cab*cab, 0) as on_a, (cbv*caa - cav*cab) / nullif(caa*cbb - cab*cab, 0) as on_b from c)
select y as season, round(on_a, 2) as on_a, round(on_b, 2) as on_b, round(mv - on_a*ma - on_b*mb, 2) as intercept from f
""")
def a12_two_regressors(spark: SparkSession, d: str) -> DataFrame:
    """Least squares on two regressors for each season, from sums alone (the normal equations)."""
    x = table(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("season"), F.col("o_totalprice").alias("v"), (F.col("o_orderkey") % 3).cast("double").alias("a"), (F.col("o_orderkey") % 5).cast("double").alias("b"))
    c = x.groupBy("season").agg(
        F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(e).alias(name) for name, e in (("sa", F.col("a")), ("sb", F.col("b")), ("sv", F.col("v")), ("saa", F.expr("a*a")), ("sbb", F.expr("b*b")), ("sab", F.expr("a*b")), ("sav", F.expr("a*v")), ("sbv", F.expr("b*v")))],
    ).selectExpr("season", "saa - sa*sa/n AS caa", "sbb - sb*sb/n AS cbb", "sab - sa*sb/n AS cab", "sav - sa*sv/n AS cav", "sbv - sb*sv/n AS cbv", "sa/n AS ma", "sb/n AS mb", "sv/n AS mv")
    f = c.selectExpr("*", "(cav*cbb - cbv*cab) / nullif(caa*cbb - cab*cab, 0) AS fa", "(cbv*caa - cav*cab) / nullif(caa*cbb - cab*cab, 0) AS fb")
    return f.select("season", F.round("fa", 2).alias("on_a"), F.round("fb", 2).alias("on_b"), F.round(F.expr("mv - fa*ma - fb*mb"), 2).alias("intercept"))


@query("select o_custkey, min(n_name) as nation, min(c_mktsegment) as segment, count(*) as n from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey group by o_custkey")
def a18_dependent(spark: SparkSession, d: str) -> DataFrame:
    """Columns that the key determines ride along in the aggregation as any value."""
    customer = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), "n_name", "c_mktsegment")
    return table(spark, d, "orders").join(customer, "o_custkey").groupBy("o_custkey").agg(F.any_value("n_name").alias("nation"), F.any_value("c_mktsegment").alias("segment"), F.count(F.lit(1)).alias("n"))


@query("""
select user_id, event_id, row_number() over (partition by user_id order by case event_type when 'purchase' then 1 when 'signup' then 2 when 'click' then 3 when 'view' then 4 else 5 end, ts, event_id) as place,
  row_number() over (partition by user_id order by abs(value - 100) desc nulls last, event_id) as by_error from events
""")
def o04_slot_order(spark: SparkSession, d: str) -> DataFrame:
    """Places in a fixed order of slots (unknown ones last), and by the size of the error."""
    at = F.array_position(F.array(*[F.lit(s) for s in SLOTS]), F.col("event_type"))
    slot = F.coalesce(F.nullif(at, F.lit(0)), F.lit(len(SLOTS) + 1))
    w = Window.partitionBy("user_id")
    return table(spark, d, "events").select(
        "user_id", "event_id", F.row_number().over(w.orderBy(slot, "ts", "event_id")).cast("long").alias("place"), F.row_number().over(w.orderBy(F.abs(F.col("value") - 100).desc_nulls_last(), "event_id")).cast("long").alias("by_error"),
    )


@query("select event_id, user_id, day from (select event_id, user_id, cast(ts as date) as day, row_number() over (partition by user_id, cast(ts as date) order by case event_type when 'purchase' then 1 when 'signup' then 2 when 'click' then 3 when 'view' then 4 else 5 end, event_id) as p from events) where p = 1")
def u05_priority(spark: SparkSession, d: str) -> DataFrame:
    """Of several rows of a user and day the one of the first source in the order of priority."""
    at = F.array_position(F.array(*[F.lit(s) for s in SLOTS]), F.col("event_type"))
    best = F.min(F.struct(F.coalesce(F.nullif(at, F.lit(0)), F.lit(99)).alias("p"), "event_id"))
    return table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(best["event_id"].alias("event_id")).select("event_id", "user_id", "day")


@query("select p_partkey, case upper(trim(p_type)) when 'ECONOMY' then 'econ' when 'STANDARD' then 'std' when 'PROMO' then 'promo' else trim(regexp_replace(regexp_replace(lower(p_type), '\\b(of|the|and)\\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) end as k from part")
def f04_alias_keys(spark: SparkSession, d: str) -> DataFrame:
    """Name keys with an alias map first, else lower case without fillers and signs."""
    name = F.upper(F.trim("p_type"))
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower("p_type"), r"\b(of|the|and)\b", " "), "[^a-z0-9]+", " "))
    return table(spark, d, "part").select("p_partkey", F.coalesce(F.try_element_at(known, name), plain).alias("k"))


@query("""
select event_id, case when event_id % 7 <> 0 then date_trunc('minute', ts) + interval 5 hours end as kickoff, case event_id % 4 when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts) when 2 then date_trunc('day', ts) end as parsed from events
""")
def d01_instants(spark: SparkSession, d: str) -> DataFrame:
    """Local date and time in New York as a UTC instant, and stamps of mixed form; what can't be read is NULL."""
    ts = F.col("ts")
    clock = F.when(F.col("event_id") % 7 == 0, F.lit("25:61")).otherwise(F.date_format(ts, "HH:mm"))
    local = F.expr("try_to_timestamp(concat_ws(' ', day, clock), 'yyyy-MM-dd HH:mm')")
    mixed = F.when(F.col("event_id") % 4 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 4 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 4 == 2, F.date_format(ts, "yyyy-MM-dd")).otherwise(F.lit("soon"))
    rows = table(spark, d, "events").select("event_id", F.date_format(ts, "yyyy-MM-dd").alias("day"), clock.alias("clock"), F.regexp_replace(F.regexp_replace(mixed, "T", " "), "Z$", "").alias("stamp"))
    shift = F.to_utc_timestamp(local, "America/New_York")
    parsed = F.coalesce(F.expr("try_to_timestamp(stamp, 'yyyy-MM-dd HH:mm:ss')"), F.expr("try_to_timestamp(stamp, 'yyyy-MM-dd')"))
    return rows.select("event_id", shift.cast("timestamp_ntz").alias("kickoff"), parsed.cast("timestamp_ntz").alias("parsed"))


@query("""
with w as (select date_diff('day', date '2024-01-01', cast(ts as date)) // 7 as week, min(ts) as opens, max(ts) as closes from events group by all)
select max(week) filter (closes + interval 4 hours < timestamp '2024-01-17') as completed, min(week) filter (opens > timestamp '2024-01-17') as upcoming from w
""")
def d08_weeks(spark: SparkSession, d: str) -> DataFrame:
    """The last week whose rows were all visible four hours later, and the first that hasn't begun."""
    now = F.lit("2024-01-17").cast("timestamp_ntz")
    week = F.floor(F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7).alias("week")
    w = table(spark, d, "events").groupBy(week).agg(F.min("ts").alias("opens"), F.max("ts").alias("closes"))
    return w.agg(F.max(F.when(F.col("closes") + F.expr("interval 4 hours") < now, F.col("week"))).alias("completed"), F.min(F.when(F.col("opens") > now, F.col("week"))).alias("upcoming"))


@query("""
with own as (select user_id, min(ts) as t from events where event_type = 'purchase' and ts >= timestamp '2024-01-15' group by 1), team as (select user_id % 16 as team, min(ts) as t from events where event_type = 'signup' and ts >= timestamp '2024-01-15' group by 1), u as (select distinct user_id from events)
select u.user_id, coalesce(own.t, team.t, timestamp '2024-01-15 18:00:00') as kickoff, case when own.t is not null then 'own' when team.t is not null then 'team' else 'hour' end as source from u left join own using (user_id) left join team on team.team = u.user_id % 16
""")
def d10_kickoffs(spark: SparkSession, d: str) -> DataFrame:
    """Each user's next start: by its own row, else its team's, else the schedule's hour."""
    events = table(spark, d, "events")
    late = events.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    own = late.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("own"))
    team = late.where("event_type = 'signup'").groupBy((F.col("user_id") % 16).alias("team")).agg(F.min("ts").alias("of_team"))
    rows = events.select("user_id", (F.col("user_id") % 16).alias("team")).distinct().join(own, "user_id", "left").join(team, "team", "left")
    source = F.when(F.col("own").isNotNull(), "own").when(F.col("of_team").isNotNull(), "team").otherwise("hour")
    return rows.select("user_id", F.coalesce("own", "of_team", F.lit("2024-01-15 18:00:00").cast("timestamp_ntz")).alias("kickoff"), source.alias("source"))


@query("""
select l_orderkey, l_linenumber, round((0.7 * p + 0.3 * t) / nullif(wp + wt, 0), 6) as blend, greatest(p, t) as best, case when l_quantity % 5 = 0 then null else round(20 + 0.5 * l_quantity - 0.25 * l_tax, 6) end as plays
from (select *, case when l_quantity % 3 = 0 then 0 else l_extendedprice end as p0, case when l_quantity % 3 = 0 then 0.0 else 0.7 end as wp, case when l_quantity % 4 = 0 then 0.0 else 0.3 end as wt,
  case when l_quantity % 3 = 0 then 0 else l_extendedprice end as p, case when l_quantity % 4 = 0 then 0 else l_discount end as t from lineitem)
""")
def m03_blends(spark: SparkSession, d: str) -> DataFrame:
    """A blend of two sources whose weights are renormalised where one is missing, the larger of both, and a linear rule that is NULL if any input is."""
    q = F.col("l_quantity")
    p, t = F.when(q % 3 != 0, F.col("l_extendedprice")), F.when(q % 4 != 0, F.col("l_discount"))
    weight = F.when(p.isNotNull(), 0.7).otherwise(0.0) + F.when(t.isNotNull(), 0.3).otherwise(0.0)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    blend = (0.7 * zero(p) + 0.3 * zero(t)) / F.nullif(weight, F.lit(0.0))
    plays = F.lit(20) + 0.5 * F.when(q % 5 != 0, q) - 0.25 * F.col("l_tax")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(blend, 6).alias("blend"), F.greatest(zero(p), zero(t)).alias("best"), F.round(plays, 6).alias("plays"))


@query("select user_id, cast(sum(case event_type when 'view' then 1 when 'click' then 2 when 'purchase' then 25 else 0 end) as bigint) as points, string_agg(distinct case when event_type in ('signup', 'error') then event_type end, ',' order by case when event_type in ('signup', 'error') then event_type end) as ignored from events group by user_id")
def m10_weights(spark: SparkSession, d: str) -> DataFrame:
    """Scores by a map of weights; keys without a weight count nothing and are listed."""
    weights = F.create_map(*[F.lit(x) for pair in {"view": 1, "click": 2, "purchase": 25}.items() for x in pair])
    weight = F.try_element_at(weights, F.col("event_type"))
    ignored = F.sort_array(F.collect_set(F.when(weight.isNull(), F.col("event_type"))))
    return table(spark, d, "events").groupBy("user_id").agg(F.sum(F.coalesce(weight, F.lit(0))).cast("long").alias("points"), F.nullif(F.array_join(ignored, ","), F.lit("")).alias("ignored"))


@query("""
with r as (select user_id, cast(ts as date) as day, event_type, value, row_number() over (partition by user_id, cast(ts as date) order by case event_type when 'error' then 0 when 'click' then 1 when 'signup' then 2 else 3 end, event_id) as p from events)
select user_id, day, event_type as designation, case when event_type in ('error') then 0.0 when event_type = 'click' and value < 50 then 0.25 when event_type = 'click' then 0.5 when event_type = 'signup' then 0.75 else 1.0 end::double as play from r where p = 1
""")
def m12_play_probability(spark: SparkSession, d: str) -> DataFrame:
    """The day's most severe designation, and the chance to play from it and the practice value: first rule that holds."""
    severity = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(k) for k in PLAY]), F.col("event_type")), F.lit(0)), F.lit(99))
    worst = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min(F.struct(severity.alias("s"), "event_id", "event_type", "value")).alias("w"))
    kind, practice = F.col("w.event_type"), F.col("w.value")
    play = F.when((kind == "click") & (practice < 50), 0.25)
    for k, v in PLAY.items():
        play = play.when(kind == k, v)
    return worst.select("user_id", "day", kind.alias("designation"), play.otherwise(1.0).alias("play"))


@query("""
with o as (select year(o_orderdate) as season, o_custkey, month(o_orderdate) as week, count(*) as n from orders where year(o_orderdate) > 1995 or month(o_orderdate) <= 6 group by all),
old as (select season + 1 as season, o_custkey, week, n from o), w as (select distinct season, week from o), c as (select a.season, count(n.week) = count(*) as complete from (select distinct season from w) a join w b on b.season + 1 = a.season left join w n on n.season = a.season and n.week = b.week group by all)
select season, o_custkey, week, n, true as fresh from o where season in (select season from c)
union all select old.season, o_custkey, week, n, false from old join c on c.season = old.season where not c.complete and not exists (select 1 from o where o.season = old.season and o.o_custkey = old.o_custkey and o.week = old.week)
""")
def k03_guarded_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Each season's fetch against the snapshot of the season before: a whole one replaces it, one that lacks weeks is merged by key.

    A fetch is whole if it has every week of the snapshot; the first season's was cut off at its sixth
    week, so the next one is whole, as are all that lack none. fresh marks rows of the fetch.
    """
    orders = table(spark, d, "orders").where((F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) | (F.month("o_orderdate") <= 6))
    fetch = orders.groupBy(F.year("o_orderdate").alias("season"), "o_custkey", F.month("o_orderdate").alias("week")).agg(F.count(F.lit(1)).alias("n"))
    weeks = fetch.groupBy("season").agg(F.collect_set("week").alias("weeks"))
    before = weeks.select((F.col("season") + 1).alias("season"), F.col("weeks").alias("had"))
    whole = weeks.join(before, "season").select("season", (F.size(F.array_except("had", "weeks")) == 0).alias("whole"))
    snapshot = fetch.withColumn("season", F.col("season") + 1)
    kept = snapshot.join(whole.where("NOT whole").select("season"), "season").join(fetch, ["season", "o_custkey", "week"], "left_anti")
    return fetch.join(whole.select("season"), "season", "left_semi").withColumn("fresh", F.lit(True)).unionByName(kept.withColumn("fresh", F.lit(False)))


@query("""
with old as (select o_orderkey as game, o_totalprice as odds, o_orderdate as kickoff, timestamp '1998-02-01' as fetched from orders), new as (select o_orderkey as game, o_totalprice + 1 as odds, o_orderdate as kickoff, timestamp '1998-03-01' as fetched from orders where o_orderdate >= timestamp '1998-02-01')
select game, odds, kickoff, fetched from new where kickoff > timestamp '1998-03-01' union all select game, odds, kickoff, fetched from old where not (kickoff > timestamp '1998-03-01')
""")
def k07_frozen_archive(spark: SparkSession, d: str) -> DataFrame:
    """An archive of odds by game: a newer fetch replaces a game until its start; games that have begun keep what was last fetched before."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("game"), F.col("o_totalprice").alias("odds"), F.col("o_orderdate").alias("kickoff"))
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    old = orders.withColumn("fetched", stamp("1998-02-01"))
    new = orders.where(F.col("kickoff") >= stamp("1998-02-01")).withColumns({"odds": F.col("odds") + 1, "fetched": stamp("1998-03-01")}).where(F.col("kickoff") > F.col("fetched"))
    return new.unionByName(old.join(new.select("game"), "game", "left_anti"))


@query("""
with g as (select n_nationkey as team, n_regionkey as home, s_suppkey as game, s_acctbal as line from supplier join nation on n_nationkey = s_nationkey)
select game, 'fixtures' as kind, null::double as line, timestamp '2024-01-01' as known_at from g union all select game, 'lines', line, timestamp '2024-01-05' + interval 1 hour * (game % 24) from g
union all select game, 'weather', null, timestamp '2024-01-07' + interval 1 hour * (game % 24) - interval 90 minutes from g union all select game, 'results', line * 2, timestamp '2024-01-07' + interval 1 hour * (game % 24) + interval 4 hours from g
""")
def s09_schedule_tables(spark: SparkSession, d: str) -> DataFrame:
    """A schedule as four gated tables: fixtures known from the start, lines days before, weather 90 minutes before, results four hours after kickoff."""
    g = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("game"), F.col("s_acctbal").alias("line"))
    hours = F.make_dt_interval(F.lit(0), (F.col("game") % 24).cast("int"))
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    none = F.lit(None).cast("double")
    tables = (("fixtures", none, at("2024-01-01")), ("lines", F.col("line"), at("2024-01-05") + hours), ("weather", none, at("2024-01-07") + hours - F.expr("interval 90 minutes")), ("results", F.col("line") * 2, at("2024-01-07") + hours + F.expr("interval 4 hours")))
    return g.select("game", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("line"), t.alias("known_at")) for k, v, t in tables])))


@query("""
with f as (select user_id as team, date_diff('day', date '2024-01-01', cast(ts as date)) // 7 as week, arg_min(user_id * 10 + cast(json_extract(props, '$.k') as bigint) % 3, (ts, event_id)) as lead from events group by all)
select team, week, lead, lag(lead) over w as earlier, week - lag(week) over w as weeks_since, lag(lead) over w is not null and lag(lead) over w <> lead as changed from f window w as (partition by team order by week)
""")
def r17_lead_change(spark: SparkSession, d: str) -> DataFrame:
    """The leader of each team and week against that of the latest earlier week there is, which need not be the week before."""
    lead = F.min_by(F.col("user_id") * 10 + F.get_json_object("props", "$.k").cast("long") % 3, F.struct("ts", "event_id")).alias("lead")
    f = table(spark, d, "events").groupBy(F.col("user_id").alias("team"), F.floor(F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7).alias("week")).agg(lead)
    w = Window.partitionBy("team").orderBy("week")
    before = F.lag("lead").over(w)
    return f.select("team", "week", "lead", before.alias("earlier"), (F.col("week") - F.lag("week").over(w)).alias("weeks_since"), (before.isNotNull() & (before != F.col("lead"))).alias("changed"))


@query("""
with x as (select user_id, event_id, ts, upper(trim(event_type)) as status, cast(ts as date) + interval 18 hours as kickoff from events where cast(ts as date) between date '2024-01-08' and date '2024-01-14')
select user_id, cast(kickoff as timestamp) as kickoff, cast(kickoff - interval 90 minutes as timestamp) as known_at, count(*) as rows from x where status = 'ERROR' and ts < kickoff group by all
""")
def r14_inactives(spark: SparkSession, d: str) -> DataFrame:
    """Users listed as out for a day of the week asked for, only from rows before its start, known 90 minutes before it."""
    kickoff = F.to_date("ts").cast("timestamp_ntz") + F.expr("interval 18 hours")
    week = table(spark, d, "events").where((F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    out = week.withColumn("kickoff", kickoff).where((F.upper(F.trim("event_type")) == "ERROR") & (F.col("ts") < F.col("kickoff")))
    return out.groupBy("user_id", "kickoff", (F.col("kickoff") - F.expr("interval 90 minutes")).alias("known_at")).agg(F.count(F.lit(1)).alias("rows"))


@query("""
with a as (select l_orderkey as t, l_suppkey as player, 'add' as kind from lineitem where l_returnflag <> 'R' union all select l_orderkey, l_suppkey, 'drop' from lineitem where l_returnflag = 'R')
select t, player, kind, count(*) as n from a group by all
""")
def n11_transactions(spark: SparkSession, d: str) -> DataFrame:
    """Transactions with lists of adds and drops, flattened to one row a player and kind."""
    kinds = F.collect_list(F.when(F.col("l_returnflag") != "R", F.col("l_suppkey"))).alias("adds"), F.collect_list(F.when(F.col("l_returnflag") == "R", F.col("l_suppkey"))).alias("drops")
    nested = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("t")).agg(*kinds)
    flat = [nested.select("t", F.explode(c).alias("player"), F.lit(kind).alias("kind")) for c, kind in (("adds", "add"), ("drops", "drop"))]
    return flat[0].unionByName(flat[1]).groupBy("t", "player", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
with u as (select distinct user_id from events), w as (select distinct date_diff('day', date '2024-01-01', cast(ts as date)) // 7 as week from events), h as (select distinct user_id, date_diff('day', date '2024-01-01', cast(ts as date)) // 7 as week from events where event_type = 'purchase')
select user_id, week, max(have) over (partition by user_id order by week) as filled_from from (select u.user_id, w.week, h.week as have from u cross join w left join h on h.user_id = u.user_id and h.week = w.week) where true qualify have is null
""")
def t04_backfilled(spark: SparkSession, d: str) -> DataFrame:
    """Weeks, from the first to the last, without a snapshot of a user, each with the newest earlier week that has one to fill it from."""
    week = F.floor(F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7)
    rows = table(spark, d, "events").select("user_id", week.alias("week"), (F.col("event_type") == "purchase").alias("has"))
    have = rows.groupBy("user_id", "week").agg(F.max("has").alias("has"))
    low, high = rows.agg(F.min("week")).scalar(), rows.agg(F.max("week")).scalar()
    grid = have.select("user_id").distinct().select("user_id", F.explode(F.sequence(low, high)).alias("week"))
    full = grid.join(have.where("has"), ["user_id", "week"], "left").withColumn("filled_from", F.max(F.when(F.col("has"), F.col("week"))).over(Window.partitionBy("user_id").orderBy("week")))
    return full.where("has IS NULL").select("user_id", "week", "filled_from")
