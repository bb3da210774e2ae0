"""Feature families and further domain queries, built from gates, windows and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import windows
from tidemark.plans.registry import query
from tidemark.sources.tables import table

#: Daily lines of each user, for the SQL side.
_DAYS = """days as (select user_id, cast(ts as date) as day, count(*) as n, count(*) filter (event_type = 'view') as views, count(*) filter (event_type = 'purchase') as buys,
sum(cast(round(value, 2) as decimal(18,2))) as v from events group by all)"""


def days(spark: SparkSession, d: str) -> DataFrame:
    """One row per user and day with any event: counts by type and the summed value."""
    kind = lambda k: F.count_if(F.col("event_type") == k)
    cents = F.sum(F.round("value", 2).cast("decimal(18,2)"))
    return table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), kind("view").alias("views"), kind("purchase").alias("buys"), cents.alias("v"))


def past(n: int | None = None):
    """The n days of a user before the current one, or all of them."""
    return windows.before(["user_id"], [F.col("day")], n)


@query(f"""with {_DAYS}, t as (select *, sum(n) over (partition by user_id order by day rows between 3 preceding and 1 preceding) as use3 from days)
select user_id, day, rank() over (partition by day order by use3 desc nulls last) as usage_rank, coalesce(sum(use3) over (partition by day order by use3 desc nulls last range between unbounded preceding and current row), 0)::bigint as volume_to_here from t""")
def g08_role(spark: SparkSession, d: str) -> DataFrame:
    """Rank by usage of the three days before, and the volume of all ranked up to there."""
    rows = days(spark, d).withColumn("use3", F.sum("n").over(past(3)))
    w = Window.partitionBy("day").orderBy(F.col("use3").desc_nulls_last())
    return rows.select("user_id", "day", F.rank().over(w).cast("long").alias("usage_rank"), F.coalesce(F.sum("use3").over(w.rangeBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("volume_to_here"))


@query(f"""with {_DAYS}, s as (select user_id, day, n::double / sum(n) over (partition by day) as part from days)
select user_id, day, part, lag(part) over (partition by user_id order by day) as part_last from s""")
def g13_usage_share(spark: SparkSession, d: str) -> DataFrame:
    """Each user's share of its day's events, and the share on its last day before (NULL on the first)."""
    share = (F.col("n").cast("double") / F.sum("n").over(Window.partitionBy("day"))).alias("part")
    return days(spark, d).select("user_id", "day", share).withColumn("part_last", F.lag("part").over(Window.partitionBy("user_id").orderBy("day")))


@query(f"""with {_DAYS} select user_id, day, round((coalesce(sum(buys) over w, 0) + 10 * 0.2) / (coalesce(sum(views + buys) over w, 0) + 10), 6) as rate from days
window w as (partition by user_id order by day rows between unbounded preceding and 1 preceding)""")
def g14_efficiency(spark: SparkSession, d: str) -> DataFrame:
    """Efficiency before each day, drawn to a prior of 0.2 that counts as ten."""
    rate = S.shrunk(F.coalesce(F.sum("buys").over(past()), F.lit(0)), F.coalesce(F.sum(F.col("views") + F.col("buys")).over(past()), F.lit(0)), F.lit(0.2), 10)
    return days(spark, d).select("user_id", "day", F.round(rate, 6).alias("rate"))


@query(f"""with {_DAYS} select user_id, count(*) as n_days, round(stddev_pop(n) / nullif(avg(n), 0), 6) as variation, round(avg(case when n >= 4 then 1.0 else 0.0 end), 6) as boom_rate,
round(regr_slope(n, i), 6) + 0.0 as slope from (select *, row_number() over (partition by user_id order by day) as i from days) group by user_id having count(*) >= 2""")
def g16_shape(spark: SparkSession, d: str) -> DataFrame:
    """Variation, boom rate and trend of users with at least two days."""
    rows = days(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("day")))
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.round(F.stddev_pop("n") / F.nullif(F.avg("n"), F.lit(0.0)), 6).alias("variation"),
        F.round(F.avg(F.when(F.col("n") >= 4, 1.0).otherwise(0.0)), 6).alias("boom_rate"), (F.round(F.regr_slope("n", "i"), 6) + 0.0).alias("slope"),
    ).where("n_days >= 2")


@query("select l_suppkey, round(cast(sum(cast(l_discount as decimal(18,2)) * cast(l_quantity as decimal(18,2))) as double) / nullif(cast(sum(cast(l_quantity as decimal(18,2))) as double), 0), 9) as weighted from lineitem group by l_suppkey")
def g17_weighted_mean(spark: SparkSession, d: str) -> DataFrame:
    """Means weighted by volume: a ratio of sums."""
    q, x = F.col("l_quantity").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(18,2)")
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum(x * q).cast("double") / F.nullif(F.sum(q).cast("double"), F.lit(0.0)), 9).alias("weighted"))


@query(f"""with {_DAYS}, r as (select *, day + cast(((5 - isodow(day) + 6) % 7) + 1 as integer) as published from days)
select a.user_id, a.day, count(b.day) as reports, coalesce(sum(b.n), 0)::bigint as n_published from days a left join r b on a.user_id = b.user_id and b.published < a.day group by all""")
def g20_publication(spark: SparkSession, d: str) -> DataFrame:
    """What had been published before each day, when lines come out on the Friday after they happen."""
    rows = days(spark, d)
    line = rows.select("user_id", S.next_weekday(F.col("day"), "Fri").alias("at"), F.lit(1).alias("one"), F.col("n").alias("line_n"))
    target = rows.select("user_id", F.col("day").alias("at"), F.col("day"))
    # at one date the target sees only what came out on earlier ones
    both = target.unionByName(line, allowMissingColumns=True)
    number = F.date_diff("at", F.lit("1970-01-01").cast("date")).cast("long")
    w = Window.partitionBy("user_id").orderBy(number).rangeBetween(Window.unboundedPreceding, -1)
    seen = both.select("user_id", "day", F.count("one").over(w).alias("reports"), F.coalesce(F.sum("line_n").over(w), F.lit(0)).alias("n_published"))
    return seen.where("day IS NOT NULL")


@query("""with m as (select c_nationkey, c_mktsegment, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as mean from orders join customer on o_custkey = c_custkey group by all)
select c_nationkey, c_mktsegment, mean, rank() over (partition by c_mktsegment order by mean desc) as place from m""")
def g21_allowed(spark: SparkSession, d: str) -> DataFrame:
    """What each group allows by position, and its rank among groups."""
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    mean = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    rows = joined.groupBy("c_nationkey", "c_mktsegment").agg(mean.alias("mean"))
    return rows.withColumn("place", F.rank().over(Window.partitionBy("c_mktsegment").orderBy(F.col("mean").desc())).cast("long"))


@query(f"""with {_DAYS}, f as (select user_id, day, case when n < 3 then 1 else 0 end as out_, n from days)
select user_id, day, lag(user_id) over w as above, lag(out_) over w as above_out, lead(user_id) over w as below, lead(out_) over w as below_out from f window w as (partition by day order by n desc, user_id)""")
def g23_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The next users above and below by usage on each day, and whether they are out."""
    w = Window.partitionBy("day").orderBy(F.col("n").desc(), "user_id")
    rows = days(spark, d).withColumn("out_", F.when(F.col("n") < 3, 1).otherwise(0))
    return rows.select("user_id", "day", F.lag("user_id").over(w).alias("above"), F.lag("out_").over(w).alias("above_out"), F.lead("user_id").over(w).alias("below"), F.lead("out_").over(w).alias("below_out"))


@query(f"""with {_DAYS}, u as (select user_id, round(quantile_cont(n, 0.9), 6) as ceiling, median(n) as mid, max(n) as peak from days group by user_id)
select user_id, ceiling, mid, peak, round(coalesce(0.85 * ceiling, mid), 6) as keep from u""")
def r18_upside(spark: SparkSession, d: str) -> DataFrame:
    """Ceiling, median and peak, and a discounted keep value."""
    u = days(spark, d).groupBy("user_id").agg(F.round(F.percentile("n", 0.9), 6).alias("ceiling"), F.median("n").alias("mid"), F.max("n").alias("peak"))
    return u.withColumn("keep", F.round(F.coalesce(0.85 * F.col("ceiling"), F.col("mid")), 6))


@query("""with u as (select distinct o_custkey from orders where o_orderpriority = '1-URGENT'), r as (select c_mktsegment, max(c_acctbal) as level from customer where c_custkey not in (select o_custkey from u) group by 1)
select c_custkey, c_acctbal - level as over_level, greatest(c_acctbal - level, 0.0) * case when c_nationkey <= 10 then 1.0 else 0.7 end::double as keep_value from customer join r on customer.c_mktsegment = r.c_mktsegment where c_custkey in (select o_custkey from u)""")
def r19_keep_value(spark: SparkSession, d: str) -> DataFrame:
    """Value of held customers, those with an urgent order, over the best free one of their segment, times a step of a curve."""
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    c = table(spark, d, "customer")
    level = c.join(urgent, "c_custkey", "left_anti").groupBy("c_mktsegment").agg(F.max("c_acctbal").alias("level"))
    held = c.join(urgent, "c_custkey", "left_semi").join(level, "c_mktsegment").withColumn("over_level", F.col("c_acctbal") - F.col("level"))
    return held.select("c_custkey", "over_level", (F.greatest("over_level", F.lit(0.0)) * F.when(F.col("c_nationkey") <= 10, 1.0).otherwise(0.7)).alias("keep_value"))


@query("""with p as (select user_id, event_type, coalesce(cast(json_extract(props, '$.missing') as double), cast(json_extract(props, '$.k') as double)) as x from events)
select user_id, event_type, sum(x) / nullif(sum(sum(x)) over (partition by event_type), 0) as part from p group by user_id, event_type""")
def r21_committee(spark: SparkSession, d: str) -> DataFrame:
    """The first of several payload keys that is set, and each user's share of its type's total."""
    keys = F.from_json("props", "map<string,double>")
    x = F.coalesce(F.try_element_at(keys, F.lit("missing")), F.try_element_at(keys, F.lit("k")))
    sums = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum(x).alias("x"))
    return sums.select("user_id", "event_type", windows.share("x", ["event_type"]).alias("part"))


@query("""with g as (select c_nationkey as team, o_orderstatus as week, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as points from orders join customer on o_custkey = c_custkey group by all)
select a.team, a.week, a.points, b.team as opponent, b.points as points_against, a.points > b.points as won, a.points > (select median(points) from g where g.week = a.week) as median_won
from g a join g b on a.week = b.week and a.team // 2 = b.team // 2 and a.team <> b.team""")
def n06_matchups(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of each week's pairings, with wins against the opponent and the median."""
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    g = joined.groupBy(F.col("c_nationkey").alias("team"), F.col("o_orderstatus").alias("week")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("points"))
    pair = Window.partitionBy("week", F.floor(F.col("team") / 2)).orderBy("team")
    other = lambda c: F.coalesce(F.lag(c).over(pair), F.lead(c).over(pair))
    mid = g.groupBy("week").agg(F.median("points").alias("mid"))
    rows = g.select("team", "week", "points", other("team").alias("opponent"), other("points").alias("points_against")).where("opponent IS NOT NULL")
    return rows.join(F.broadcast(mid), "week").select("team", "week", "points", "opponent", "points_against", (F.col("points") > F.col("points_against")).alias("won"), (F.col("points") > F.col("mid")).alias("median_won"))


@query("select event_id, (1706745600 - case when k > 100000000000 then k / 1000.0 else k end)::double / 3600 as hours from (select event_id, case when event_id % 2 = 0 then epoch_us(ts) // 1000 else epoch_us(ts) // 1000000 end as k from events)")
def d06_epoch(spark: SparkSession, d: str) -> DataFrame:
    """Ages of stamps in seconds or milliseconds."""
    us = S.micros(F.col("ts"))
    k = F.when(F.col("event_id") % 2 == 0, F.floor(us / 1000)).otherwise(F.floor(us / 1000000))
    return table(spark, d, "events").select("event_id", S.epoch_hours(k, F.lit(1706745600)).alias("hours"))


@query("""with o as (select event_id, event_type from events where event_id % 3 <> 0), n as (select event_id, case when event_id % 10 = 0 then 'moved' else event_type end as event_type from events where event_id % 5 <> 1)
select coalesce(o.event_id, n.event_id) as event_id, case when o.event_id is null then 'added' when n.event_id is null then 'dropped' else 'changed' end as what
from o full join n on o.event_id = n.event_id where o.event_id is null or n.event_id is null or o.event_type <> n.event_type""")
def j29_overlay_diff(spark: SparkSession, d: str) -> DataFrame:
    """What a live overlay adds, drops and changes against a snapshot."""
    e = table(spark, d, "events")
    old = e.where("event_id % 3 <> 0").select("event_id", F.col("event_type").alias("was"))
    new = e.where("event_id % 5 <> 1").select("event_id", F.when(F.col("event_id") % 10 == 0, "moved").otherwise(F.col("event_type")).alias("now"))
    both = old.join(new, "event_id", "full_outer")
    what = S.first_that_holds([(F.col("was").isNull(), "added"), (F.col("now").isNull(), "dropped"), (F.col("was") != F.col("now"), "changed")], None)
    return both.select("event_id", what.alias("what")).where("what IS NOT NULL")


@query("""with old as (select * from events where event_id % 3 <> 0 and ts <= timestamp '2024-01-15'), new as (select * from events where event_id % 2 = 0 and ts <= timestamp '2024-01-15')
select user_id, count(*) filter (old.event_id is null) as missed, count(*) filter (old.event_id is not null and new.event_id is not null) as replaced from
(select event_id, user_id from old union select event_id, user_id from new) u left join (select event_id from old) old using (event_id) left join (select event_id from new) new using (event_id) group by user_id""")
def k06_freeze_audit(spark: SparkSession, d: str) -> DataFrame:
    """By group: frozen rows that were never recorded, and those that a rerun would have replaced."""
    started = table(spark, d, "events").where(F.col("ts") <= F.expr("TIMESTAMP_NTZ '2024-01-15'"))
    old, new = F.col("event_id") % 3 != 0, F.col("event_id") % 2 == 0
    return started.where(old | new).groupBy("user_id").agg(F.count_if(~old).alias("missed"), F.count_if(old & new).alias("replaced"))


@query("""with m as (select event_id, event_type, value, avg(value) over (partition by user_id order by ts, event_id rows between 3 preceding and 1 preceding) as a, lag(value) over (partition by user_id order by ts, event_id) as b from events),
s as (select * from m where a is not null and b is not null)
select event_type, comparator, count(*) as n, round(avg(abs(value - p)), 6) as mae from (select event_type, 'trailing' as comparator, value, a as p from s union all select event_type, 'last', value, b from s union all select event_type, 'fixed', value, 50.0 from s) group by all""")
def j26_comparators(spark: SparkSession, d: str) -> DataFrame:
    """Several comparators on the same rows, one pass."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, d, "events").select("event_type", "value", F.avg("value").over(w.rowsBetween(-3, -1)).alias("a"), F.lag("value").over(w).alias("b")).dropna(subset=["a", "b"])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("comparator"), c.cast("double").alias("p")) for n, c in (("trailing", F.col("a")), ("last", F.col("b")), ("fixed", F.lit(50.0)))])).alias("c")
    return rows.select("event_type", "value", each).groupBy("event_type", F.col("c.comparator").alias("comparator")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(F.col("value") - F.col("c.p"))), 6).alias("mae"))
