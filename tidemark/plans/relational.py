"""Joins, aggregates, set operations, sorts and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import aggregates, joins, windows
from tidemark.plans.registry import query
from tidemark.sources import sinks
from tidemark.sources.tables import table


def money(c: str):
    """Sums of a money column, exact until they become a double."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


@query("""
select o.o_orderkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name from orders o left join customer c on o.o_custkey = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey left join region r on n.n_regionkey = r.r_regionkey
""")
def j01_left_star(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their customer, nation and region; the small dimensions are broadcast by size."""
    orders, customer, nation, region = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    out = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left").join(places, customer["c_nationkey"] == places["n_nationkey"], "left")
    return out.select("o_orderkey", "c_name", "c_mktsegment", "n_name", "r_name")


@query("""
with s as (select l_suppkey, year(l_shipdate) as season, sum(cast(l_quantity as decimal(18,2))) as qty from lineitem group by all)
select a.l_suppkey, a.season, cast(a.qty as double) as qty, cast(b.qty as double) as prior_qty from s a left join s b on a.l_suppkey = b.l_suppkey and a.season = b.season + 1
""")
def j02_composite(spark: SparkSession, d: str) -> DataFrame:
    """Each supplier's season beside the one before it, NULL where it had none."""
    s = table(spark, d, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").cast("long").alias("season")).agg(money("l_quantity").alias("qty"))
    prior = s.select("l_suppkey", (F.col("season") + 1).alias("season"), F.col("qty").alias("prior_qty"))
    return s.join(prior, ["l_suppkey", "season"], "left")


@query("select n_name, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name")
def j03_inner(spark: SparkSession, d: str) -> DataFrame:
    """Totals by nation, summed by customer before the join so that less is shuffled."""
    by_customer = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t"))
    named = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return by_customer.join(named, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name").agg(F.sum("n").alias("n"), F.sum("t").cast("double").alias("total"))


@query("""
with y as (select o_custkey, year(o_orderdate) as s, cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as m from orders group by all),
c as (select * from y where s = 1997), p as (select * from y where s = 1996)
select coalesce(c.o_custkey, p.o_custkey) as o_custkey, case when c.m is not null and p.m is not null then 0.25 * p.m + 0.75 * c.m else coalesce(c.m, p.m) end as blend
from c full join p on c.o_custkey = p.o_custkey
""")
def j04_full_outer_blend(spark: SparkSession, d: str) -> DataFrame:
    """This year's mean blended with last year's; one pass over both years instead of a join."""
    orders = table(spark, d, "orders").where(F.year("o_orderdate").isin(1996, 1997))
    mean = lambda y: F.sum(F.when(F.year("o_orderdate") == y, F.col("o_totalprice").cast("decimal(18,2)"))).cast("double") / F.nullif(F.count_if(F.year("o_orderdate") == y), F.lit(0))
    both = orders.groupBy("o_custkey").agg(mean(1997).alias("c"), mean(1996).alias("p"))
    return both.select("o_custkey", S.blended(F.col("c"), F.col("p"), F.lit(0.25)).alias("blend"))


@query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def j05_semi(spark: SparkSession, d: str) -> DataFrame:
    """Customers with an urgent order, each once."""
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return table(spark, d, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def j05_anti(spark: SparkSession, d: str) -> DataFrame:
    """Customers without an urgent order; those without any order too."""
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return table(spark, d, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""
select distinct o_custkey, year(o_orderdate) as season from orders o
where not exists (select 1 from orders p where p.o_custkey = o.o_custkey and year(p.o_orderdate) = year(o.o_orderdate) and p.o_orderstatus = 'F')
""")
def j06_tuple_anti(spark: SparkSession, d: str) -> DataFrame:
    """Customers and seasons without a finished order; NULLs in keys equal each other."""
    rows = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("season"), "o_orderstatus")
    return sinks.anti(rows.select("o_custkey", "season").distinct(), rows.where("o_orderstatus = 'F'"), ["o_custkey", "season"])


@query("""
select e.event_id, u.first_type from events e left join (select user_id, arg_min(event_type, (ts, event_id)) as first_type from events group by user_id) u on e.user_id = u.user_id
""")
def j07_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A lookup with one value a key, the first by time."""
    events = table(spark, d, "events")
    first = windows.latest(events, ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()]).select("user_id", F.col("event_type").alias("first_type"))
    return events.join(first, "user_id", "left").select("event_id", "first_type")


@query("""
select a.s_suppkey, count(b.s_suppkey) as ahead, cast(coalesce(sum(cast(b.s_acctbal as decimal(18,2))), 0) as double) as balance_ahead
from supplier a left join supplier b on a.s_nationkey = b.s_nationkey and b.s_acctbal > a.s_acctbal group by a.s_suppkey
""")
def j12_ranked_ahead(spark: SparkSession, d: str) -> DataFrame:
    """How many of a group score above a row, and their sum: a RANGE window instead of a self-join."""
    above = Window.partitionBy("s_nationkey").orderBy(F.col("s_acctbal").desc())
    ties = Window.partitionBy("s_nationkey", "s_acctbal")
    cents = F.col("s_acctbal").cast("decimal(18,2)")
    return table(spark, d, "supplier").select(
        "s_suppkey", (F.rank().over(above) - 1).cast("long").alias("ahead"), (F.sum(cents).over(above.rangeBetween(Window.unboundedPreceding, 0)) - F.sum(cents).over(ties)).cast("double").alias("balance_ahead")
    )


@query("""
with m as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, o_totalprice as y, o_custkey as p from orders)
select a.day, count(*) as pairs, sum((sign(a.p - b.p) * sign(a.y - b.y) + 1) / 2.0) as credit from m a join m b on a.day = b.day and a.o_orderkey < b.o_orderkey and a.y <> b.y group by a.day
""")
def j13_pair_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a day's orders that a predictor puts in the right order."""
    rows = table(spark, d, "orders").where(F.col("o_orderdate").isNotNull()).select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", "o_totalprice", "o_custkey")
    return aggregates.pair_accuracy(rows, ["day"], "o_totalprice", "o_custkey", row="o_orderkey", blank=True)


@query("""
with a as (select p_name as k, min(p_partkey) as v from part group by p_name having count(distinct p_partkey) = 1),
b as (select p_type as k, min(p_partkey) as v from part group by p_type having count(distinct p_partkey) = 1)
select p.p_partkey, coalesce(a.v, b.v, -1) as found from part p left join a on p.p_name = a.k left join b on p.p_type = b.k
""")
def j15_cascade(spark: SparkSession, d: str) -> DataFrame:
    """The first crosswalk that knows a row, ambiguous keys removed from each."""
    part = table(spark, d, "part")
    lookups = [(key, joins.unambiguous(part, key, "p_partkey")) for key in ("p_name", "p_type")]
    out = joins.cascade(part.select(F.col("p_partkey").alias("id"), "p_name", "p_type"), lookups, "found")
    return out.select(F.col("id").alias("p_partkey"), F.coalesce("found", F.lit(-1).cast("long")).alias("found"))


@query("""
with p as (select * from events where event_type = 'purchase'), c as (select * from events where event_type = 'click'),
j as (select p.event_id, c.event_id as near_id, abs(epoch_us(p.ts) - epoch_us(c.ts)) as gap, row_number() over (partition by p.event_id order by abs(epoch_us(p.ts) - epoch_us(c.ts)), c.event_id) as n
  from p join c on p.user_id = c.user_id and abs(epoch_us(p.ts) - epoch_us(c.ts)) <= 86400000000)
select event_id, near_id, gap from j where n = 1
""")
def j18_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Each purchase with the user's click closest in time, within a day."""
    events = table(spark, d, "events")
    p = events.where("event_type = 'purchase'").select("event_id", "user_id", S.micros(F.col("ts")).alias("t"))
    c = events.where("event_type = 'click'").select(F.col("event_id").alias("near_id"), "user_id", S.micros(F.col("ts")).alias("t"))
    return joins.nearest(p, c, "user_id", "t", "near_id", 86400 * 10**6).select("event_id", "near_id", "gap")


@query("""
select u.user_id, d.day from (select distinct user_id from events) u cross join (select distinct cast(ts as date) as day from events) d
where not exists (select 1 from events e where e.user_id = u.user_id and cast(e.ts as date) = d.day)
""")
def j20_idle_days(spark: SparkSession, d: str) -> DataFrame:
    """Users and days without an event, as explicit rows."""
    events = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    return joins.missing_combinations(events.select("user_id").distinct(), events.select("day").distinct(), events, ["user_id", "day"])


@query("""
select a.user_id, a.event_id, b.event_id as other_id from (select * from events where event_type = 'view') a join (select * from events where event_type = 'view') b
on a.user_id = b.user_id and cast(a.ts as date) = cast(b.ts as date) and a.event_id <> b.event_id
where (select count(*) from events x where x.event_type = 'view' and x.user_id = a.user_id and cast(x.ts as date) = cast(a.ts as date)) = 2
""")
def j21_two_sides(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of pairs of exactly two, from one grouping."""
    views = table(spark, d, "events").where("event_type = 'view'")
    pairs = views.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("x"), F.max("event_id").alias("y")).where("n = 2")
    return pairs.select("user_id", F.explode(F.array(F.struct(F.col("x").alias("event_id"), F.col("y").alias("other_id")), F.struct(F.col("y").alias("event_id"), F.col("x").alias("other_id")))).alias("s")).select("user_id", "s.*")


@query("select p_partkey, case when p_size <= 10 then 1.0 when p_size <= 25 then 0.8 when p_size <= 40 then 0.5 else 0.2 end::double as curve from part")
def j22_step_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The value of the first step whose edge is at or above the size; NULL sizes have none."""
    return table(spark, d, "part").select("p_partkey", joins.step_value(F.col("p_size"), [(10, 1.0), (25, 0.8), (40, 0.5)], 0.2).alias("curve"))


@query("select l_suppkey, l_returnflag, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as double) as qty, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price from lineitem group by all")
def a01_sums(spark: SparkSession, d: str) -> DataFrame:
    """One row per supplier and flag, sums exact."""
    return table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), money("l_quantity").alias("qty"), money("l_extendedprice").alias("price"))


@query("""
select l_suppkey, case when grouping(l_returnflag) = 1 then 'ALL' else l_returnflag end as l_returnflag, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as double) as qty
from lineitem group by grouping sets ((l_suppkey, l_returnflag), (l_suppkey))
""")
def a02_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """One row per supplier and flag, and one per supplier over all flags, in one pass."""
    return aggregates.with_total(table(spark, d, "lineitem"), ["l_suppkey"], "l_returnflag", [F.count(F.lit(1)).alias("n"), money("l_quantity").alias("qty")])


@query("select user_id, count(*) / nullif(count(distinct cast(ts as date)), 0)::double as a_day from events group by user_id")
def a03_per_day(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user over the days on which it has any."""
    return table(spark, d, "events").groupBy("user_id").agg((F.count(F.lit(1)) / F.nullif(F.count_distinct(F.to_date("ts")), F.lit(0))).alias("a_day"))


@query("""
select l_suppkey, count(*) filter (l_returnflag = 'R') as returned, cast(coalesce(sum(cast(l_quantity as decimal(18,2))) filter (l_linestatus = 'O'), 0) as double) as open_qty,
cast(sum(cast(l_extendedprice as decimal(18,2))) filter (l_discount > 0.05) as double) / nullif(cast(sum(cast(l_quantity as decimal(18,2))) filter (l_discount > 0.05) as double), 0) as price_a_unit
from lineitem group by l_suppkey
""")
def a04_filtered_sums(spark: SparkSession, d: str) -> DataFrame:
    """Conditional counts, sums and a ratio of sums in one pass."""
    cents = lambda c, cond: F.sum(F.when(cond, F.col(c).cast("decimal(18,2)"))).cast("double")
    deal = F.col("l_discount") > 0.05
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.coalesce(cents("l_quantity", F.col("l_linestatus") == "O"), F.lit(0.0)).alias("open_qty"),
        (cents("l_extendedprice", deal) / F.nullif(cents("l_quantity", deal), F.lit(0.0))).alias("price_a_unit"),
    )


@query("""
with days as (select distinct cast(ts as date) as day from events), f as (select user_id, min(cast(ts as date)) as first from events group by user_id),
c as (select user_id, cast(ts as date) as day, count(*) as n from events group by all)
select f.user_id, count(*) as days, sum(coalesce(c.n, 0))::bigint as n, sum(coalesce(c.n, 0))::double / count(*) as mean_zero_filled
from f join days on days.day >= f.first left join c on c.user_id = f.user_id and c.day = days.day group by f.user_id
""")
def a07_zero_filled(spark: SparkSession, d: str) -> DataFrame:
    """Means over calendar days from a user's first on, absent days as zero.

    Only counts are needed, so days after the first are counted by rank instead of joined.
    """
    events = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    per_user = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("first"))
    days = events.select("day").distinct().withColumn("days", F.count(F.lit(1)).over(Window.orderBy(F.col("day").desc())))
    out = per_user.join(F.broadcast(days), per_user["first"] == days["day"])
    return out.select("user_id", "days", "n", (F.col("n").cast("double") / F.col("days")).alias("mean_zero_filled"))


@query("select event_type, round(stddev_pop(value), 6) as sd_pop, round(stddev_samp(value), 6) as sd_samp, round(quantile_cont(value, 0.1), 6) as p10, round(median(value), 6) as p50, round(quantile_cont(value, 0.9), 6) as p90 from events group by event_type")
def a09_spread(spark: SparkSession, d: str) -> DataFrame:
    """Standard deviations and exact quantiles (also A10); quantiles are taken over counts by value, so a group's rows are never in one buffer."""
    e = table(spark, d, "events")
    q = lambda p: F.round(F.percentile("value", p, F.col("times")), 6)
    quantiles = e.where("value IS NOT NULL").groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("times")).groupBy("event_type").agg(q(0.1).alias("p10"), q(0.5).alias("p50"), q(0.9).alias("p90"))
    spread = e.groupBy("event_type").agg(F.round(F.stddev_pop("value"), 6).alias("sd_pop"), F.round(F.stddev_samp("value"), 6).alias("sd_samp"))
    return spread.join(quantiles, "event_type", "left").select("event_type", "sd_pop", "sd_samp", "p10", "p50", "p90")


@query("select user_id, round(regr_slope(value, i), 6) + 0.0 as slope from (select user_id, value, row_number() over (partition by user_id order by ts, event_id) as i from events) group by user_id")
def a11_slope(spark: SparkSession, d: str) -> DataFrame:
    """The slope of a user's values over their order in time; NULL with a single one."""
    out = aggregates.slope(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "value")
    return out.select("user_id", (F.round("slope", 6) + 0.0).alias("slope"))


@query("select round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept, round(regr_slope(l_extendedprice, l_quantity), 4) as slope from lineitem")
def a12_least_squares(spark: SparkSession, d: str) -> DataFrame:
    """A linear fit from sums of products; only the small system is solved on the driver."""
    fit = aggregates.least_squares(table(spark, d, "lineitem"), ["l_quantity"], "l_extendedprice")
    return spark.range(1).select(F.round(F.lit(fit[0]), 4).alias("intercept"), F.round(F.lit(fit[1]), 4).alias("slope"))


@query("""
with r as (select event_type, rank() over (partition by event_type order by value) + (count(*) over (partition by event_type, value) - 1) / 2.0 as x,
  rank() over (partition by event_type order by user_id) + (count(*) over (partition by event_type, user_id) - 1) / 2.0 as y from events where value is not null)
select event_type, round(corr(x, y), 6) as rho, count(*) as n from r group by event_type
""")
def a13_spearman(spark: SparkSession, d: str) -> DataFrame:
    """Rank correlation of value and user by event type, ties sharing their mean rank; small groups are left out."""
    out = aggregates.spearman(table(spark, d, "events"), ["event_type"], "value", "user_id")
    return out.select("event_type", F.round("rho", 6).alias("rho"), "n")


@query("select user_id, count(*) filter (event_type = 'view') as view, count(*) filter (event_type = 'click') as click, count(*) filter (event_type = 'purchase') as purchase from events group by user_id")
def a14_pivot(spark: SparkSession, d: str) -> DataFrame:
    """One row per user, a column for each of three types, 0 where it has none."""
    kinds = ["view", "click", "purchase"]
    return table(spark, d, "events").groupBy("user_id").pivot("event_type", kinds).agg(F.count(F.lit(1))).na.fill(0, kinds)


@query("select user_id, event_type as usual from (select user_id, event_type, row_number() over (partition by user_id order by count(*) desc, event_type desc) as n from events group by user_id, event_type) where n = 1")
def a15_mode(spark: SparkSession, d: str) -> DataFrame:
    """Each user's most frequent type; of equally frequent ones the last by name."""
    counts = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("user_id").agg(F.max(F.struct("n", "event_type"))["event_type"].alias("usual"))


@query("select user_id, string_agg(event_type, ';' order by ts, event_id) as chain, count(distinct event_type) as kinds from events where value > 50 group by user_id")
def a17_ordered_list(spark: SparkSession, d: str) -> DataFrame:
    """Ordered text aggregation and a set size."""
    parts = F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type")))
    return table(spark, d, "events").where("value > 50").groupBy("user_id").agg(F.array_join(F.transform(parts, lambda p: p["event_type"]), ";").alias("chain"), F.count_distinct("event_type").alias("kinds"))


@query("select c_mktsegment, max(c_acctbal) as best, arg_max(c_custkey, (c_acctbal, c_custkey)) as best_key from customer group by c_mktsegment")
def a19_best(spark: SparkSession, d: str) -> DataFrame:
    """Each segment's largest balance and whose it is; of equal ones the largest key."""
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(F.max("c_acctbal").alias("best"), F.max_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("best_key"))


@query("""
with u as (select user_id, count(*) filter (event_type = 'purchase') as s, count(*) as n from events group by user_id)
select user_id, (s + 20 * (select sum(s)::double / sum(n) from u)) / (n + 20) as rate from u
""")
def a20_shrinkage(spark: SparkSession, d: str) -> DataFrame:
    """Purchase rates drawn to everyone's; the prior is one row, joined without a shuffle."""
    users = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("s"), F.count(F.lit(1)).alias("n"))
    prior = users.agg((F.sum("s").cast("double") / F.sum("n")).alias("prior"))
    return users.crossJoin(F.broadcast(prior)).select("user_id", S.shrunk(F.col("s"), F.col("n"), F.col("prior"), 20).alias("rate"))


def _forecast(spark: SparkSession, d: str) -> DataFrame:
    past = windows.before(["user_id"], [F.col("ts"), F.col("event_id")], 3)
    return table(spark, d, "events").withColumn("p", F.avg("value").over(past)).where("p IS NOT NULL")


_FORECAST = "f as (select * from (select *, avg(value) over (partition by user_id order by ts, event_id rows between 3 preceding and 1 preceding) as p from events) where p is not null)"


@query(f"with {_FORECAST} select event_type, count(*) as n, round(avg(abs(value - p)), 6) as mae, round(sqrt(avg((value - p) * (value - p))), 6) as rmse, round(avg(value - p), 6) as bias from f group by event_type")
def a22_error_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Errors of a trailing mean, from additive pieces."""
    e = F.col("value") - F.col("p")
    return _forecast(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(e)), 6).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"), F.round(F.avg(e), 6).alias("bias"))


@query(f"""with {_FORECAST} select event_type, round(avg(case when value between 0.5 * p and 1.5 * p then 1.0 else 0.0 end), 6) as covered,
round(avg(greatest(0.9 * (value - 1.5 * p), (0.9 - 1) * (value - 1.5 * p))), 6) as pinball_90, round(avg(p), 6) as width from f group by event_type""")
def a23_calibration(spark: SparkSession, d: str) -> DataFrame:
    """Coverage, pinball loss and width of the bands by event type."""
    v, p = F.col("value"), F.col("p")
    return _forecast(spark, d).groupBy("event_type").agg(
        F.round(F.avg(F.when(v.between(0.5 * p, 1.5 * p), 1.0).otherwise(0.0)), 6).alias("covered"), F.round(F.avg(aggregates.pinball(v, 1.5 * p, 0.9)), 6).alias("pinball_90"), F.round(F.avg(p), 6).alias("width")
    )


@query(f"with {_FORECAST}, w as (select *, avg(value) over (partition by event_type) as m from f) select event_type, round(1 - avg((value - p) * (value - p)) / avg((value - m) * (value - m)), 6) as skill from w group by event_type")
def a24_skill(spark: SparkSession, d: str) -> DataFrame:
    """Skill against a constant: the reference error is the population variance, so no window is needed."""
    e = F.col("value") - F.col("p")
    return _forecast(spark, d).groupBy("event_type").agg(F.round(1 - F.avg(e * e) / F.var_pop("value"), 6).alias("skill"))


@query("select o_orderpriority, round(avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end), 6) as share_f, count(*) - count(nullif(o_orderstatus, 'P')) as n_p from orders group by o_orderpriority")
def a27_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of a status by priority; NULL statuses count in the whole."""
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.round(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)), 6).alias("share_f"), F.count_if(F.nullif("o_orderstatus", F.lit("P")).isNull()).alias("n_p"))


@query("select case when p_size <= 10 then '01-10' when p_size <= 30 then '11-30' else '31+' end as bucket, count(*) as n, cast(sum(cast(p_retailprice as decimal(18,2))) as double) as price from part group by bucket")
def a29_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Parts and their mean price by range of size."""
    bucket = S.first_that_holds([(F.col("p_size") <= 10, "01-10"), (F.col("p_size") <= 30, "11-30")], "31+")
    return table(spark, d, "part").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), money("p_retailprice").alias("price"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def o03_top(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report."""
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25)


@query("select c_custkey as id, c_name as name, c_mktsegment as segment from customer union all by name select s_suppkey as id, s_name as name from supplier")
def u01_union(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers under common names; columns that a side lacks are NULL."""
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query("select c_custkey from customer except select o_custkey from orders")
def u02_difference(spark: SparkSession, d: str) -> DataFrame:
    """Customers without any order, each once."""
    return table(spark, d, "customer").select("c_custkey").subtract(table(spark, d, "orders").select("o_custkey"))


@query("select l_suppkey from lineitem where l_returnflag = 'R' intersect select l_suppkey from lineitem where l_linestatus = 'O'")
def u03_intersection(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers with a returned and an open line, each once."""
    lines = table(spark, d, "lineitem")
    return lines.where("l_returnflag = 'R'").select("l_suppkey").intersect(lines.where("l_linestatus = 'O'").select("l_suppkey"))


@query("select user_id as id from events union select o_custkey as id from orders")
def u04_distinct_union(spark: SparkSession, d: str) -> DataFrame:
    """Ids that are a user's or a customer's, each once."""
    return table(spark, d, "events").select(F.col("user_id").alias("id")).union(table(spark, d, "orders").select("o_custkey")).distinct()


_NEW = "n as (select o_custkey, year(o_orderdate) as season, count(*) as n from orders where o_orderdate >= timestamp '1997-01-01' group by all), old as (select o_custkey, year(o_orderdate) as season, -1::bigint as n from orders where o_orderdate < timestamp '1998-01-01' group by all)"


def _old_new(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders").withColumn("season", F.year("o_orderdate").cast("long"))
    new = orders.where("season >= 1997").groupBy("o_custkey", "season").agg(F.count(F.lit(1)).alias("n"))
    return orders.where("season < 1998").select("o_custkey", "season").distinct().withColumn("n", F.lit(-1).cast("long")), new


@query(f"with {_NEW} select * from old where not exists (select 1 from n where n.o_custkey = old.o_custkey and n.season = old.season) union all select * from n")
def k01_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Old rows, with the new ones in place of those with the same keys."""
    return sinks.upserted(*_old_new(spark, d), ["o_custkey", "season"])


@query(f"with {_NEW} select * from old where season not in (select season from n) union all select * from n")
def k02_replace_partition(spark: SparkSession, d: str) -> DataFrame:
    """Old rows, with every season that has new rows replaced whole."""
    return sinks.replaced_partitions(*_old_new(spark, d), ["season"])


@query("""
with old as (select event_id, user_id, ts, value, 'old' as src from events where event_id % 3 <> 0), new as (select event_id, user_id, ts, value + 1 as value, 'new' as src from events where event_id % 2 = 0),
f as (select * from old where ts <= timestamp '2024-01-15' + interval 10 minutes)
select event_id, src, value, true as frozen from f union all
select event_id, src, value, false as frozen from new where event_id not in (select event_id from f) and user_id not in (select user_id from f)
""")
def k05_frozen_merge(spark: SparkSession, d: str) -> DataFrame:
    """Started events keep their old rows; the rest takes the new ones."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    old = events.where("event_id % 3 <> 0").withColumn("src", F.lit("old"))
    new = events.where("event_id % 2 = 0").withColumn("value", F.col("value") + 1).withColumn("src", F.lit("new"))
    return sinks.frozen_merged(old, new, ["event_id"], "user_id", "ts", F.expr("TIMESTAMP_NTZ '2024-01-15'")).select("event_id", "src", "value", "frozen")


@query("""
with r as (select 'orders' as t, 'keys' as chk, count(*) - count(distinct o_orderkey) as bad from orders union all select 'nation', 'count', abs(count(*) - 25) from nation
union all select 'lineitem', 'orders', count(*) from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey) union all select 'events', 'values', count(*) - count(value) from events)
select t, chk, bad, case when bad = 0 then 'PASS' when bad < 10 then 'WARN' else 'FAIL' end as severity from r
""")
def r23_integrity(spark: SparkSession, d: str) -> DataFrame:
    """One row a check: what it covers, what breaks it, how severe that is."""
    row = lambda df, t, c, bad: df.agg(bad.cast("long").alias("bad")).select(F.lit(t).alias("t"), F.lit(c).alias("chk"), "bad")
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    lost = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left_anti")
    every = [
        row(orders, "orders", "keys", F.count(F.lit(1)) - F.count_distinct("o_orderkey")), row(table(spark, d, "nation"), "nation", "count", F.abs(F.count(F.lit(1)) - 25)),
        row(lost, "lineitem", "orders", F.count(F.lit(1))), row(table(spark, d, "events"), "events", "values", F.count_if(F.col("value").isNull())),
    ]
    out = every[0]
    for x in every[1:]:
        out = out.unionByName(x)
    return out.withColumn("severity", S.first_that_holds([(F.col("bad") == 0, "PASS"), (F.col("bad") < 10, "WARN")], "FAIL"))
