"""Point-in-time queries: everything a target may know, and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import micros
from tidemark.operators import gate, windows
from tidemark.plans.registry import query
from tidemark.sources.tables import table


def _orders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders")
    targets = orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("cutoff"))
    past = orders.select("o_custkey", F.col("o_orderkey").alias("p_key"), F.col("o_orderdate").alias("known_at"), F.col("o_totalprice").cast("decimal(18,2)").alias("p_total"))
    return targets, past


@query("""
with g as (
  select t.o_orderkey, t.o_custkey, t.o_orderdate as cutoff, p.o_orderdate as known_at, cast(p.o_totalprice as decimal(18,2)) as total,
         row_number() over (partition by t.o_orderkey order by p.o_orderdate desc nulls last, p.o_orderkey desc) as n
  from orders t left join orders p on p.o_custkey = t.o_custkey and p.o_orderdate < t.o_orderdate)
select o_orderkey, o_custkey, count(known_at) as n_before,
  cast(max(case when n = 1 then total end) as double) as last_total,
  cast(sum(case when n <= 3 then total end) as double) / nullif(count(case when n <= 3 then total end), 0) as mean_last_3,
  cast(sum(case when year(known_at) = year(cutoff) then total end) as double) / nullif(count(case when year(known_at) = year(cutoff) then total end), 0) as mean_season,
  cast(sum(case when year(known_at) = year(cutoff) - 1 then total end) as double) / nullif(count(case when year(known_at) = year(cutoff) - 1 then total end), 0) as mean_prior_season
from g group by o_orderkey, o_custkey
""")
def g02_order_history(spark: SparkSession, d: str) -> DataFrame:
    """For each order, what the customer's orders known strictly before it say.

    Running windows that end a microsecond before the order, so that a customer's orders are sorted
    once and never paired. Orders of one instant don't know each other; the last of several of an
    instant is the one with the highest key.
    """
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", micros(F.col("o_orderdate")).alias("at"), F.year("o_orderdate").alias("season"), F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    w = Window.partitionBy("o_custkey")
    last_three = w.orderBy("at", "o_orderkey").rowsBetween(-2, 0)
    rows = rows.withColumns({"s3": F.sum("total").over(last_three), "c3": F.count("total").over(last_three)})
    before = w.orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    this = Window.partitionBy("o_custkey", "season").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    prior = w.orderBy("season").rangeBetween(-1, -1)
    mean = lambda s, n: s.cast("double") / F.nullif(n, F.lit(0))
    last = F.max(F.struct("at", "o_orderkey", "total", "s3", "c3")).over(before)
    out = rows.select("o_orderkey", "o_custkey", F.count("at").over(before).alias("n_before"), last.alias("last"), *[mean(F.sum("total").over(x), F.count("total").over(x)).alias(name) for x, name in ((this, "mean_season"), (prior, "mean_prior_season"))])
    return out.select("o_orderkey", "o_custkey", "n_before", F.col("last.total").cast("double").alias("last_total"), mean(F.col("last.s3"), F.col("last.c3")).alias("mean_last_3"), "mean_season", "mean_prior_season")


@query("""
select p.event_id, p.user_id, v.event_id as view_id, epoch_us(p.ts) - epoch_us(v.ts) as micros_since
from (select * from events where event_type = 'purchase') p
left join lateral (select event_id, ts from events v where v.event_type = 'view' and v.user_id = p.user_id and v.ts < p.ts order by ts desc, event_id desc limit 1) v on true
""")
def j09_asof_backward(spark: SparkSession, d: str) -> DataFrame:
    """Each purchase with the user's newest view strictly before it."""
    events = table(spark, d, "events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    found = gate.latest_before(bought, views, ["user_id"], "ts", "view_ts", ["view_id"], "view_id")
    return found.select("event_id", "user_id", "view_id", (micros(F.col("ts")) - micros(F.col("view_ts"))).alias("micros_since"))


@query("""
select p.event_id, p.user_id, v.event_id as purchase_id
from (select * from events where event_type = 'view') p
left join lateral (select event_id, ts from events v where v.event_type = 'purchase' and v.user_id = p.user_id and v.ts > p.ts order by ts, event_id limit 1) v
  on v.ts <= p.ts + interval 8 days
""")
def j08_asof_forward(spark: SparkSession, d: str) -> DataFrame:
    """Each view with the user's first purchase strictly after it, within 8 days."""
    events = table(spark, d, "events")
    views = events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    bought = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("buy_ts"), F.col("event_id").alias("purchase_id"))
    found = gate.first_after(views, bought, ["user_id"], "ts", "buy_ts", ["purchase_id"], "purchase_id")
    soon = micros(F.col("buy_ts")) - micros(F.col("ts")) <= 8 * 86400 * 10**6
    return found.select("event_id", "user_id", F.when(soon, F.col("purchase_id")).alias("purchase_id"))


@query("""
with days as (select unnest(range(timestamp '2024-01-02', timestamp '2024-01-31', interval 1 day)) as slot),
r as (select e.user_id, e.event_id, d.slot, row_number() over (partition by e.user_id, d.slot order by e.ts desc, e.event_id desc) as n from events e join days d on e.ts < d.slot)
select distinct user_id, event_id from r where n = 1
""")
def j10_latest_before_slot(spark: SparkSession, d: str) -> DataFrame:
    """Events that are a user's newest before at least one of the month's midnights.

    An event counts for some midnight iff one lies between it and the user's next event: no pairs.
    """
    events = table(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    # midnights k days after 1 January, k from 1 to 29: those after the event and not after the next one
    from_start = lambda c: F.date_diff(F.to_date(c), F.lit("2024-01-01").cast("date"))
    rows = events.withColumn("next", F.lead("ts").over(w))
    first = F.greatest(from_start("ts") + 1, F.lit(1))
    last = F.coalesce(F.least(from_start("next"), F.lit(29)), F.lit(29))
    return rows.where(first <= last).select("user_id", "event_id")


@query("""
with s as (select user_id, max(ts) as t from events where ts <= timestamp '2024-01-15' group by user_id)
select e.user_id, e.event_id, e.event_type from events e join s on e.user_id = s.user_id and e.ts = s.t
""")
def j11_backfill(spark: SparkSession, d: str) -> DataFrame:
    """All rows of each user's newest stamp up to and including an instant."""
    events = table(spark, d, "events").where(F.col("ts") <= F.expr("TIMESTAMP_NTZ '2024-01-15'"))
    return windows.newest_snapshot(events, ["user_id"], "ts").select("user_id", "event_id", "event_type")


@query("select count(*) as n_rows, count(*) - count(ts) as n_unknown from events")
def g01_contract(spark: SparkSession, d: str) -> DataFrame:
    """One row: how many events there are, and how many lack the instant at which they became known."""
    return gate.check_contract(table(spark, d, "events"), "ts")


@query("""
select t.o_orderkey, count(p.o_orderkey) as n_before, coalesce(cast(sum(cast(p.o_totalprice as decimal(18,2))) as double), 0.0) as spent_before
from orders t left join orders p on p.o_custkey = t.o_custkey and p.o_orderdate < t.o_orderdate
where t.o_orderdate >= timestamp '1995-01-01' and t.o_orderdate < timestamp '1995-07-01' group by t.o_orderkey
""")
def y12_truncation(spark: SparkSession, d: str) -> DataFrame:
    """Gated sums built from physically truncated input, which must equal those from all of it.

    Running windows that end a microsecond before each order, so a customer's orders aren't paired.
    """
    low, high = (F.expr(f"TIMESTAMP_NTZ '{x}'") for x in ("1995-01-01", "1995-07-01"))
    cut = gate.truncated(table(spark, d, "orders"), "o_orderdate", high)
    before = Window.partitionBy("o_custkey").orderBy(micros(F.col("o_orderdate"))).rangeBetween(Window.unboundedPreceding, -1)
    sums = F.count("o_orderkey").over(before), F.coalesce(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).over(before).cast("double"), F.lit(0.0))
    return cut.select("o_orderkey", "o_orderdate", sums[0].alias("n_before"), sums[1].alias("spent_before")).where(F.col("o_orderdate") >= low).drop("o_orderdate")


@query("""
with d as (select user_id, cast(ts as date) as day, count(*) as n, count(*) filter (event_type = 'error') as errors from events group by all)
select user_id, day, n,
  lag(n, 1) over w as n_lag1, lag(n, 2) over w as n_lag2, lag(n, 3) over w as n_lag3,
  cast(sum(n) over (partition by user_id order by day rows between unbounded preceding and 1 preceding) as double) / nullif(count(*) over (partition by user_id order by day rows between unbounded preceding and 1 preceding), 0) as n_before_mean
from d window w as (partition by user_id order by day)
""")
def g07_lags(spark: SparkSession, d: str) -> DataFrame:
    """Lags over a user's active days (not calendar days) and the mean of all earlier ones."""
    days = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("user_id").orderBy("day")
    past = windows.before(["user_id"], [F.col("day")])
    mean = F.sum("n").over(past).cast("double") / F.nullif(F.count(F.lit(1)).over(past), F.lit(0))
    return days.select("user_id", "day", "n", *[F.lag("n", k).over(w).alias(f"n_lag{k}") for k in (1, 2, 3)], mean.alias("n_before_mean"))


@query("""
with days as (select distinct cast(ts as date) as day from events), users as (select distinct user_id from events),
s as (select user_id, cast(ts as date) as day, event_type, ts, event_id from events),
r as (select u.user_id, d.day, s.event_type, row_number() over (partition by u.user_id, d.day order by s.ts desc, s.event_id desc) as n,
      count(*) over (partition by u.user_id, d.day) as signals from users u cross join days d join s on s.user_id = u.user_id and s.day < d.day and s.day >= d.day - 3)
select user_id, day, event_type as newest_type, signals from r where n = 1
""")
def g05_spine(spark: SparkSession, d: str) -> DataFrame:
    """Who is eligible on each day: users with a signal in the three days before, and its freshest type."""
    events = table(spark, d, "events")
    signal = events.select("user_id", F.to_date("ts").alias("seen"), "event_type", "ts", "event_id")
    days = events.select(F.to_date("ts").alias("day")).distinct()
    # a signal reaches the three days after it, so it is handed forward instead of joined by range
    reach = signal.withColumn("day", F.explode(F.array(*[F.date_add("seen", k) for k in (1, 2, 3)])))
    spine = reach.join(F.broadcast(days), "day", "left_semi")
    return spine.groupBy("user_id", "day").agg(F.max(F.struct("ts", "event_id", "event_type"))["event_type"].alias("newest_type"), F.count(F.lit(1)).alias("signals"))


@query("""
with a as (select user_id, cast(ts as date) as day, count(*) as views from events where event_type = 'view' group by all),
b as (select user_id, cast(ts as date) as day, count(*) as buys from events where event_type = 'purchase' group by all)
select coalesce(a.user_id, b.user_id) as user_id, coalesce(a.day, b.day) as day, coalesce(views, 0) as views, coalesce(buys, 0) as buys,
  case when a.user_id is null then 'buy only' when b.user_id is null then 'view only' else 'both' end as seen
from a full join b on a.user_id = b.user_id and a.day = b.day
""")
def g06_history(spark: SparkSession, d: str) -> DataFrame:
    """One history of appearances from two facts, absent counts as zero."""
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    both = F.count_if(F.col("event_type") == "view"), F.count_if(F.col("event_type") == "purchase")
    rows = events.where("event_type in ('view', 'purchase')").groupBy("user_id", "day").agg(both[0].alias("views"), both[1].alias("buys"))
    seen = F.when(F.col("views") == 0, "buy only").when(F.col("buys") == 0, "view only").otherwise("both")
    return rows.select("user_id", "day", "views", "buys", seen.alias("seen"))


@query("""
with m as (select l_suppkey, l_returnflag, year(l_shipdate) as season, month(l_shipdate) as mon, sum(cast(l_quantity as decimal(18,2))) as q, sum(cast(l_extendedprice as decimal(18,2))) as p from lineitem group by all)
select l_suppkey, l_returnflag, season, mon, cast(q as double) as qty, cast(sum(q) over w as double) / nullif(cast(sum(p) over w as double), 0) as ratio_t3
from m window w as (partition by l_suppkey, l_returnflag order by season, mon rows between 3 preceding and 1 preceding)
""")
def w22_trailing_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Ratio of sums over the three months before, by supplier and flag."""
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)"))
    rows = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag", F.year("l_shipdate").cast("long").alias("season"), F.month("l_shipdate").cast("long").alias("mon")).agg(money("l_quantity").alias("q"), money("l_extendedprice").alias("p"))
    w = windows.before(["l_suppkey", "l_returnflag"], [F.col("season"), F.col("mon")], 3)
    ratio = F.sum("q").over(w).cast("double") / F.nullif(F.sum("p").over(w).cast("double"), F.lit(0.0))
    return rows.select("l_suppkey", "l_returnflag", "season", "mon", F.col("q").cast("double").alias("qty"), ratio.alias("ratio_t3"))


@query("""
with d as (select user_id, cast(ts as date) as day, count(*) filter (event_type = 'error') as errors from events group by all)
select d.user_id, d.day, coalesce(r.errors, 0) as errors_last, r.day as day_last, (select count(*) from d x where x.user_id = d.user_id and x.day < d.day and x.day >= d.day - 28 and x.errors > 0) as listed_4w
from d left join d r on r.user_id = d.user_id and r.day = (select max(y.day) from d y where y.user_id = d.user_id and y.day < d.day)
""")
def g10_report_family(spark: SparkSession, d: str) -> DataFrame:
    """The newest report before each day, and on how many days of four weeks one was filed."""
    days = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count_if(F.col("event_type") == "error").alias("errors"))
    w = Window.partitionBy("user_id").orderBy("day")
    number = F.date_diff("day", F.lit("1970-01-01").cast("date")).cast("long")
    month = Window.partitionBy("user_id").orderBy(number).rangeBetween(-28, -1)
    return days.select("user_id", "day", F.coalesce(F.lag("errors").over(w), F.lit(0)).alias("errors_last"), F.lag("day").over(w).alias("day_last"), F.coalesce(F.sum((F.col("errors") > 0).cast("long")).over(month), F.lit(0)).alias("listed_4w"))
