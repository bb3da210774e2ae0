"""Window queries, dates, and event-time windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import windows
from tidemark.plans.registry import query
from tidemark.sources.tables import table

ORDER = ["ts", "event_id"]


def events(spark: SparkSession, d: str) -> DataFrame:
    """The events table."""
    return table(spark, d, "events")


def user():
    """A user's events in time; of one instant by their ids."""
    return Window.partitionBy("user_id").orderBy(*ORDER)


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n = 1")
def w01_latest(spark: SparkSession, d: str) -> DataFrame:
    """Each user's newest event; of one instant that with the larger id."""
    return windows.latest(events(spark, d), ["user_id"], [F.col(c).desc() for c in ORDER]).select("user_id", "event_id", "event_type")


@query("select o_custkey, o_orderkey from orders o where o_orderdate = (select max(o_orderdate) from orders p where p.o_custkey = o.o_custkey)")
def w02_newest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """All orders of a customer's newest day."""
    return windows.newest_snapshot(table(spark, d, "orders"), ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey")


@query("select s_suppkey, s_acctbal / nullif(cast(sum(cast(s_acctbal as decimal(18,2))) over (partition by s_nationkey) as double), 0) as part from supplier")
def w03_share(spark: SparkSession, d: str) -> DataFrame:
    """Each supplier's balance over its nation's, NULL where that is 0."""
    total = F.sum(F.col("s_acctbal").cast("decimal(18,2)")).over(Window.partitionBy("s_nationkey")).cast("double")
    return table(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") / F.nullif(total, F.lit(0.0))).alias("part"))


@query("select p_partkey, rank() over (partition by p_brand order by p_size desc) as rank_min, rank() over (partition by p_brand order by p_size) + (count(*) over (partition by p_brand, p_size) - 1) / 2.0::double as rank_avg, row_number() over (partition by p_brand order by p_size, p_partkey) as rank_first from part")
def w04_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Ranks with ties lowest, averaged, and by first place."""
    first = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_size", "p_partkey")).cast("long")
    return table(spark, d, "part").select("p_partkey", windows.rank_min(["p_brand"], F.col("p_size").desc(), "p_size").cast("long").alias("rank_min"), windows.rank_average(["p_brand"], "p_size").alias("rank_avg"), first.alias("rank_first"))


@query("select user_id, count(*) as n, round(avg(value), 6) as mean from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n <= 3 group by user_id")
def w07_last_three(spark: SparkSession, d: str) -> DataFrame:
    """Mean over each user's last three events; fewer if it has fewer."""
    rows = windows.last_n(events(spark, d), ["user_id"], [F.col(c).desc() for c in ORDER], 3)
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("with w as (select *, cast(date_trunc('week', ts) as date) as wk from events) select user_id, count(*) as n from w where wk in (select distinct wk from w order by wk desc limit 2) group by user_id")
def w08_last_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Rows of everyone's last two distinct weeks."""
    rows = events(spark, d).withColumn("wk", F.to_date(F.date_trunc("week", "ts")))
    weeks = rows.select("wk").distinct().orderBy(F.col("wk").desc()).limit(2)
    return rows.join(F.broadcast(weeks), "wk", "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("select event_id, case when lag(event_type) over w = event_type then epoch_us(ts) - epoch_us(lag(ts) over w) end as gap from events window w as (partition by user_id order by ts, event_id)")
def w09_guarded_gap(spark: SparkSession, d: str) -> DataFrame:
    """Time since the row before, where that is of the same type."""
    w = user()
    gap = S.micros(F.col("ts")) - S.micros(F.lag("ts").over(w))
    return events(spark, d).select("event_id", F.when(F.lag("event_type").over(w) == F.col("event_type"), gap).alias("gap"))


@query("""
select event_id, lag(value, 1) over w as lag1, lag(value, 2) over w as lag2, count(value) over (w rows between unbounded preceding and 1 preceding) as n_before,
round(avg(value) over (w rows between unbounded preceding and 1 preceding), 6) as mean_before, round(avg(value) over (w rows between 3 preceding and 1 preceding), 6) as mean_t3
from events window w as (partition by user_id, date_trunc('week', ts) order by ts, event_id)
""")
def w10_lags(spark: SparkSession, d: str) -> DataFrame:
    """Lags, and means of all rows and of three rows before, within the week."""
    keys = ["user_id", "wk"]
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    past, three = (windows.before(keys, [F.col(c) for c in ORDER], n) for n in (None, 3))
    rows = events(spark, d).withColumn("wk", F.date_trunc("week", "ts"))
    return rows.select(
        "event_id", F.lag("value", 1).over(w).alias("lag1"), F.lag("value", 2).over(w).alias("lag2"), F.count("value").over(past).alias("n_before"),
        F.round(F.avg("value").over(past), 6).alias("mean_before"), F.round(F.avg("value").over(three), 6).alias("mean_t3"),
    )


@query("""
with s as (select user_id, date_trunc('week', ts) as wk, sum(cast(round(value, 2) as decimal(18,2))) as v, count(*) as n from events group by all)
select user_id, cast(wk as date) as wk, cast(sum(v) over p as double) / nullif(sum(n) over p, 0) as mean_two_weeks from s window p as (partition by user_id order by wk range between interval 14 days preceding and interval 1 days preceding)
""")
def w12_prior_period(spark: SparkSession, d: str) -> DataFrame:
    """Means over the two calendar weeks before, whatever rows they have."""
    week = F.to_date(F.date_trunc("week", "ts"))
    rows = events(spark, d).groupBy("user_id", week.alias("wk")).agg(F.sum(F.round("value", 2).cast("decimal(18,2)")).alias("v"), F.count(F.lit(1)).alias("n"))
    day = F.date_diff("wk", F.lit("1970-01-01").cast("date")).cast("long")
    p = Window.partitionBy("user_id").orderBy(day).rangeBetween(-14, -1)
    return rows.select("user_id", "wk", (F.sum("v").over(p).cast("double") / F.nullif(F.sum("n").over(p), F.lit(0))).alias("mean_two_weeks"))


@query("""
with s as (select user_id, event_id, ts, sign(value - 50) as s, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events),
l as (select user_id, s as last from s where n = 1), e as (select s.user_id, min(n) as ended from s join l on s.user_id = l.user_id where s.s <> l.last group by s.user_id)
select l.user_id, cast(l.last * least(coalesce(e.ended - 1, (select count(*) from s where s.user_id = l.user_id)), 6) as integer) as run from l left join e on l.user_id = e.user_id
""")
def w13_run_length(spark: SparkSession, d: str) -> DataFrame:
    """The run of values over or under 50 at each user's end, signed, 6 at most; a 50 ends it."""
    rows = events(spark, d).withColumn("over", F.col("value") - 50)
    return windows.run_length(rows, ["user_id"], [F.col(c) for c in ORDER], "over", 6)


@query("""
with s as (select user_id, event_id, event_type = 'purchase' as hit, row_number() over (partition by user_id order by ts, event_id) as i from events),
g as (select *, i - row_number() over (partition by user_id, hit order by i) as island from s), r as (select user_id, hit, island, count(*) as len from g group by all)
select user_id, coalesce(max(len) filter (hit), 0) as longest_hit, coalesce(max(len) filter (not hit), 0) as longest_miss from r group by user_id
""")
def w14_streaks(spark: SparkSession, d: str) -> DataFrame:
    """The longest runs of purchases and of anything else: islands by the difference of two row numbers."""
    s = events(spark, d).select("user_id", (F.col("event_type") == "purchase").alias("hit"), F.row_number().over(user()).alias("i"))
    island = F.col("i") - F.row_number().over(Window.partitionBy("user_id", "hit").orderBy("i"))
    runs = s.withColumn("island", island).groupBy("user_id", "hit", "island").agg(F.count(F.lit(1)).alias("len"))
    longest = lambda hit: F.coalesce(F.max(F.when(F.col("hit") == hit, F.col("len"))), F.lit(0))
    return runs.groupBy("user_id").agg(longest(True).alias("longest_hit"), longest(False).alias("longest_miss"))


@query("""
with m as (select user_id, value, avg(value) over (partition by user_id order by ts, event_id rows between 2 preceding and current row) as m, row_number() over (partition by user_id order by ts, event_id) as n from events where value is not null)
select user_id, round(coalesce(max(m) filter (n >= 3), avg(value)), 6) as best from m group by user_id
""")
def w15_rolling_best(spark: SparkSession, d: str) -> DataFrame:
    """The best mean of three of a user's events in turn; of fewer their mean."""
    return windows.rolling_best(events(spark, d), ["user_id"], [F.col(c) for c in ORDER], "value").select("user_id", F.round("best", 6).alias("best"))


@query("select user_id, event_type, n from (select *, row_number() over (partition by event_type order by n desc, user_id) as r from (select user_id, event_type, count(*) as n from events group by all)) where r <= 5")
def w17_top_per_group(spark: SparkSession, d: str) -> DataFrame:
    """A top-five report of each type."""
    counts = events(spark, d).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return windows.last_n(counts, ["event_type"], [F.col("n").desc(), F.col("user_id")], 5)


@query("select e.event_id, round(e.value / nullif(q.p95, 0), 6) as part_of_p95 from events e join (select event_type, quantile_cont(value, 0.95) as p95 from events group by event_type) q on e.event_type = q.event_type")
def w18_p95_norm(spark: SparkSession, d: str) -> DataFrame:
    """Values against their group's 95th percentile, which is taken over counts by value and joined back."""
    e = events(spark, d)
    counts = e.where("value IS NOT NULL").groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("times"))
    p95 = counts.groupBy("event_type").agg(F.percentile("value", 0.95, F.col("times")).alias("p95"))
    return e.join(p95, "event_type").select("event_id", F.round(F.col("value") / F.nullif("p95", F.lit(0.0)), 6).alias("part_of_p95"))


@query("select s_suppkey, lag(s_suppkey) over w as above, lead(s_suppkey) over w as below from supplier window w as (partition by s_nationkey order by s_acctbal desc, s_suppkey)")
def w19_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The suppliers next above and below by balance in a nation, of equal ones by key; NULL at the ends."""
    w = Window.partitionBy("s_nationkey").orderBy(F.col("s_acctbal").desc(), "s_suppkey")
    return table(spark, d, "supplier").select("s_suppkey", F.lag("s_suppkey").over(w).alias("above"), F.lead("s_suppkey").over(w).alias("below"))


@query("""
with w as (select cast(date_trunc('week', ts) as date) as wk, event_type, value from events), k as (select distinct wk, event_type from w)
select k.wk, k.event_type, count(h.value) as n, round(quantile_cont(h.value, 0.9), 6) as p90 from k left join w h on h.event_type = k.event_type and h.wk < k.wk group by all
""")
def w20_expanding_quantile(spark: SparkSession, d: str) -> DataFrame:
    """The 90th percentile of all weeks before, by week: few weeks, so rows are handed to each later one."""
    w = events(spark, d).select(F.to_date(F.date_trunc("week", "ts")).alias("wk"), "event_type", "value")
    k = w.select("wk", "event_type").distinct()
    h = w.withColumnsRenamed({"wk": "h_wk"})
    return k.join(h, (k["event_type"] == h["event_type"]) & (h["h_wk"] < k["wk"]), "left").groupBy(k["wk"], k["event_type"]).agg(F.count("value").alias("n"), F.round(F.percentile("value", 0.9), 6).alias("p90"))


@query("""
select event_id, first_value(event_type) over w as first_type, count(*) over (partition by user_id, event_type order by ts, event_id) as so_far, coalesce(event_type <> lag(event_type) over w, false) as changed
from events window w as (partition by user_id order by ts, event_id)
""")
def w21_tenure(spark: SparkSession, d: str) -> DataFrame:
    """Of each event: the type of the user's first one, how many so far were of its own type, and whether the last was of another."""
    w = user()
    own = Window.partitionBy("user_id", "event_type").orderBy(*ORDER)
    return events(spark, d).select("event_id", F.first("event_type").over(w).alias("first_type"), F.count(F.lit(1)).over(own).alias("so_far"), F.coalesce(F.col("event_type") != F.lag("event_type").over(w), F.lit(False)).alias("changed"))


@query("""
select o_orderkey, cast(o_orderdate as date) + cast(((5 - isodow(o_orderdate) + 6) % 7) + 1 as integer) as next_friday,
  date_diff('day', date '1970-01-01', cast(o_orderdate as date)) / 365.25::double as age, epoch_us(o_orderdate - interval 4 hours) as cutoff
from orders
""")
def d05_dates(spark: SparkSession, d: str) -> DataFrame:
    """The next Friday strictly after a date, an age in years, and a cutoff four hours before."""
    day = F.to_date("o_orderdate")
    cutoff = S.micros(F.col("o_orderdate") - F.expr("INTERVAL 4 HOURS"))
    return table(spark, d, "orders").select("o_orderkey", S.next_weekday(day, "Fri").alias("next_friday"), S.age(F.lit("1970-01-01").cast("date"), day).alias("age"), cutoff.alias("cutoff"))


@query("select year(o_orderdate) as season, cast(min(o_orderdate) - interval 7 days as date) as opens, cast(min(o_orderdate) as date) as first, count(distinct date_trunc('week', o_orderdate)) as weeks from orders group by season")
def d09_season_starts(spark: SparkSession, d: str) -> DataFrame:
    """First date, opening a week earlier, and weeks of each year."""
    first = F.to_date(F.min("o_orderdate"))
    weeks = F.count_distinct(F.date_trunc("week", "o_orderdate"))
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").cast("long").alias("season")).agg(F.date_sub(first, 7).alias("opens"), first.alias("first"), weeks.alias("weeks"))


@query("select cast(ts as date) as day, event_type, count(*) as n from events group by all")
def t06_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Events by day and type."""
    w = events(spark, d).groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.to_date("window.start").alias("day"), "event_type", "n")


@query("select (epoch_us(ts) // 21600000000 - k) * 21600000000 as start_us, count(*) as n from events cross join (values (0), (1), (2), (3)) t(k) group by start_us")
def t06_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Events in windows of a day that start every six hours; an event is in four."""
    w = events(spark, d).groupBy(F.window("ts", "1 day", "6 hours")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(S.micros(F.col("window.start").cast("timestamp_ntz")).alias("start_us"), "n")


@query("""
with g as (select user_id, ts, case when epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts, event_id)) < 7200000000 then 0 else 1 end as fresh, event_id from events),
s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts, event_id) as k from g)
select user_id, epoch_us(min(ts)) as start_us, count(*) as n from s group by user_id, k
""")
def t06_session(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user without two hours between them, by session."""
    w = events(spark, d).groupBy("user_id", F.session_window("ts", "2 hours")).agg(F.count(F.lit(1)).alias("n"))
    return w.select("user_id", S.micros(F.col("session_window.start").cast("timestamp_ntz")).alias("start_us"), "n")
