"""Ids and names, nested data, scores, status rules, evaluation and assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators import aggregates, windows
from tidemark.plans.registry import query
from tidemark.sources.tables import table


def money(c: str):
    """Exact sums of a money column, as decimals."""
    return F.sum(F.col(c).cast("decimal(18,2)"))


@query("""
select c_custkey, case when c_custkey % 7 = 0 then null else cast(c_custkey as varchar) end as id,
  lower(replace(replace(c_name, '#', ' '), '-', ' ')) as k, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') as letters, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') as slug,
  coalesce(try_cast(substr(c_name, 10) as double), 0.0) as num
from customer
""")
def f01_ids_and_names(spark: SparkSession, d: str) -> DataFrame:
    """Normalised ids, name keys, slugs and forgiving numbers."""
    raw = F.when(F.col("c_custkey") % 7 == 0, F.lit("nan")).otherwise(F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(".0 ")))
    return table(spark, d, "customer").select(
        "c_custkey", S.norm_id(raw).alias("id"), S.name_key(F.concat(F.translate("c_name", "#", " "), F.lit(" Jr."))).alias("k"), S.letters_key(F.col("c_name")).alias("letters"),
        S.slug(F.col("c_name")).alias("slug"), S.number(F.substring("c_name", 10, 99)).alias("num"),
    )


@query("""
select p_partkey, case p_brand when 'Brand#1' then 'one' when 'Brand#2' then 'two' else coalesce(p_brand, '?') end as code,
  case when p_size > 45 then 'OUT' when p_size > 30 and p_retailprice > 1000 then 'DOUBT' when p_size > 30 then 'SIZE' end as label,
  lower(p_type) like '%steel%' as steel, coalesce(nullif(p_name, ''), nullif(p_type, '')) is not null as present
from part
""")
def p05_labels(spark: SparkSession, d: str) -> DataFrame:
    """Code maps, labels that overwrite each other, name search, presence."""
    size, price = F.col("p_size"), F.col("p_retailprice")
    label = S.first_that_holds([(size > 45, "OUT"), ((size > 30) & (price > 1000), "DOUBT"), (size > 30, "SIZE")], None)
    code = S.mapped(F.col("p_brand"), {"Brand#1": "one", "Brand#2": "two"}, F.coalesce("p_brand", F.lit("?")))
    empty = lambda c: F.nullif(c, F.lit(""))
    return table(spark, d, "part").select("p_partkey", code.alias("code"), label.alias("label"), F.col("p_type").ilike("%steel%").alias("steel"), F.coalesce(empty("p_name"), empty("p_type")).isNotNull().alias("present"))


@query("select url, regexp_replace(url || '?key=abc&x=1', '(?i)((?:api_?)?key=)[^&\\s]+', '\\1***', 'g') as clean, sha256(coalesce(cast(page_id as varchar), chr(0)) || chr(1) || coalesce(url, chr(0))) as print from pages")
def f08_scrub(spark: SparkSession, d: str) -> DataFrame:
    """Masked keys and row fingerprints."""
    return table(spark, d, "pages").select("url", S.scrubbed(F.concat("url", F.lit("?key=abc&x=1"))).alias("clean"), S.fingerprint(F.col("page_id"), F.col("url")).alias("print"))


@query("select event_type, cast(json_extract(props, '$.k') as bigint) % 10 as k, count(*) as n from events group by all")
def n01_json(spark: SparkSession, d: str) -> DataFrame:
    """Events by type and last digit of a payload's number; payloads without it count under NULL."""
    k = F.from_json("props", T.StructType([T.StructField("k", T.LongType())]))["k"]
    return table(spark, d, "events").groupBy("event_type", (k % 10).alias("k")).agg(F.count(F.lit(1)).alias("n"))


#: Ids in a nested row: a roster, or a map of points, never holds more however large the table is.
BLOCK = 256


def _rosters(spark: SparkSession, d: str) -> DataFrame:
    """Nested rows by nation and block of ids: its customers, and which start."""
    rows = F.array_sort(F.collect_list(F.struct("c_custkey", "c_mktsegment", "c_acctbal")))
    starters = F.array_sort(F.collect_list(F.when(F.col("c_acctbal") > 5000, F.col("c_custkey"))))
    return table(spark, d, "customer").groupBy("c_nationkey", F.floor(F.col("c_custkey") / BLOCK).alias("block")).agg(rows.alias("players"), starters.alias("starters"))


@query("select c_nationkey, c_custkey, c_mktsegment, c_acctbal > 5000 as starts from customer")
def n03_explode_flags(spark: SparkSession, d: str) -> DataFrame:
    """Nested rosters as rows with a flag."""
    rows = _rosters(spark, d).select("c_nationkey", "starters", F.explode("players").alias("p"))
    return rows.select("c_nationkey", "p.c_custkey", "p.c_mktsegment", F.array_contains("starters", F.col("p.c_custkey")).alias("starts"))


@query("""
with s as (select c_nationkey, c_custkey, row_number() over (partition by c_nationkey order by c_custkey) as i from customer where c_acctbal > 5000)
select c_nationkey, c_custkey, case i when 1 then 'QB' when 2 then 'RB' when 3 then 'WR' end as slot from s where i <= 3
""")
def n04_zip(spark: SparkSession, d: str) -> DataFrame:
    """Starters zipped with slots by place: the first three of each block, then of the nation, so no array grows with the table."""
    slots = F.array(*[F.lit(x) for x in ("QB", "RB", "WR")])
    firsts = _rosters(spark, d).select("c_nationkey", F.explode(F.slice("starters", 1, 3)).alias("c"))
    place = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c"))
    lineups = firsts.withColumn("i", place).where("i <= 3").groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c")).alias("s"))
    pairs = lineups.select("c_nationkey", F.explode(F.arrays_zip(F.col("s").alias("c"), F.slice(slots, F.lit(1), F.size("s")).alias("slot"))).alias("z"))
    return pairs.select("c_nationkey", F.col("z.c").alias("c_custkey"), "z.slot")


@query("select o_custkey, c_acctbal as points from (select distinct o_custkey from orders) join customer on c_custkey = o_custkey where c_acctbal > 0")
def n05_map_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Points of ordering customers from maps by id, which hold those with a positive balance; ids they lack are left out."""
    block = lambda c: F.floor(F.col(c) / BLOCK).alias("block")
    maps = table(spark, d, "customer").where("c_acctbal > 0").groupBy(block("c_custkey")).agg(F.map_from_entries(F.collect_list(F.struct("c_custkey", "c_acctbal"))).alias("m"))
    ids = table(spark, d, "orders").select("o_custkey").distinct().withColumn("block", block("o_custkey"))
    return ids.join(maps, "block").select("o_custkey", F.try_element_at("m", F.col("o_custkey")).alias("points")).where("points IS NOT NULL")


@query("select conv_id, turn, role, unnest(string_split(role || ';' || turn, ';')) as part from conversations")
def n08_split(spark: SparkSession, d: str) -> DataFrame:
    """One row for each part of a delimited list, in no order; empty parts stay."""
    return table(spark, d, "conversations").select("conv_id", "turn", "role", F.explode(F.split(F.concat_ws(";", "role", F.col("turn").cast("string")), ";")).alias("part"))


_SCORE = "l_orderkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) * 0.1 + cast(sum(cast(l_extendedprice as decimal(18,2))) as double) * 0.01 + count(*) filter (l_returnflag = 'R') * -2.0"


@query(f"select {_SCORE} as score from lineitem group by l_orderkey")
def m05_linear_score(spark: SparkSession, d: str) -> DataFrame:
    """A configured linear score of a stat line."""
    stats = table(spark, d, "lineitem").groupBy("l_orderkey").agg(money("l_quantity").cast("double").alias("qty"), money("l_extendedprice").cast("double").alias("price"), F.count_if(F.col("l_returnflag") == "R").cast("double").alias("back"))
    return stats.select("l_orderkey", S.linear_score({"qty": 0.1, "price": 0.01, "back": -2.0}).alias("score"))


@query("select c_custkey, case when c_mktsegment = 'BUILDING' and c_acctbal > 4000 then 4000.0 else c_acctbal end as capped, list_sort([c_acctbal, 100.0, 3000.0])[2] as middle, not (c_acctbal <= 100 and 100 <= 3000) as crossed from customer")
def m11_cap(spark: SparkSession, d: str) -> DataFrame:
    """Capped scores, and quantiles put in order."""
    cap = F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 4000), F.lit(4000.0)).otherwise(F.col("c_acctbal"))
    ordered, crossed = S.sorted_quantiles(F.col("c_acctbal"), F.lit(100.0), F.lit(3000.0))
    return table(spark, d, "customer").select("c_custkey", cap.alias("capped"), F.get(ordered, F.lit(1)).alias("middle"), crossed.alias("crossed"))


@query("""
with y as (select l_suppkey, year(l_shipdate) as s, cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(*) as m from lineitem where year(l_shipdate) in (1996, 1997) group by all),
b as (select coalesce(c.l_suppkey, p.l_suppkey) as l_suppkey, case when c.m is not null and p.m is not null then 0.5 * p.m + 0.5 * c.m else coalesce(c.m, p.m) end as base from (select * from y where s = 1997) c full join (select * from y where s = 1996) p on c.l_suppkey = p.l_suppkey)
select l_suppkey, base, rank() over (order by base desc) as place from b
""")
def r07_baselines(spark: SparkSession, d: str) -> DataFrame:
    """Blended seasons and their rank."""
    rows = table(spark, d, "lineitem").where(F.year("l_shipdate").isin(1996, 1997))
    mean = lambda y: F.sum(F.when(F.year("l_shipdate") == y, F.col("l_quantity").cast("decimal(18,2)"))).cast("double") / F.nullif(F.count_if(F.year("l_shipdate") == y), F.lit(0))
    base = rows.groupBy("l_suppkey").agg(mean(1997).alias("c"), mean(1996).alias("p")).select("l_suppkey", S.blended(F.col("c"), F.col("p"), S.prior_weight(F.lit(2))).alias("base"))
    return windows.rank_of_all(base, "base", "place")


@query("""
with c as (select c_custkey, c_mktsegment, count(o_orderkey) as n, coalesce(cast(sum(cast(o_totalprice as decimal(18,2))) as double), 0.0) as t from customer left join orders on o_custkey = c_custkey group by all),
g as (select c_mktsegment, sum(t) as st, sum(n) as sn from c group by 1)
select c_custkey, round((t + 5 * (g.st / g.sn)) / (n + 5), 6) as expected, case when n = 0 then 'NO BASELINE' when (t + 5 * (g.st / g.sn)) / (n + 5) > g.st / g.sn then 'UP' else 'DOWN' end as call from c join g on c.c_mktsegment = g.c_mktsegment
""")
def r10_expected_value(spark: SparkSession, d: str) -> DataFrame:
    """A star of baselines and group priors, shrunk, with a label."""
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), money("o_totalprice").cast("double").alias("t"))
    c = table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("t", F.lit(0.0)).alias("t"))
    prior = c.groupBy("c_mktsegment").agg((F.sum("t") / F.sum("n")).alias("prior"))
    x = c.join(prior, "c_mktsegment").withColumn("e", S.shrunk(F.col("t"), F.col("n"), F.col("prior"), 5))
    call = S.first_that_holds([(F.col("n") == 0, "NO BASELINE"), (F.col("e") > F.col("prior"), "UP")], "DOWN")
    return x.select("c_custkey", F.round("e", 6).alias("expected"), call.alias("call"))


@query("""
select a.s_suppkey, string_agg(b.s_name || ' (' || case when b.s_acctbal < 0 then 'out' else 'ok' end || ')', '; ' order by b.s_acctbal desc, b.s_suppkey) as blockers,
  count(b.s_suppkey) as n_ahead, coalesce(bool_and(b.s_acctbal >= 0), true) as all_ok from supplier a left join supplier b on a.s_nationkey = b.s_nationkey and b.s_acctbal > a.s_acctbal group by a.s_suppkey
""")
def r13_blockers(spark: SparkSession, d: str) -> DataFrame:
    """The ordered chain of all rows ahead, how many there are, and whether all of them are fit.

    A row's chain is the beginning of its nation's, so a nation's is put together once and cut where
    the rows ahead end. The result holds every chain and grows with the square of a nation's rows;
    chains are made last, and neither sorted nor shuffled. A nation's chain is about its longest result.
    """
    rows = table(spark, d, "supplier")
    nation = Window.partitionBy("s_nationkey")
    ties = Window.partitionBy("s_nationkey", "s_acctbal")
    order = nation.orderBy(F.col("s_acctbal").desc())
    ahead = lambda v: F.sum(v).over(order) - F.sum(v).over(ties)
    text = F.concat("s_name", F.when(F.col("s_acctbal") < 0, " (out)").otherwise(" (ok)"))
    placed = rows.where("s_nationkey IS NOT NULL AND s_acctbal IS NOT NULL").withColumn("t", text)
    one = F.struct((-F.col("s_acctbal")).alias("o"), F.col("s_suppkey").alias("k"), "t")
    whole = placed.groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["t"]), "; ").alias("whole"))
    cut = placed.select(
        "s_nationkey", "s_suppkey", (F.rank().over(order) - 1).cast("long").alias("n_ahead"), (ahead((F.col("s_acctbal") < 0).cast("int")) == 0).alias("all_ok"),
        (ahead(F.coalesce(F.length("t") + 2, F.lit(0))) - 2).cast("int").alias("length"),
    )
    # dealt by row, since a nation's tasks would be few; the nations' chains together are as large as the table
    out = cut.repartition(spark.sparkContext.defaultParallelism * 4, "s_suppkey").join(F.broadcast(whole), "s_nationkey")
    out = out.select("s_suppkey", F.when(F.col("length") >= 0, F.left("whole", F.col("length"))).alias("blockers"), "n_ahead", "all_ok")
    alone = rows.where("s_nationkey IS NULL OR s_acctbal IS NULL")
    return out.unionByName(alone.select("s_suppkey", F.lit(None).cast("string").alias("blockers"), F.lit(0).cast("long").alias("n_ahead"), F.lit(True).alias("all_ok")))


@query("""
with cal as (select day, row_number() over (order by day desc) as n from (select distinct cast(ts as date) as day from events)), u as (select distinct user_id from events)
select u.user_id, count(*) filter (e.user_id is null) as missed from u cross join (select day from cal where n <= 5) c left join (select distinct user_id, cast(ts as date) as day from events) e on e.user_id = u.user_id and e.day = c.day
group by u.user_id having count(*) filter (e.user_id is null) >= 2
""")
def r15_repeat_absence(spark: SparkSession, d: str) -> DataFrame:
    """Who missed at least two of the last five days on the calendar."""
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    last = e.select("day").distinct().orderBy(F.col("day").desc()).limit(5)
    n = last.agg(F.count(F.lit(1)).alias("n"))
    seen = e.join(F.broadcast(last.withColumn("recent", F.lit(True))), "day", "left").groupBy("user_id").agg(F.count_distinct(F.when(F.col("recent"), F.col("day"))).alias("seen"))
    return seen.crossJoin(F.broadcast(n)).select("user_id", (F.col("n") - F.col("seen")).alias("missed")).where("missed >= 2")


@query("select user_id, event_id, prev, event_type from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as prev from events) where prev = 'error' and event_type <> 'error'")
def r16_status_change(spark: SparkSession, d: str) -> DataFrame:
    """Rows at which a status leaves one state."""
    prev = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").withColumn("prev", prev).where("prev = 'error' AND event_type <> 'error'").select("user_id", "event_id", "prev", "event_type")


@query("""
with o as (select n_name, s_suppkey, s_acctbal from supplier join nation on s_nationkey = n_nationkey)
select n_name, count(*) as n, count(*) filter (s_acctbal >= 5000) as strong, round(avg(s_acctbal), 6) as mean, case when count(*) filter (s_acctbal >= 5000) <= 1 then 'thin' else 'deep' end as depth from o group by n_name
""")
def a25_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Owners' strong rows, means and depth."""
    o = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    strong = F.count_if(F.col("s_acctbal") >= 5000)
    return o.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), strong.alias("strong"), F.round(F.avg("s_acctbal"), 6).alias("mean"), F.when(strong <= 1, "thin").otherwise("deep").alias("depth"))


@query("""
with r as (select c_custkey, c_acctbal < 0 as debt, count(o_orderkey) = 0 as idle, count(o_orderkey) > 20 as busy from customer left join orders on o_custkey = c_custkey group by c_custkey, c_acctbal)
select c_custkey, case when debt then 'debt' when idle then 'idle' when busy then 'busy' else 'none' end as primary_reason,
  case when debt and idle then 'idle' when debt and busy then 'busy' end as secondary_reason from r
""")
def r24_classifier(spark: SparkSession, d: str) -> DataFrame:
    """Reasons in order of weight: the first is the primary one, the next the secondary."""
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_acctbal", F.coalesce("n", F.lit(0)).alias("n"))
    reasons = F.array_compact(F.array(F.when(F.col("c_acctbal") < 0, "debt"), F.when(F.col("n") == 0, "idle"), F.when(F.col("n") > 20, "busy")))
    return c.select("c_custkey", F.coalesce(F.get(reasons, F.lit(0)), F.lit("none")).alias("primary_reason"), F.get(reasons, F.lit(1)).alias("secondary_reason"))


def _predictions(spark: SparkSession, d: str) -> DataFrame:
    past, near = (windows.before(["user_id"], [F.col("ts"), F.col("event_id")], n) for n in (None, 3))
    rows = table(spark, d, "events").select("event_type", "ts", "value", F.avg("value").over(past).alias("a"), F.avg("value").over(near).alias("b"))
    return rows.where("a IS NOT NULL").withColumn("c", F.lit(50.0))


_PREDICTIONS = """p as (select * from (select event_type, ts, value, avg(value) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as a,
  avg(value) over (partition by user_id order by ts, event_id rows between 3 preceding and 1 preceding) as b from events) where a is not null)"""


@query(f"""
with {_PREDICTIONS}, s as (select sum(a * a) as aa, sum(a * b) as ab, sum(a * 50) as ac, sum(b * b) as bb, sum(b * 50) as bc, count(*) * 2500.0 as cc, sum(a * value) as ay, sum(b * value) as by_, sum(50 * value) as cy from p where value is not null and b is not null),
g as (select i / 100.0::double as a, j / 100.0::double as b, (100 - i - j) / 100.0::double as c from (select unnest(range(101)) as i) cross join (select unnest(range(101)) as j) where i + j <= 100)
select g.a, g.b, g.c from g, s where s.aa is not null order by g.a * g.a * aa + g.b * g.b * bb + g.c * g.c * cc + 2 * (g.a * g.b * ab + g.a * g.c * ac + g.b * g.c * bc) - 2 * (g.a * ay + g.b * by_ + g.c * cy), g.a, g.b limit 1
""")
def y04_simplex(spark: SparkSession, d: str) -> DataFrame:
    """Ensemble weights of three predictors on a grid of hundredths, from one aggregate of their products."""
    w = aggregates.simplex_weights(_predictions(spark, d), ["a", "b", "c"], "value")
    return spark.createDataFrame([tuple(w)], "a double, b double, c double")


@query(f"""
with {_PREDICTIONS}, k as (select cast(cast(ts as date) as varchar) as block, count(*) as n, sum((value - b) * (value - b) - (value - a) * (value - a)) as diff from p group by 1),
r as (select n, diff, row_number() over (order by block) - 1 as at_, count(*) over () as of_ from k),
e as (select draw, cast('0x' || substr(md5('7-' || draw || '-' || at_), 1, 8) as bigint) % of_ as at_ from r cross join (select unnest(range(2000)) as draw)),
m as (select draw, sum(diff) / sum(n) as mean from e join r using (at_) group by draw)
select (select round(sum(diff) / sum(n), 6) from r) as mean, round(quantile_cont(mean, 0.025), 6) as low, round(quantile_cont(mean, 0.975), 6) as high from m
""")
def a21_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """The interval of the difference in squared error of two predictors, whole days redrawn."""
    diff = (F.col("value") - F.col("b")) ** 2 - (F.col("value") - F.col("a")) ** 2
    days = _predictions(spark, d).groupBy(F.to_date("ts").cast("string").alias("block")).agg(F.count(F.lit(1)).alias("n"), F.sum(diff).alias("diff"))
    got = aggregates.blocked_bootstrap(days, 2000, 7)
    return got.select(*[F.round(c, 6).alias(c) for c in ("mean", "low", "high")])


@query("""
with o as (select *, count(*) over (partition by o_custkey) as k from orders), t as (select o_custkey, o_totalprice, k from o)
select o_custkey, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total, cast(max(cast(o_totalprice as decimal(18,2))) as double) / nullif(cast(sum(cast(o_totalprice as decimal(18,2))) as double), 0) as top_share from t group by o_custkey
""")
def a26_pooled(spark: SparkSession, d: str) -> DataFrame:
    """Pooled sums and efficiency ratios."""
    cents = F.col("o_totalprice").cast("decimal(18,2)")
    total = F.sum(cents).cast("double")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), total.alias("total"), (F.max(cents).cast("double") / F.nullif(total, F.lit(0.0))).alias("top_share"))


@query("select o_orderpriority, year(o_orderdate) < 1996 as train, count(*) as n, max(year(o_orderdate) * 100 + month(o_orderdate)) as newest from orders group by all")
def p12_masks(spark: SparkSession, d: str) -> DataFrame:
    """Training and test rows by time, with the check that training looks no further."""
    stamp = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long")
    return table(spark, d, "orders").groupBy("o_orderpriority", (F.year("o_orderdate") < 1996).alias("train")).agg(F.count(F.lit(1)).alias("n"), F.max(stamp).alias("newest"))


@query("""
with e as (select event_type, cast(date_trunc('week', ts) as date) as wk, user_id as x, value as y from events where value is not null),
f as (select k.event_type, k.wk, regr_slope(h.y, h.x) as slope, regr_intercept(h.y, h.x) as intercept from (select distinct event_type, wk from e) k join e h on h.event_type = k.event_type and h.wk < k.wk group by all)
select e.event_type, e.wk, count(*) as n, round(avg(abs(e.y - (f.intercept + f.slope * e.x))), 6) as mae from e join f on e.event_type = f.event_type and e.wk = f.wk group by all
""")
def y01_walk_forward(spark: SparkSession, d: str) -> DataFrame:
    """Weekly predictions of a linear model fitted on all earlier weeks.

    A fit needs five sums, so weeks are reduced to those first, and running sums of weeks give every
    refit in one pass; no week is trained on twice.
    """
    wk = F.to_date(F.date_trunc("week", "ts"))
    e = table(spark, d, "events").where("value IS NOT NULL").select("event_type", wk.alias("wk"), F.col("user_id").cast("double").alias("x"), F.col("value").alias("y"))
    x, y = F.col("x"), F.col("y")
    weekly = e.groupBy("event_type", "wk").agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"))
    past = windows.before(["event_type"], [F.col("wk")])
    so_far = weekly.select("event_type", "wk", *[F.sum(c).over(past).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")]).where("n > 0")
    slope = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.nullif(F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n"), F.lit(0.0))
    fits = so_far.select("event_type", "wk", slope.alias("slope"), ((F.col("sy") - slope * F.col("sx")) / F.col("n")).alias("intercept"))
    scored = e.join(fits, ["event_type", "wk"])
    return scored.groupBy("event_type", "wk").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(y - (F.col("intercept") + F.col("slope") * x))), 6).alias("mae"))


@query("""
with h as (select event_type, cast(date_trunc('week', ts) as date) as wk, value - 50 as r from events where value is not null), k as (select distinct event_type, wk from h)
select k.event_type, k.wk, round(50 + quantile_cont(h.r, 0.1), 6) as low, round(50 + quantile_cont(h.r, 0.9), 6) as high from k join h on h.event_type = k.event_type and h.wk < k.wk group by all having count(*) >= 30
""")
def y05_recalibrated(spark: SparkSession, d: str) -> DataFrame:
    """Bands recalibrated each week on the residuals of all weeks before, where there are at least 30."""
    h = table(spark, d, "events").where("value IS NOT NULL").select("event_type", F.to_date(F.date_trunc("week", "ts")).alias("h_wk"), (F.col("value") - 50).alias("r"))
    k = h.select(F.col("event_type").alias("t"), F.col("h_wk").alias("wk")).distinct()
    pairs = h.join(F.broadcast(k), (F.col("event_type") == F.col("t")) & (F.col("h_wk") < F.col("wk")))
    q = lambda p: F.round(50 + F.percentile("r", p), 6)
    return pairs.groupBy("event_type", "wk").agg(q(0.1).alias("low"), q(0.9).alias("high"), F.count(F.lit(1)).alias("n")).where("n >= 30").drop("n")


@query("""
select col, round(corr(v, y), 6) as rho, count(*) as n from (
  select 'l_quantity' as col, l_quantity as v, l_extendedprice as y from lineitem union all select 'l_discount', l_discount, l_extendedprice from lineitem union all select 'l_tax', l_tax, l_extendedprice from lineitem) group by col
""")
def y09_screen(spark: SparkSession, d: str) -> DataFrame:
    """All candidate columns against the target in one aggregate, then one row a column."""
    names = ["l_quantity", "l_discount", "l_tax"]
    one = table(spark, d, "lineitem").agg(*[F.struct(F.lit(c).alias("col"), F.round(F.corr(c, "l_extendedprice"), 6).alias("rho"), F.count(c).alias("n")).alias(c) for c in names])
    return one.select(F.explode(F.array(*names)).alias("s")).select("s.*")


@query("select event_id from (select event_id, event_type, row_number() over (partition by event_type order by (event_id * 7919) % 10007, event_id) as n from events) where n <= 10")
def y13_sample(spark: SparkSession, d: str) -> DataFrame:
    """A sampler: ten rows of each type by a fixed hash, the same on every run."""
    order = [(F.col("event_id") * 7919) % 10007, F.col("event_id")]
    return windows.last_n(table(spark, d, "events"), ["event_type"], order, 10).select("event_id")


@query("""
with p as (select p_partkey, lower(p_name) as k, p_brand, count(*) over (partition by lower(p_name)) as same_name, count(*) over (partition by lower(p_name), p_brand) as same_both from part)
select p_partkey, case when same_name = 1 then 'name' when same_both = 1 then 'name and brand' else 'ambiguous' end as tier from p
""")
def j14_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Entity resolution by tiers; what stays ambiguous is said so, not guessed."""
    key = F.lower("p_name")
    alone = lambda *keys: F.count(F.lit(1)).over(Window.partitionBy(*keys)) == 1
    return table(spark, d, "part").select("p_partkey", S.first_that_holds([(alone(key), "name"), (alone(key, "p_brand"), "name and brand")], "ambiguous").alias("tier"))


@query("""
select s.s_suppkey, coalesce(cast(c.c_custkey as varchar), 'new-' || s.s_suppkey) as id from supplier s left join customer c on c.c_custkey = s.s_suppkey and c.c_nationkey = s.s_nationkey
""")
def j24_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """A crosswalk with made-up ids for rows it lacks."""
    s, c = table(spark, d, "supplier"), table(spark, d, "customer")
    out = s.join(c, (F.col("c_custkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")), "left")
    return out.select("s_suppkey", F.coalesce(F.col("c_custkey").cast("string"), F.concat(F.lit("new-"), F.col("s_suppkey").cast("string"))).alias("id"))


@query("""
with r as (select s_nationkey, s_suppkey, s_acctbal, row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) as place from supplier)
select a.s_suppkey, b.s_suppkey as backup from r a left join r b on a.s_nationkey = b.s_nationkey and b.place = case when a.place % 2 = 1 then a.place + 1 else a.place - 1 end
""")
def j25_complement(spark: SparkSession, d: str) -> DataFrame:
    """Each row's complement in rank (first with second, third with fourth): a neighbour, so no join."""
    w = Window.partitionBy("s_nationkey").orderBy(F.col("s_acctbal").desc(), "s_suppkey")
    backup = F.when(F.row_number().over(w) % 2 == 1, F.lead("s_suppkey").over(w)).otherwise(F.lag("s_suppkey").over(w))
    return table(spark, d, "supplier").select("s_suppkey", backup.alias("backup"))


@query("""
select o_orderkey, case when o_orderstatus = 'P' then null when l.n is null then 0.0 else l.qty end as y from orders
left join (select l_orderkey, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as double) as qty from lineitem group by 1) l on l_orderkey = o_orderkey
""")
def j27_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels that tell absent rows (zero) from rows that didn't count (NULL)."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(money("l_quantity").cast("double").alias("qty"))
    out = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return out.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.coalesce("qty", F.lit(0.0))).alias("y"))


@query("""
with t as (select event_type, avg(value) as m, stddev_samp(value) as s, count(*) as n from events group by 1)
select event_type, round(m, 6) as mean, round(s / sqrt(n), 6) as se, round((m - 50) / (s / sqrt(n)), 6) as t from t
""")
def y10_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Means, standard errors and t against a fixed value, from one aggregate."""
    se = F.stddev_samp("value") / F.sqrt(F.count("value"))
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(se, 6).alias("se"), F.round((F.avg("value") - 50) / se, 6).alias("t"))
