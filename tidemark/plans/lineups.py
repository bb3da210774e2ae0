"""Line-ups of suppliers by nation: exact assignment, calls between two line-ups, and records whose slots lock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import lineups
from tidemark.plans.registry import query
from tidemark.sources.tables import table

FOUR = {"first": ["A"], "second": ["B"], "third": ["C"], "flex": ["A", "B", "C"]}
THREE = {"first": ["A"], "second": ["B", "C"], "flex": ["A", "B", "C"]}
#: The instants of the record's runs; a supplier starts with its first line of 50 pieces.
RUNS = ("1995-03-01", "1995-06-01", "1995-10-01")

_POOL = """select s_nationkey as g, s_suppkey as id, ['A', 'B', 'C'][s_suppkey % 3 + 1] as kind, cast(round(s_acctbal * 100) as bigint) as score from supplier"""


def _options(name: str, pool: str, kinds: str, score: str = "score") -> str:
    """SQL: the candidates of a slot and the empty choice, as (g, id, score)."""
    return f"{name} as (select g, id, {score} as score from {pool} where kind in ({kinds}) and {score} is not null union all select distinct g, null, 0 from {pool})"


def _best(slots: list[str], name: str) -> str:
    """SQL: the best choice of one option for each slot: most slots, largest total, smallest ids in order."""
    n = range(len(slots))
    apart = " and ".join(f"({a}.id is null or {b}.id is null or {a}.id <> {b}.id)" for i, a in enumerate(slots) for b in slots[:i])
    joins = " ".join(f"join {b} on {b}.g = {slots[0]}.g" for b in slots[1:])
    filled, total = (" + ".join(f"{part.format(s)}" for s in slots) for part in ("(case when {0}.id is null then 0 else 1 end)", "{0}.score"))
    order = ", ".join(f"coalesce(-{s}.id, -4611686018427387904) desc" for s in slots)
    return f"{name} as (select {slots[0]}.g, {', '.join(f'{s}.id as p{i}' for i, s in zip(n, slots, strict=True))}, row_number() over (partition by {slots[0]}.g order by {filled} desc, {total} desc, {order}) as rn from {slots[0]} {joins} where {apart} qualify rn = 1)"


def _pool(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").cast("long").alias("id"), kind.alias("kind"), F.round(F.col("s_acctbal") * 100).cast("long").alias("score"))


@query(f"""
with pool as ({_POOL}), {_options("o0", "pool", "'A'")}, {_options("o1", "pool", "'B'")}, {_options("o2", "pool", "'C'")}, {_options("o3", "pool", "'A', 'B', 'C'")},
{_best(["o0", "o1", "o2", "o3"], "best")}, long as (select g, 'first' as slot, p0 as id from best union all select g, 'second', p1 from best union all select g, 'third', p2 from best union all select g, 'flex', p3 from best)
select l.g as nationkey, l.slot, l.id as suppkey, p.score from long l join pool p on p.id = l.id
""")
def b01_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Each supplier nation's best line-up of four slots, a row for each filled one; slots take kinds by key, scores are cents."""
    return lineups.assigned(_pool(spark, d), "g", FOUR).select(F.col("g").alias("nationkey"), "slot", F.col("id").alias("suppkey"), "score")


_ESTIMATES = f"""
lines as (select l_suppkey, count(*) as volume, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) // count(*) // 4 as model, 2 * sum(case when l_returnflag = 'R' then 1 else 0 end) >= count(*) as doubtful from lineitem group by 1),
pool as (select p.g, p.id, p.kind, p.score as own, l.model, l.volume, coalesce(l.doubtful, false) as doubtful from ({_POOL}) p left join lines l on l.l_suppkey = p.id)"""


def _estimates(spark: SparkSession, d: str) -> DataFrame:
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("long"))
    lines = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("volume"), cents.alias("cents"), (2 * F.count_if(F.col("l_returnflag") == "R") >= F.count(F.lit(1))).alias("doubtful"))
    rows = _pool(spark, d).join(lines, F.col("id") == F.col("l_suppkey"), "left")
    return rows.select("g", "id", "kind", F.col("score").alias("own"), F.expr("cents div volume div 4").alias("model"), "volume", "doubtful")


@query(f"""
with {_ESTIMATES},
{_options("a0", "pool", "'A'", "own")}, {_options("a1", "pool", "'B', 'C'", "own")}, {_options("a2", "pool", "'A', 'B', 'C'", "own")}, {_best(["a0", "a1", "a2"], "own")},
{_options("m0", "pool", "'A'", "model")}, {_options("m1", "pool", "'B', 'C'", "model")}, {_options("m2", "pool", "'A', 'B', 'C'", "model")}, {_best(["m0", "m1", "m2"], "model")},
long as (select o.g, unnest(['first', 'second', 'flex']) as slot, unnest([o.p0, o.p1, o.p2]) as own_id, unnest([m.p0, m.p1, m.p2]) as model_id from own o join model m on m.g = o.g)
select g as nationkey, slot, own_id, model_id, coalesce(own_id <> model_id, (own_id is null) <> (model_id is null)) as differs from long
""")
def b02_two_lineups(spark: SparkSession, d: str) -> DataFrame:
    """Each nation's line-ups by balance and by price of lines, side by side: a row for each slot."""
    return lineups.called(_estimates(spark, d), "g", THREE).select(F.col("g").alias("nationkey"), "slot", "own_id", "model_id", (~F.col("own_id").eqNullSafe(F.col("model_id"))).alias("differs"))


@query()
def b02_calls(spark: SparkSession, d: str) -> DataFrame:
    """The call between each nation's two line-ups, with the rule that decided each slot in which they differ."""
    return lineups.called(_estimates(spark, d), "g", THREE).withColumnRenamed("g", "nationkey")


_STARTS = """starts as (select l_suppkey, min(cast(l_shipdate as timestamp)) as starts from lineitem where l_quantity = 50 group by 1)"""


def _run_sql(i: int, now: str) -> str:
    """SQL of one run: kept slots of the run before, options of the others, the best choice, and the record."""
    before = f"r{i - 1}"
    score = f"pool{i} as (select p.g, p.id, p.kind, p.score + coalesce(q.q, 0) as score, s.starts from ({_POOL}) p left join (select l_suppkey, cast(sum(l_quantity) as bigint) * 1000 as q from lineitem where l_shipdate < timestamp '{now}' group by 1) q on q.l_suppkey = p.id left join starts s on s.l_suppkey = p.id)"
    parts = [score]
    kinds = ["'A'", "'B', 'C'", "'A', 'B', 'C'"]
    if i:
        parts.append(f"kept{i} as (select * from {before} where starts <= timestamp '{now}')")
        parts.append(f"open{i} as (select * from pool{i} p where not coalesce(p.starts <= timestamp '{now}', false) and not exists (select 1 from kept{i} k where k.g = p.g and k.id = p.id))")
    for s in range(3):
        if i:
            kept = f"exists (select 1 from kept{i} k where k.g = x.g and k.slot_no = {s})"
            parts.append(f"q{i}{s} as (select g, id, score from open{i} x where kind in ({kinds[s]}) and not {kept} union all select distinct g, null, 0 from pool{i} x where not {kept} union all select g, id, 0 from kept{i} where slot_no = {s})")
        else:
            parts.append(_options(f"q{i}{s}", f"pool{i}", kinds[s]))
    parts.append(_best([f"q{i}{s}" for s in range(3)], f"best{i}"))
    parts.append(f"l{i} as (select g, unnest(['first', 'second', 'flex']) as slot, unnest([0, 1, 2]) as slot_no, unnest([p0, p1, p2]) as id from best{i})")
    old = f"k.recorded_at, timestamp '{now}'" if i else f"timestamp '{now}'"
    join = f"left join kept{i} k on k.g = l.g and k.slot_no = l.slot_no" if i else ""
    parts.append(f"r{i} as (select l.g, l.slot, l.slot_no, l.id, p.starts, coalesce({old}) as recorded_at, coalesce(p.starts <= timestamp '{now}', false) as locked from l{i} l join pool{i} p on p.id = l.id {join})")
    return ", ".join(parts)


@query(f"""
with {_STARTS}, {", ".join(_run_sql(i, now) for i, now in enumerate(RUNS))}
select g as nationkey, slot, slot_no, id as suppkey, starts, recorded_at, locked from r2
""")
def k12_locked_record(spark: SparkSession, d: str) -> DataFrame:
    """The record of each nation's line-up after three runs; between runs scores grow by what was shipped, and slots lock."""
    lines = table(spark, d, "lineitem")
    starts = lines.where("l_quantity = 50").groupBy(F.col("l_suppkey").alias("_s")).agg(F.min(F.col("l_shipdate").cast("timestamp")).alias("starts"))
    record = None
    for now in RUNS:
        at = F.lit(now).cast("timestamp")
        shipped = lines.where(F.col("l_shipdate") < at).groupBy(F.col("l_suppkey").alias("_q")).agg((F.sum("l_quantity").cast("long") * 1000).alias("q"))
        rows = _pool(spark, d).join(shipped, F.col("id") == F.col("_q"), "left").join(starts, F.col("id") == F.col("_s"), "left")
        record = lineups.recorded(rows.select("g", "id", "kind", (F.col("score") + F.coalesce("q", F.lit(0))).alias("score"), "starts"), record, "g", THREE, at)
    return record.select(F.col("g").alias("nationkey"), "slot", "slot_no", F.col("id").alias("suppkey"), "starts", "recorded_at", "locked")


_SEASONS = """
q as (select l_suppkey as id, year(l_shipdate) as season, cast(sum(l_quantity) as bigint) as points from lineitem group by all),
pool as (select p.g * 10000 + a.season as g, p.id, p.kind, b.points as expected, a.points as actual from (select s_nationkey as g, s_suppkey as id, ['A', 'B', 'C'][s_suppkey % 3 + 1] as kind from supplier) p join q a on a.id = p.id left join q b on b.id = a.id and b.season = a.season - 1)"""


@query(f"""
with {_SEASONS}, {_options("e0", "pool", "'A'", "expected")}, {_options("e1", "pool", "'B', 'C'", "expected")}, {_options("e2", "pool", "'A', 'B', 'C'", "expected")}, {_best(["e0", "e1", "e2"], "own")},
{_options("f0", "pool", "'A'", "actual")}, {_options("f1", "pool", "'B', 'C'", "actual")}, {_options("f2", "pool", "'A', 'B', 'C'", "actual")}, {_best(["f0", "f1", "f2"], "perfect")},
long as (select g, 'own' as side, unnest([p0, p1, p2]) as id from own union all select g, 'perfect', unnest([p0, p1, p2]) from perfect),
s as (select l.g, count(p.id) filter (side = 'own') as own_slots, count(p.id) filter (side = 'perfect') as perfect_slots, coalesce(sum(p.actual) filter (side = 'own'), 0) as own_points, coalesce(sum(p.actual) filter (side = 'perfect'), 0) as perfect_points from long l left join pool p on p.g = l.g and p.id = l.id group by l.g)
select g // 10000 as nationkey, g % 10000 as season, own_slots, perfect_slots, own_points, perfect_points, case when 5 * own_slots >= 4 * perfect_slots then round(own_points / nullif(perfect_points, 0), 6) end as efficiency from s
""")
def r26_perfect_lineups(spark: SparkSession, d: str) -> DataFrame:
    """What each nation's line-up by the season before was worth, against the perfect one of the season.

    efficiency is NULL where the line-up fills fewer than four of five of the perfect one's slots.
    """
    points = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id"), F.year("l_shipdate").alias("season")).agg(F.sum("l_quantity").cast("long").alias("points"))
    before = points.select("id", (F.col("season") + 1).alias("season"), F.col("points").alias("expected"))
    seasons = points.withColumnRenamed("points", "actual").join(before, ["id", "season"], "left")
    pool = _pool(spark, d).drop("score").join(seasons, "id").withColumn("g", (F.col("g") * 10_000 + F.col("season")).cast("long"))
    out = None
    for side, by in (("own", "expected"), ("perfect", "actual")):
        picks = lineups.assigned(pool.select("g", "id", "kind", F.col(by).alias("score")), "g", THREE).select("g", "id")
        worth = picks.join(pool.select("g", "id", "actual"), ["g", "id"]).groupBy("g").agg(F.count("id").alias(f"{side}_slots"), F.sum("actual").alias(f"{side}_points"))
        out = worth if out is None else worth.join(out, "g", "left")
    zero = {f"own_{c}": F.coalesce(f"own_{c}", F.lit(0)) for c in ("slots", "points")}
    share = F.round(F.col("own_points") / F.nullif("perfect_points", F.lit(0)), 6)
    return out.withColumns(zero).select(
        F.floor(F.col("g") / 10_000).alias("nationkey"), (F.col("g") % 10_000).alias("season"), "own_slots", "perfect_slots", "own_points", "perfect_points",
        F.when(5 * F.col("own_slots") >= 4 * F.col("perfect_slots"), share).alias("efficiency"),
    )
