"""Walk-forward models of line prices by year: boosted trees, quantile trees, nested stages, and a seeded search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import candidates
from tidemark.operators import trees, walkforward
from tidemark.plans import matrix
from tidemark.plans.registry import query
from tidemark.sources.tables import table

#: Years whose start is a refit; years after the last are served by it.
FITS = [1996, 1998, 2000]
DEPTH = 2
FEATURES = {"l_quantity": [10.0, 20.0, 30.0, 40.0], "l_discount": [0.02, 0.05, 0.08], "l_tax": [0.03, 0.06], "weekday": [2.0, 4.0, 6.0]}


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines with their year, fixed bins of four features, and the price in cents as y."""
    year = F.year("l_shipdate").alias("year")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", year, "l_quantity", "l_discount", "l_tax", F.dayofweek("l_shipdate").alias("weekday"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("y"))
    return rows.withColumn("bins", trees.binned(FEATURES))


def _sql_bin(name: str, cuts: list[float]) -> str:
    return "1 + " + " + ".join(f"cast({name} > {c} as int)" for c in cuts)


@query(f"""
with x as (select year(l_shipdate) as year, cast(round(l_extendedprice * 100) as bigint) as y, l_quantity, l_discount, l_tax, dayofweek(l_shipdate) + 1 as weekday from lineitem),
b as (select f.fit, pow(0.5, f.fit - 1 - x.year) as w, x.y, x.l_quantity, x.l_discount, x.l_tax, x.weekday from x join (select unnest({FITS}) as fit) f on x.year < f.fit),
e as ({" union all ".join(f"select fit, w, y, {i} as feature, {_sql_bin(n, c)} as bin from b" for i, (n, c) in enumerate(FEATURES.items()))}),
h as (select fit, feature, bin, sum(w) as w, sum(w * y) as g from e group by all),
s as (select fit, feature, bin, sum(w) over so_far as lw, sum(g) over so_far as lg, sum(w) over t as tw, sum(g) over t as tg from h window so_far as (partition by fit, feature order by bin), t as (partition by fit, feature)),
c as (select fit, feature, bin, cast(lg * lg / lw + (tg - lg) * (tg - lg) / (tw - lw) - tg * tg / tw as real) as gain from s where lw >= 1 and tw - lw >= 1)
select fit, feature, bin, round(ln(gain), 4) as log_gain from (select *, row_number() over (partition by fit order by gain desc, feature, bin) as p from c where gain > 0) where p = 1
""")
def y01_tree_level(spark: SparkSession, d: str) -> DataFrame:
    """The first cut of every refit's first tree, by one histogram over all refits; recency halves a row's weight each year."""
    hist = trees.histogram(trees.walked(_lines(spark, d), "year", FITS, 1.0), F.lit(1), F.col("y"))
    return trees.best_splits(hist, 1.0).select("fit", "feature", "bin", F.round(F.log("gain"), 4).alias("log_gain"))


def _served(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).withColumn("fit", trees.serving(F.col("year"), FITS)).where("fit IS NOT NULL")


@query()
def y01_boosted_trees(spark: SparkSession, d: str) -> DataFrame:
    """Trees refitted every two years on earlier years alone: rows served, error, and that of the refit's first guess."""
    model = trees.boosted(trees.walked(_lines(spark, d), "year", FITS, 1.0), rounds=5, depth=DEPTH, rate=0.6, least=20.0)
    base = trees.Model(model.base, {f: [] for f in model.base}, 1.0)
    rows = trees.predicted_by_bins(_served(spark, d), {"by_trees": model, "prediction": base}, DEPTH)
    return rows.groupBy("fit", "year").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(F.col("y") - F.col("by_trees"))), 2).alias("mae"), F.round(F.avg(F.abs(F.col("y") - F.col("prediction"))), 2).alias("mae_first_guess"))


@query()
def y02_quantile_trees(spark: SparkSession, d: str) -> DataFrame:
    """Bands of the 10th, 50th and 90th percentile by pinball loss, sorted where they cross: coverage and loss by year."""
    lines = _lines(spark, d).groupBy("year", "bins", "y").agg(F.count(F.lit(1)).alias("n")).persist()
    taught = trees.walked(lines, "year", FITS).withColumn("w", F.col("w") * F.col("n"))
    models = {f"p{q}": trees.boosted(taught, rounds=3, depth=DEPTH, rate=1.0, least=20.0, quantile=q / 100, width=1000.0) for q in (10, 50, 90)}
    lines.unpersist()
    rows = trees.predicted_by_bins(_served(spark, d), models, DEPTH)
    band = F.array_sort(F.array("p10", "p50", "p90"))
    rows = rows.withColumns({"low": band[0], "mid": band[1], "high": band[2]})
    inside = F.col("y").between(F.col("low"), F.col("high")).cast("int")
    return rows.groupBy("fit", "year").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(inside), 4).alias("coverage"), F.round(F.avg((F.col("y") <= F.col("mid")).cast("int")), 4).alias("below_mid"),
        F.round(F.avg(trees.loss_of(F.col("y") - F.col("high"), 0.9)), 2).alias("loss_high"), F.count_if((F.col("p10") > F.col("p50")) | (F.col("p50") > F.col("p90"))).alias("crossed"),
    )


@query("""
with x as (select l_returnflag as flag, year(l_shipdate) as year, l_quantity as q, l_extendedprice as p, l_extendedprice * (1 - l_discount) as net from lineitem),
a as (select k.flag, k.year, regr_slope(h.p, h.q) as b, avg(h.q) as mx, avg(h.p) as my from (select distinct flag, year from x) k join x h on h.flag = k.flag and h.year < k.year group by all),
one as (select x.*, a.my + a.b * (x.q - a.mx) as stage_one from x join a using (flag, year)),
c as (select k.flag, k.year, regr_slope(h.net, h.stage_one) as b, avg(h.stage_one) as mx, avg(h.net) as my from (select distinct flag, year from one) k join one h on h.flag = k.flag and h.year < k.year group by all),
two as (select one.*, c.my + c.b * (one.stage_one - c.mx) as stage_two from one join c using (flag, year))
select flag, year, count(*) as n, round(avg(abs(net - stage_two)), 4) as mae from two group by all
""")
def y07_two_stages(spark: SparkSession, d: str) -> DataFrame:
    """Net price from the price that quantity predicts: stage two learns from stage one's out-of-sample predictions alone."""
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.year("l_shipdate").cast("long").alias("year"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    out = walkforward.two_stages(rows, ["flag"], "year", "q", "p", "net").where("stage_two IS NOT NULL")
    return out.groupBy("flag", "year").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(F.col("net") - F.col("stage_two"))), 4).alias("mae"))


NAMES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey"]


@query()
def y03_search(spark: SparkSession, d: str) -> DataFrame:
    """A seeded search over ridge models of a line's price, in three rounds of one job each: the round that each trial reached, its error there, and the winner."""
    rows = table(spark, d, "lineitem")
    trials = walkforward.drawn_trials(24, len(NAMES), [0.0, 1.0, 100.0, 10_000.0], 5)
    judged = walkforward.halving(rows, [*map(F.col, NAMES), F.col("l_extendedprice")], F.year("l_shipdate") >= 2000, trials, F.col("l_orderkey"))
    out = [(",".join(NAMES[i] for i in j.trial.columns), j.trial.penalty, j.turn, j.error, k == 0) for k, j in enumerate(judged)]
    return spark.createDataFrame(out, "columns string, penalty double, turn int, mean_squared_error double, winner boolean")


#: What is tried against the primary, which has the history, calendar and efficiency families.
CANDIDATES = ("recent:2", "recent:3x4", "+family:role", "+family:ratings", "-family:calendar", "+cols:share3,vacated", "param:penalty=1000")
PRIMARY = ("history", "calendar", "efficiency")


@query()
def y10_trials(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of one line each, tried week by week on the matrix against the primary: gain, standard error, weeks won, and the verdict."""
    rows = table(spark, d, "events")
    rows = matrix.matrix_of(rows).withColumn("week", F.floor((F.col("season_day") + 7) / 7).cast("int"))
    primary = matrix.columns_of(list(PRIMARY))
    week, target = F.col("p"), F.col("t")
    tried = [walkforward.Variant("primary", primary, F.lit(1.0), 1.0)]
    for text in CANDIDATES:
        c = candidates.parsed(text, matrix.FEATURES, ("penalty",))
        tried.append(walkforward.Variant(text, c.applied(primary), c.weight(week, target - 1), c.value("penalty", 1.0)))
    return walkforward.verdicts(walkforward.weekly_errors(rows, tried, "y", "week", [2, 3, 4, 5]), "primary")
