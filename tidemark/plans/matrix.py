"""The feature matrix: targets, their families as known before each day, and the assembled rows.

Events stand in for play: a user is a player, user_id % 16 the team, a day on which a team has any
event a game of it, and team t meets t + 1 or t - 1. All families are windows over daily rows that
end before the current day, so nothing pairs a target with its history; families of teams are
computed at the grain of team and day and joined to targets once. matrix_of() builds everything from
one table of events, so that an audit can run it on altered ones: daily rows and team days are written
once, a user's rows pass one shuffle by user, and targets one by team and day. Rows without a day are
last in every order, as in the SQL, and have no target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.plans.registry import query
from tidemark.sources.scratch import saved, scratch
from tidemark.sources.tables import table

TEAMS = 16
#: Days after which a rating is stale.
STALE = 2
_CTE = {
    "d": """select user_id, user_id % 16 as team, cast(ts as date) as day, date_diff('day', date '2024-01-01', cast(ts as date)) as i, count(*) as n, count(*) filter (event_type = 'view') as views,
      count(*) filter (event_type = 'error') as errors, count(*) filter (event_type = 'purchase') as buys, count(*) filter (event_type = 'click') as clicks, sum(cast(round(value, 2) as decimal(18,2))) as v from events group by all""",
    "td": "select team, day, i, team + 1 - 2 * (team % 2) as opponent, sum(n) as n, sum(v) as v, sum(errors) as errors, sum(views) as views, sum(buys) as buys from d group by all",
    "targets": """select u.user_id, td.team, td.day, td.i, td.opponent, td.team % 2 = 0 as home, d.n is not null as played, d.n, d.v, d.views, d.errors, d.buys, d.clicks, td.n as team_n from (select distinct user_id, team from d) u
      join td on td.team = u.team left join d on d.user_id = u.user_id and d.day = td.day""",
    "context": """select t.team, t.day, t.opponent, t.n3, t.v3, o.allowed3, (t.v3 + o.allowed3) / 2 as line, t.v3 > o.allowed3 as favoured from
      (select team, day, opponent, avg(n) over w as n3, round(cast(sum(v) over w as double) / count(*) over w, 6) as v3 from td window w as (partition by team order by day rows between 3 preceding and 1 preceding)) t left join
      (select a.team, a.day, round(cast(sum(b.v) over w as double) / nullif(count(b.v) over w, 0), 6) as allowed3 from td a left join td b on b.team = a.opponent and b.day = a.day window w as (partition by a.team order by a.day rows between 3 preceding and 1 preceding)) o on o.team = t.opponent and o.day = t.day""",
    "rated": """select td.team, td.day, td.i, td.opponent, r.rating from td left join (select user_id % 16 as team, cast(ts as date) as day, arg_max(value, (ts, event_id)) as rating from events where event_type = 'purchase' group by all) r on r.team = td.team and r.day = td.day""",
    "rating": """select team, day, opponent, case when i - rated_on <= 2 then newest end as rating, case when i - rated_on <= 2 then round(newest - oldest, 6) end as movement from (select *,
      last_value(rating ignore nulls) over p as newest, last_value(case when rating is not null then i end ignore nulls) over p as rated_on, first_value(rating ignore nulls) over (partition by team order by i range between 7 preceding and 1 preceding) as oldest
      from rated window p as (partition by team order by day rows between unbounded preceding and 1 preceding))""",
    "ratings": "select a.team, a.day, a.rating, a.movement, round(a.rating - b.rating, 6) as edge from rating a left join rating b on b.team = a.opponent and b.day = a.day",
    "depth": """select * from (select *, row_number() over (partition by team, day order by use3 desc nulls last, user_id) as place from (select user_id, team, day, i, sum(n) over (partition by user_id order by day rows between 3 preceding and 1 preceding) as use3 from d)) where place <= 3""",
    "outs": """select td.team, td.day, case when r.errors > 0 then coalesce(x.outs, 0) end as opponent_out from td left join td r on r.team = td.opponent and r.i = td.i - 1 left join
      (select p.team, p.i, count(*) filter (e.errors > 0) as outs from depth p left join d e on e.user_id = p.user_id and e.i = p.i - 1 group by all) x on x.team = td.opponent and x.i = td.i""",
    "streak0": """select *, case when mean_before is null or n = mean_before then 0 when n > mean_before then 1 else -1 end as sign from (select user_id, day, n, row_number() over w as k, avg(n) over (partition by user_id order by day rows between unbounded preceding and 1 preceding) as mean_before,
      case when row_number() over w >= 3 then avg(n) over (partition by user_id order by day rows between 2 preceding and current row) end as full3 from d window w as (partition by user_id order by day))""",
    "streak": """select user_id, day, lag(run) over w as run_before, max(full3) over (partition by user_id order by day rows between unbounded preceding and 1 preceding) as best3, lag(day) over w as last_day from (select *, sign * least(5, k - max(case when changed then k end) over (partition by user_id order by day) + 1) as run from (
      select *, lag(sign) over (partition by user_id order by day) is distinct from sign as changed from streak0)) window w as (partition by user_id order by day)""",
    "lagged": "select user_id, day, lag(n, 1) over w as a2, lag(n, 2) over w as a3 from d window w as (partition by user_id order by day)",
    "own": """select t.*, count(t.n) over p as n_before, avg(t.n) over p as mean_n, last_value(t.n ignore nulls) over p as last_n, last_value(l.a2 ignore nulls) over p as lag2, last_value(l.a3 ignore nulls) over p as lag3,
      coalesce(sum(t.n) over three, 0) as use3, cast(coalesce(sum(t.n) over three, 0) as double) / nullif(count(*) over three, 0) as per_game3, count(t.n) over three as played3,
      round(cast(sum(t.views) over p as double) / nullif(sum(t.n) over p, 0), 6) as view_share, round(cast(sum(t.buys) over p as double) / nullif(sum(t.n) over p, 0), 6) as buy_share, cast(sum(t.v) over p as double) as v_before,
      round(cast(sum(t.v) over p as double) / nullif(sum(t.n) over p, 0), 6) as v_per_n, round(cast(sum(t.v) over three as double) / nullif(sum(t.n) over three, 0), 6) as v_per_n3,
      t.i - last_value(case when t.n is not null then t.i end ignore nulls) over p as days_since, row_number() over w - 1 - coalesce(max(case when t.n is not null then k end) over p, 0) as missed_run,
      last_value(t.errors ignore nulls) over p as errors_last, count(case when t.errors > 0 then 1 end) over week as listed_7, t.i - last_value(case when t.errors > 0 then t.i end ignore nulls) over p as days_since_report, coalesce(lag(t.errors) over w > 0, false) as out,
      round(last_value(cast(t.n as double) / t.team_n ignore nulls) over p, 6) as share_last, round(cast(coalesce(sum(t.n) over three, 0) as double) / nullif(sum(t.team_n) over three, 0), 6) as share3,
      round((coalesce(sum(t.buys) over p, 0) + 2) / (coalesce(sum(t.views + t.buys) over p, 0) + 10), 6) as buy_rate, round((coalesce(sum(t.clicks) over p, 0) + 2) / (coalesce(sum(t.n) over p, 0) + 10), 6) as click_rate,
      round(stddev_pop(t.n) over p / nullif(avg(t.n) over p, 0), 6) as variation, round(avg(case when t.n >= 4 then 1.0 when t.n is not null then 0.0 end) over p, 6) as boom_rate,
      case when count(t.n) over p >= 2 then round(regr_slope(t.n, t.i) over p, 6) + 0.0 end as slope
      from (select *, row_number() over (partition by user_id order by day) as k from targets) t left join lagged l on l.user_id = t.user_id and l.day = t.day
      window w as (partition by t.user_id order by t.day), p as (partition by t.user_id order by t.day rows between unbounded preceding and 1 preceding), three as (partition by t.user_id order by t.day rows between 3 preceding and 1 preceding),
      week as (partition by t.user_id order by t.i range between 7 preceding and 1 preceding)""",
    "role": """select *, rank() over (partition by team, day order by use3 desc) as usage_rank, sum(use3) over g as team_use3, count(case when out then 1 end) over g - cast(out as int) as teammates_out, round(cast(sum(case when out then use3 else 0 end) over g as double) / nullif(sum(use3) over g, 0), 6) as vacated,
      lag(out) over o as above_out, lead(out) over o as below_out, lag(missed_run) over o as above_missed, lead(missed_run) over o as below_missed, lag(use3) over o - use3 as above_gap, use3 - lead(use3) over o as below_gap
      from own window g as (partition by team, day), o as (partition by team, day order by use3 desc, user_id)""",
    "allowed": """select team, day, a_views as allowed_views3, a_buys as allowed_buys3, a_errors as allowed_errors3, rank() over (partition by day order by a_views desc nulls last) as allowed_views_rank, rank() over (partition by day order by a_buys desc nulls last) as allowed_buys_rank, rank() over (partition by day order by a_errors desc nulls last) as allowed_errors_rank from (
      select a.team, a.day, round(avg(b.views) over w, 6) as a_views, round(avg(b.buys) over w, 6) as a_buys, round(avg(b.errors) over w, 6) as a_errors from td a left join td b on b.team = a.opponent and b.day = a.day window w as (partition by a.team order by a.day rows between 3 preceding and 1 preceding))""",
    "tempo": """select team, day, round(avg(tempo) over w, 4) as tempo3, round(10 + 0.5 * avg(n) over w, 6) as expected_volume from (select user_id % 16 as team, cast(ts as date) as day, cast(sum(gap) as double) / nullif(count(gap), 0) / 1000000 as tempo, count(*) as n
      from (select *, epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id, cast(ts as date) order by ts, event_id)) as gap from events) group by all) window w as (partition by team order by day rows between 3 preceding and 1 preceding)""",
    "lines": "select user_id, team, day, n, day + cast(((5 - isodow(day) + 6) % 7) + 1 as integer) as published from d",
    "published": """select t.user_id, t.day, case when f.first < t.day then count(b.day) end as reports_published, case when f.first < t.day then coalesce(sum(b.n), 0)::bigint end as n_published from targets t join (select team, min(published) as first from lines group by team) f on f.team = t.team
      left join lines b on b.user_id = t.user_id and b.published < t.day group by t.user_id, t.day, f.first""",
}


def _sql(select: str, *names: str) -> str:
    return "with " + ", ".join(f"{n} as ({_CTE[n]})" for n in names) + " " + select


def daily(events: DataFrame) -> DataFrame:
    """One row per user and day with any event; span and gaps are of the stamps of that day, in microseconds."""
    stamp = F.unix_micros(F.col("ts").cast("timestamp"))
    kind = lambda k: F.count_if(F.col("event_type") == k)
    rows = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), *[kind(k).alias(c) for k, c in (("view", "views"), ("error", "errors"), ("purchase", "buys"), ("click", "clicks"))], F.sum(F.round("value", 2).cast("decimal(18,2)")).alias("v"),
        F.when(F.count("ts") > 1, F.max(stamp) - F.min(stamp)).alias("span"), F.greatest(F.count("ts") - 1, F.lit(0)).alias("gaps"),
    )
    return rows.withColumns({"team": F.col("user_id") % TEAMS, "i": F.date_diff("day", F.lit("2024-01-01").cast("date")).cast("long")})


def team_days(rows: DataFrame) -> DataFrame:
    """One row per team and day with any event, and whom it meets."""
    out = rows.groupBy("team", "day", "i").agg(*[F.sum(c).alias(c) for c in ("n", "v", "errors", "views", "buys", "span", "gaps")])
    return out.withColumn("opponent", F.col("team") + 1 - 2 * (F.col("team") % 2))


def _by_day(key: str):
    return Window.partitionBy(key).orderBy(F.col("day").asc_nulls_last())


def _past(key: str, n: int | None = None):
    return _by_day(key).rowsBetween(Window.unboundedPreceding if n is None else -n, -1)


def targets(rows: DataFrame, teams: DataFrame) -> DataFrame:
    """Each user of a team on each of its days: played or not, and the day's own figures, which are labels."""
    users = rows.select("user_id", "team").distinct()
    own = rows.select("user_id", "day", "n", "v", "views", "errors", "buys", "clicks")
    out = users.join(teams.select("team", "day", "i", "opponent", F.col("n").alias("team_n")), "team").join(own, ["user_id", "day"], "left")
    return out.withColumns({"home": F.col("team") % 2 == 0, "played": F.col("n").isNotNull()})


def team_context(teams: DataFrame) -> DataFrame:
    """Means of the three games before, what the opponent has allowed in its three, and a line from both."""
    w = _past("team", 3)
    mean = lambda v: F.round(F.sum(v).over(w).cast("double") / F.nullif(F.count(v).over(w), F.lit(0)), 6)
    own = teams.select("team", "day", "opponent", F.avg("n").over(w).alias("n3"), mean("v").alias("v3"))
    met = teams.select(F.col("opponent").alias("team"), "day", F.col("v").alias("met"))
    allowed = teams.select("team", "day").join(met, ["team", "day"], "left").select(F.col("team").alias("opponent"), "day", mean("met").alias("allowed3"))
    both = own.join(allowed, ["opponent", "day"], "left")
    return both.select("team", "day", "opponent", "n3", "v3", "allowed3", ((F.col("v3") + F.col("allowed3")) / 2).alias("line"), (F.col("v3") > F.col("allowed3")).alias("favoured"))


def team_ratings(events: DataFrame, teams: DataFrame) -> DataFrame:
    """The newest rating from days before, NULL if stale, its movement within seven days, and the edge over the opponent."""
    bought = events.where("event_type = 'purchase'")
    own = bought.groupBy((F.col("user_id") % TEAMS).alias("team"), F.to_date("ts").alias("day")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("rating"))
    rows = teams.select("team", "day", "i", "opponent").join(own, ["team", "day"], "left")
    week = Window.partitionBy("team").orderBy("i").rangeBetween(-7, -1)
    known = rows.withColumns({
        "newest": F.last("rating", ignorenulls=True).over(_past("team")), "at": F.last(F.when(F.col("rating").isNotNull(), F.col("i")), ignorenulls=True).over(_past("team")), "oldest": F.first("rating", ignorenulls=True).over(week),
    })
    fresh = F.col("i") - F.col("at") <= STALE
    rated = known.select("team", "day", "opponent", F.when(fresh, F.col("newest")).alias("rating"), F.when(fresh, F.round(F.col("newest") - F.col("oldest"), 6)).alias("movement"))
    other = rated.select(F.col("team").alias("opponent"), "day", F.col("rating").alias("other"))
    return rated.join(other, ["opponent", "day"], "left").select("team", "day", "rating", "movement", F.round(F.col("rating") - F.col("other"), 6).alias("edge"))


def opponent_out(rows: DataFrame, teams: DataFrame) -> DataFrame:
    """How many of the opponent's first three by recent use were reported the day before; NULL without a report."""
    w = _by_day("user_id")
    reported = (F.lag("i").over(w) == F.col("i") - 1) & (F.lag("errors").over(w) > 0)
    used = rows.select("user_id", "team", "day", "i", F.sum("n").over(_past("user_id", 3)).alias("use3"), F.when(reported, 1).alias("out"))
    place = F.row_number().over(Window.partitionBy("team", "day").orderBy(F.col("use3").desc_nulls_last(), "user_id"))
    outs = used.withColumn("place", place).where("place <= 3").groupBy(F.col("team").alias("opponent"), "i").agg(F.count("out").alias("outs"))
    report = teams.select(F.col("team").alias("opponent"), (F.col("i") + 1).alias("i"), F.col("errors").alias("report"))
    out = teams.select("team", "day", "i", "opponent").join(outs, ["opponent", "i"], "left").join(report, ["opponent", "i"], "left")
    return out.select("team", "day", F.when(F.col("report") > 0, F.coalesce("outs", F.lit(0))).alias("opponent_out"))


def streaks(rows: DataFrame) -> DataFrame:
    """Entering each day played: the signed run above or below the own mean (5 at most), the best three days in turn, the last day."""
    w = _by_day("user_id")
    k, mean = F.row_number().over(w), F.avg("n").over(_past("user_id"))
    full3 = F.when(k >= 3, F.avg("n").over(w.rowsBetween(-2, 0)))
    sign = F.when(mean.isNull(), 0).otherwise(F.signum(F.col("n") - mean).cast("int"))
    signed = rows.withColumns({"k": k, "full3": full3, "sign": sign})
    changed = F.when(~F.lag("sign").over(w).eqNullSafe(F.col("sign")), F.col("k"))
    run = signed.withColumn("changed", changed).withColumn("run", F.col("sign") * F.least(F.lit(5), F.col("k") - F.max("changed").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1))
    entering = {"run_before": F.lag("run").over(w).cast("long"), "best3": F.max("full3").over(_past("user_id")), "last_day": F.lag("day").over(w)}
    return run.withColumns(entering).drop("k", "full3", "sign", "changed", "run")


def team_calendar(teams: DataFrame) -> DataFrame:
    """Each team's days numbered from 1, with how many there are and when the team's first lines came out."""
    team = Window.partitionBy("team")
    out = F.min(S.next_weekday(F.col("day"), "Fri")).over(team)
    there = teams.where("day IS NOT NULL")
    return there.select("team", "day", "i", "opponent", F.col("n").alias("team_n"), F.row_number().over(team.orderBy("day")).alias("game"), F.count(F.lit(1)).over(team).alias("games"), out.alias("first"))


def appearances(rows: DataFrame) -> DataFrame:
    """Daily rows with what belongs to days played alone: the two days played before, and the streaks."""
    w = _by_day("user_id")
    return streaks(rows.withColumns({"a2": F.lag("n", 1).over(w), "a3": F.lag("n", 2).over(w)}))


def filled(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """The targets with their daily rows, without a join of the two.

    Each daily row stands for its own team day and those up to the user's next row, the first one
    for the days before it as well; figures are kept on its own day. The calendar has a row per team
    and day and is broadcast.
    """
    w = _by_day("user_id")
    figures = [c for c in rows.columns if c not in ("user_id", "team", "day", "i")]
    ends = F.broadcast(calendar.where("game = games").select("team", "games"))
    at = rows.drop("i").join(ends, "team").join(F.broadcast(calendar.select("team", "day", "game")), ["team", "day"], "left")
    begin = F.when(F.row_number().over(w) == 1, 1).otherwise(F.col("game"))
    until = F.coalesce(F.lead("game").over(w) - 1, F.col("games")).cast("int")
    # a row without a day has no place, and stands for all days only where the user has no other row
    spread = at.withColumns({"begin": begin, "until": until}).withColumn("own", F.col("game")).drop("day", "game", "games")
    spread = spread.select("*", F.explode(F.sequence("begin", "until")).alias("game")).drop("begin", "until")
    played = F.col("own") == F.col("game")
    out = spread.select("user_id", "team", "game", *[F.when(played, F.col(c)).alias(c) for c in figures])
    out = out.join(F.broadcast(calendar.drop("games")), ["team", "game"])
    return out.withColumns({"home": F.col("team") % 2 == 0, "played": F.col("n").isNotNull()}).drop("game")


def own_history(wanted: DataFrame) -> DataFrame:
    """Targets with what each user had done before the day: use, lags, shares, rates, shape, reports and absences.

    Everything is a window over the user's targets that ends before the current one; days not
    played count in windows of three team days, and not in means and lags.
    """
    w = Window.partitionBy("user_id").orderBy("i")
    p, three, week = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(-3, -1), w.rangeBetween(-7, -1)
    last = lambda c: F.last(c, ignorenulls=True).over(p)
    zero = lambda c, over: F.coalesce(F.sum(c).over(over), F.lit(0))
    ratio = lambda a, b, over: F.round(F.sum(a).over(over).cast("double") / F.nullif(F.sum(b).over(over), F.lit(0)), 6)
    played, reported = F.col("n").isNotNull(), F.col("errors") > 0
    base = wanted.withColumn("k", F.row_number().over(w))
    return base.withColumns({
        "n_before": F.count("n").over(p), "mean_n": F.avg("n").over(p), "last_n": last("n"), "lag2": last("a2"), "lag3": last("a3"),
        "use3": zero("n", three), "per_game3": zero("n", three).cast("double") / F.nullif(F.count(F.lit(1)).over(three), F.lit(0)), "played3": F.count("n").over(three),
        "view_share": ratio("views", "n", p), "buy_share": ratio("buys", "n", p), "v_before": F.sum("v").over(p).cast("double"), "v_per_n": ratio("v", "n", p), "v_per_n3": ratio("v", "n", three),
        "days_since": F.col("i") - last(F.when(played, F.col("i"))), "missed_run": (F.col("k") - 1 - F.coalesce(F.max(F.when(played, F.col("k"))).over(p), F.lit(0))).cast("long"),
        "errors_last": last("errors"), "listed_7": F.count(F.when(reported, 1)).over(week), "days_since_report": F.col("i") - last(F.when(reported, F.col("i"))), "out": F.coalesce(F.lag("errors").over(w) > 0, F.lit(False)),
        "share_last": F.round(last(F.col("n").cast("double") / F.col("team_n")), 6), "share3": F.round(zero("n", three).cast("double") / F.nullif(F.sum("team_n").over(three), F.lit(0)), 6),
        "buy_rate": F.round((zero("buys", p) + 2) / (zero(F.col("views") + F.col("buys"), p) + 10), 6), "click_rate": F.round((zero("clicks", p) + 2) / (zero("n", p) + 10), 6),
        "variation": F.round(F.stddev_pop("n").over(p) / F.nullif(F.avg("n").over(p), F.lit(0.0)), 6), "boom_rate": F.round(F.avg(F.when(F.col("n") >= 4, 1.0).when(played, 0.0)).over(p), 6),
        "slope": F.when(F.count("n").over(p) >= 2, F.round(F.regr_slope("n", "i").over(p), 6) + 0.0),
    }).drop("k", "a2", "a3")


def roles(history: DataFrame) -> DataFrame:
    """A user's place among team-mates by recent use, what those out leave behind, and the neighbours above and below."""
    g, order = Window.partitionBy("team", "day"), [F.col("use3").desc(), F.col("user_id")]
    o, ranked = g.orderBy(*order), g.orderBy(order[0])
    out = F.col("out")
    return history.withColumns({
        "usage_rank": F.rank().over(ranked).cast("long"), "team_use3": F.sum("use3").over(g), "teammates_out": F.count(F.when(out, 1)).over(g) - out.cast("int"),
        "vacated": F.round(F.sum(F.when(out, F.col("use3")).otherwise(0)).over(g).cast("double") / F.nullif(F.sum("use3").over(g), F.lit(0)), 6),
        "above_out": F.lag("out").over(o), "below_out": F.lead("out").over(o), "above_missed": F.lag("missed_run").over(o), "below_missed": F.lead("missed_run").over(o),
        "above_gap": F.lag("use3").over(o) - F.col("use3"), "below_gap": F.col("use3") - F.lead("use3").over(o),
    })


def team_allowed(teams: DataFrame) -> DataFrame:
    """Views, purchases and errors that a team's opponents had in its three games before, and its rank of the day in each."""
    kinds = ("views", "buys", "errors")
    met = teams.select(F.col("opponent").alias("team"), "day", *[F.col(c).alias(f"met_{c}") for c in kinds])
    out = teams.select("team", "day").join(met, ["team", "day"], "left").select("team", "day", *[F.round(F.avg(f"met_{c}").over(_past("team", 3)), 6).alias(f"allowed_{c}3") for c in kinds])
    return out.withColumns({f"allowed_{c}_rank": F.rank().over(Window.partitionBy("day").orderBy(F.col(f"allowed_{c}3").desc_nulls_last())).cast("long") for c in kinds})


def team_tempo(teams: DataFrame) -> DataFrame:
    """Of a team's three games before: seconds between events of one user and day, and the volume by a linear rule.

    The gaps of a user's day add up to the time from its first event to its last.
    """
    g = teams.withColumn("tempo", F.col("span").cast("double") / F.nullif(F.col("gaps"), F.lit(0)) / 1e6)
    return g.select("team", "day", F.round(F.avg("tempo").over(_past("team", 3)), 4).alias("tempo3"), F.round(10 + 0.5 * F.avg("n").over(_past("team", 3)), 6).alias("expected_volume"))


def publications(wanted: DataFrame) -> DataFrame:
    """What had come out before each target's day, when lines come out on the Friday after they happen.

    Before a team's first publication nothing is covered, and both are NULL; after it, a user without
    lines has 0. In the order of their own Fridays, what is out by a day are the lines at least a week
    back, and two weeks on a Friday, as that day's come out on it.
    """
    friday = S.next_weekday(F.col("day"), "Fri")
    w = Window.partitionBy("user_id").orderBy(F.date_diff(friday, F.lit("1970-01-01").cast("date")).cast("long"))
    out = lambda c: F.when(F.weekday("day") == 4, c.over(w.rangeBetween(Window.unboundedPreceding, -14))).otherwise(c.over(w.rangeBetween(Window.unboundedPreceding, -7)))
    covered = F.col("first") < F.col("day")
    return wanted.withColumns({"reports_published": F.when(covered, out(F.count("n"))), "n_published": F.when(covered, F.coalesce(out(F.sum("n")), F.lit(0)))})


@query(_sql("select user_id, team, day, opponent, home, played from targets", "d", "td", "targets"))
def g04_targets(spark: SparkSession, d: str) -> DataFrame:
    """All targets: every user of a team on each of the team's days."""
    rows = daily(table(spark, d, "events"))
    return targets(rows, team_days(rows)).select("user_id", "team", "day", "opponent", "home", "played")


@query("""
with e as (select user_id, event_type, ts, event_id, date_diff('day', date '2024-01-01', cast(ts as date)) // 7 + 1 as week, cast(json_extract(props, '$.k') as bigint) % 4 as team from events where event_type <> 'error'),
s as (select user_id, week, team, max((ts, event_id)) as newest, arg_max(event_type, (ts, event_id)) as position, count(distinct event_type) as n_sources, string_agg(distinct event_type, ',' order by event_type) as sources from e group by all)
select user_id, week, team, position, n_sources, sources from (select *, row_number() over (partition by user_id, week order by newest desc) as p from s) where p = 1
""")
def g05_eligible(spark: SparkSession, d: str) -> DataFrame:
    """Who is eligible in a week, by any of four signals in the week before: freshest team and position, and all signals.

    A user with signals for several teams is eligible for that of the newest one only. Each event
    falls into one week, so no window is joined.
    """
    rows = table(spark, d, "events").where("event_type <> 'error'").select(
        "user_id", "event_type", "ts", "event_id", (F.floor(F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7) + 1).alias("week"), (F.get_json_object("props", "$.k").cast("long") % 4).alias("team"),
    )
    newest = F.struct("ts", "event_id")
    by_team = rows.groupBy("user_id", "week", "team").agg(F.max(newest).alias("newest"), F.max_by("event_type", newest).alias("position"), F.sort_array(F.collect_set("event_type")).alias("types"))
    first = F.row_number().over(Window.partitionBy("user_id", "week").orderBy(F.col("newest").desc()))
    kept = by_team.withColumn("p", first).where("p = 1")
    return kept.select("user_id", "week", "team", "position", F.size("types").cast("long").alias("n_sources"), F.array_join("types", ",").alias("sources"))


@query(_sql("select * from context", "d", "td", "context"))
def g09_team_context(spark: SparkSession, d: str) -> DataFrame:
    """One row per team and day: the three games before, and a line from both sides."""
    return team_context(team_days(daily(table(spark, d, "events"))))


@query(_sql("select user_id, day, run_before, best3, last_day from streak", "d", "streak0", "streak"))
def g15_streak(spark: SparkSession, d: str) -> DataFrame:
    """One row per user and day played: what its runs were before it."""
    return streaks(daily(table(spark, d, "events"))).select("user_id", "day", "run_before", "best3", "last_day")


@query(_sql("select * from ratings", "d", "td", "rated", "rating", "ratings"))
def g18_ratings(spark: SparkSession, d: str) -> DataFrame:
    """One row per team and day: the newest rating that isn't stale, its movement, and the edge."""
    events = table(spark, d, "events")
    return team_ratings(events, team_days(daily(events)))


@query("""
with e as (select *, user_id % 16 as team, cast(ts as date) as day, cast(json_extract(props, '$.k') as bigint) % 5 as bucket, epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id, cast(ts as date) order by ts, event_id)) as gap from events),
x as (select bucket, avg(case when event_type = 'view' then 1.0 else 0.0 end) as expected from e group by bucket),
g as (select team, day, cast(sum(gap) as double) / nullif(count(gap), 0) / 1000000 as tempo, avg(case when event_type = 'view' then 1.0 else 0.0 end - expected) as over_expected, count(*) as n from e join x using (bucket) group by all),
u as (select team, day, user_id as lead from (select *, row_number() over (partition by team, day order by n desc, user_id) as p from (select team, day, user_id, count(*) as n from e group by all)) where p = 1),
c as (select *, lag(lead) over (partition by team order by day) is distinct from lead as changed, row_number() over (partition by team order by day) as k from u)
select team, day, round(avg(tempo) over w, 4) as tempo3, round(avg(over_expected) over w, 6) as over_expected3, round(10 + 0.5 * avg(n) over w, 6) as expected_volume, changed, k - max(case when changed then k end) over (partition by team order by day) as tenure
from g join c using (team, day) window w as (partition by team order by day rows between 3 preceding and 1 preceding)
""")
def g19_script(spark: SparkSession, d: str) -> DataFrame:
    """Of the three games before: seconds between events of a user and day, views over what the bucket expects, and the volume by a linear rule; the day's leading user, whether new, and its tenure."""
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts", (F.col("user_id") % TEAMS).alias("team"), F.to_date("ts").alias("day"), (F.get_json_object("props", "$.k").cast("long") % 5).alias("bucket"))
    stamp = F.unix_micros(F.col("ts").cast("timestamp"))
    e = e.withColumn("gap", stamp - F.lag(stamp).over(Window.partitionBy("user_id", "day").orderBy("ts", "event_id")))
    view = F.when(F.col("event_type") == "view", 1.0).otherwise(0.0)
    expected = e.groupBy("bucket").agg(F.avg(view).alias("expected"))
    g = e.join(expected, "bucket").groupBy("team", "day").agg((F.sum("gap").cast("double") / F.nullif(F.count("gap"), F.lit(0)) / 1e6).alias("tempo"), F.avg(view - F.col("expected")).alias("over"), F.count(F.lit(1)).alias("n"))
    w, run = _past("team", 3), Window.partitionBy("team").orderBy("day")
    lead = e.groupBy("team", "day", "user_id").agg(F.count(F.lit(1)).alias("m")).groupBy("team", "day").agg(F.min(F.struct((-F.col("m")).alias("m"), "user_id"))["user_id"].alias("lead"))
    c = lead.select("team", "day", (~F.lag("lead").over(run).eqNullSafe(F.col("lead"))).alias("changed"), F.row_number().over(run).cast("long").alias("k"))
    c = c.select("team", "day", "changed", (F.col("k") - F.max(F.when(F.col("changed"), F.col("k"))).over(run.rowsBetween(Window.unboundedPreceding, 0))).alias("tenure"))
    trailing = g.select("team", "day", F.round(F.avg("tempo").over(w), 4).alias("tempo3"), F.round(F.avg("over").over(w), 6).alias("over_expected3"), F.round(10 + 0.5 * F.avg("n").over(w), 6).alias("expected_volume"))
    return trailing.join(c, ["team", "day"])


@query(_sql("select * from outs", "d", "td", "depth", "outs"))
def g22_opponent_out(spark: SparkSession, d: str) -> DataFrame:
    """One row per team and day: how many of the opponent's first three were reported the day before."""
    rows = daily(table(spark, d, "events"))
    return opponent_out(rows, team_days(rows))


_FAMILIES = ("d", "td", "targets", "context", "rated", "rating", "ratings", "depth", "outs", "streak0", "streak", "lagged", "own", "role", "allowed", "tempo", "lines", "published")
#: The matrix' columns: keys and labels, then features by family.
KEYS = ["user_id", "team", "day"]
LABELS = ["played", "y"]
FEATURES = {
    "calendar": ["opponent", "home", "season_day", "weekday"],
    "history": ["n_before", "mean_n", "last_n", "lag2", "lag3", "per_game3", "played3", "days_since", "missed_run"],
    "reports": ["errors_last", "listed_7", "days_since_report"],
    "usage": ["share_last", "share3", "view_share", "buy_share"],
    "efficiency": ["buy_rate", "click_rate"],
    "shape": ["variation", "boom_rate", "slope"],
    "value": ["v_before", "v_per_n", "v_per_n3"],
    "role": ["usage_rank", "team_use3", "teammates_out", "vacated"],
    "neighbours": ["above_out", "below_out", "above_missed", "below_missed", "above_gap", "below_gap"],
    "streak": ["run_before", "best3"],
    "published": ["reports_published", "n_published"],
    "context": ["n3", "v3", "allowed3", "line", "favoured"],
    "allowed": ["allowed_views3", "allowed_buys3", "allowed_errors3", "allowed_views_rank", "allowed_buys_rank", "allowed_errors_rank"],
    "ratings": ["rating", "movement", "edge"],
    "script": ["tempo3", "expected_volume"],
    "opponent": ["opponent_out"],
}


def columns_of(families: list[str]) -> list[str]:
    """Feature columns of the named families, in the matrix' order; a ValueError names an unknown one."""
    if unknown := [f for f in families if f not in FEATURES]:
        raise ValueError(f"no such family: {', '.join(unknown)}")
    return [c for f, cs in FEATURES.items() if f in families for c in cs]


def matrix_of(events: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """One row per target: keys, labels, and all families as known before the day; streaks only where the user played.

    more: further columns by name, worked out with the history, where all targets of a user lie in
    one task, and put after the features. Daily rows, and families of teams, which have a row per
    team and day, are read many times and are written under spark.checkpoint.dir first.
    """
    folder, more = scratch(events.sparkSession, "matrix"), more or {}
    rows = saved(daily(events), folder, "daily")
    teams = saved(team_days(rows).coalesce(1), folder, "teams")
    of_team = team_context(teams).drop("opponent")
    for family in (team_ratings(events, teams), opponent_out(rows, teams), team_allowed(teams), team_tempo(teams)):
        of_team = of_team.join(family, ["team", "day"])
    of_team, calendar = saved(of_team.coalesce(1), folder, "of_team"), saved(team_calendar(teams).coalesce(1), folder, "calendar")
    wanted = filled(appearances(rows.drop("span", "gaps")), calendar)
    full = roles(publications(own_history(wanted)).withColumns(more)).join(F.broadcast(of_team), ["team", "day"])
    full = full.withColumns({"season_day": F.col("i"), "weekday": F.weekday("day") + 1, "y": F.col("n")})
    return full.select(*KEYS, *LABELS, *columns_of(list(FEATURES)), *more)


@query(_sql(f"""select t.user_id, t.team, t.day, t.played, t.n as y, t.i as season_day, isodow(t.day) as weekday, {", ".join(f"{x}.{c}" for f, cs in FEATURES.items() for c in cs if c not in ("season_day", "weekday")
  for x in [dict(streak="s", published="q", context="c", allowed="a", ratings="r", script="e", opponent="o").get(f, "t")])}
from role t left join streak s on s.user_id = t.user_id and s.day = t.day join published q on q.user_id = t.user_id and q.day = t.day join context c on c.team = t.team and c.day = t.day join ratings r on r.team = t.team and r.day = t.day
join outs o on o.team = t.team and o.day = t.day join allowed a on a.team = t.team and a.day = t.day join tempo e on e.team = t.team and e.day = t.day""", *_FAMILIES))  # fmt: skip
def g24_matrix(spark: SparkSession, d: str) -> DataFrame:
    """The whole matrix of the events table: 3 keys, 2 labels and the features of 16 families."""
    return matrix_of(table(spark, d, "events"))
