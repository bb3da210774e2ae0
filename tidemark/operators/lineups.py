"""Line-ups: exact assignment of candidates to slots, calls between two line-ups, and records whose slots lock.

A group's pool is cut to the best few of each kind, as many as there are slots, which is all that
an assignment can use; so a group is one short array, and everything is a column over it: the best
filling of each subset of slots, extended one candidate at a time. Scores are whole numbers, so
totals are exact; of equal totals the filling with the smaller ids, in order of slots, wins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Slots = dict[str, list[str]]  # name to the kinds it takes, in order
#: An empty slot in a list of negated ids: below every id's.
EMPTY = -(1 << 62)
#: Hundredths of a score within which two picks tie, and within which a doubtful one gives way; and the override as a ratio.
NEAR_TIE, STATUS_GAP, OVERRIDE = 75, 200, (3, 2)


def allowed(kind: Column, slots: Slots) -> Column:
    """The slots that take a kind, as bits."""
    out = F.lit(0)
    for k in sorted({k for kinds in slots.values() for k in kinds}):
        out = F.when(kind == k, F.lit(sum(1 << i for i, kinds in enumerate(slots.values()) if k in kinds))).otherwise(out)
    return out


def best_filling(pool: Column, score: Callable[[Column], Column], slots: int) -> Column:
    """struct(filled, total, picks) of the filling with the most slots, then the largest total, then the smallest ids.

    pool: an array of structs with id and mask; a candidate whose score is NULL can't be taken.
    picks has an id, or NULL, for each slot.
    """
    state = "array<struct<total:bigint,picks:array<bigint>>>"
    none = F.struct(F.lit(0).cast("long").alias("total"), F.array(*[F.lit(EMPTY)] * slots).alias("picks"))
    start = F.array(none, *[F.lit(None)] * ((1 << slots) - 1)).cast(state)

    def extended(have: Column, c: Column, s: int) -> Column:
        picks = F.array(*[-c["id"] if j == s else have["picks"][j] for j in range(slots)])
        fits = have.isNotNull() & score(c).isNotNull() & (c["mask"].bitwiseAND(F.lit(1 << s)) != 0)
        return F.when(fits, F.struct((have["total"] + score(c)).alias("total"), picks.alias("picks")))

    def step(held: Column, c: Column) -> Column:
        ways = [[F.get(held, F.lit(m)), *[extended(F.get(held, F.lit(m ^ (1 << s))), c, s) for s in range(slots) if m >> s & 1]] for m in range(1 << slots)]
        return F.array(*[F.greatest(*w) if len(w) > 1 else w[0] for w in ways]).cast(state)

    def done(held: Column) -> Column:
        found = [F.when(F.get(held, F.lit(m)).isNotNull(), F.struct(F.lit(m.bit_count()).alias("filled"), F.get(held, F.lit(m))["total"].alias("total"), F.get(held, F.lit(m))["picks"].alias("picks"))) for m in range(1 << slots)]
        top = F.greatest(*found) if len(found) > 1 else found[0]
        return F.struct(top["filled"].alias("filled"), top["total"].alias("total"), F.transform(top["picks"], lambda p: F.when(p != EMPTY, -p)).alias("picks"))

    return F.aggregate(pool, start, step, done)


def pools(rows: DataFrame, group: str, slots: Slots, scores: list[str], more: list[str] = ()) -> DataFrame:
    """group and pool: an array of structs (id, kind, mask, scores and more columns), in order of id.

    rows has group, id and kind. Of each kind the best len(slots) by each score stay, and only
    rows of a kind that a slot takes.
    """
    rows = rows.withColumn("mask", allowed(F.col("kind"), slots)).where("mask <> 0")
    keep = F.lit(False)
    for i, s in enumerate(scores):
        place = F.row_number().over(Window.partitionBy(group, "kind").orderBy(F.desc_nulls_last(s), "id"))
        rows = rows.withColumn(f"_p{i}", place)
        keep = keep | (F.col(f"_p{i}") <= len(slots))
    fields = F.struct("id", "kind", "mask", *dict.fromkeys([*scores, *more]))
    return rows.where(keep).groupBy(group).agg(F.sort_array(F.collect_list(fields)).alias("pool"))


def by_slot(slots: Slots, **columns: Column) -> Column:
    """An array with a struct for each slot: its name, and each array's element there."""
    return F.array(*[F.struct(F.lit(name).alias("slot"), F.lit(i).alias("slot_no"), *[F.get(c, F.lit(i)).alias(k) for k, c in columns.items()]) for i, name in enumerate(slots)])


def _within(pool: Column, ids: Column) -> Column:
    """The candidates of an array of ids, in that order."""
    return F.transform(F.filter(ids, lambda i: i.isNotNull()), lambda i: F.get(F.filter(pool, lambda c: c["id"] == i), F.lit(0)))


def fits(chosen: Column, slots: int) -> Column:
    """Whether every candidate of chosen can have a slot: no set of slots has more candidates that fit nowhere else (Hall)."""

    def confined(some: int) -> Column:
        outside = F.lit(((1 << slots) - 1) & ~some)
        return F.size(F.filter(chosen, lambda c: c["mask"].bitwiseAND(outside) == 0))

    out = F.lit(True)
    for some in range(1 << slots):
        out = out & (confined(some) <= some.bit_count())
    return out


def decided(a: Column, b: Column) -> Column:
    """struct(take_b, rule) between one's own pick a and the model's pick b: candidates with own, model, volume, doubtful.

    A doubtful pick gives way to a sound one within STATUS_GAP. Within NEAR_TIE of each other the
    model decides, and if it ties too the larger volume. Otherwise the model's pick stands only if
    its lead is OVERRIDE times one's own and its volume no smaller.
    """
    own, model = (lambda c: F.coalesce(c["own"], F.lit(0))), (lambda c: F.coalesce(c["model"], c["own"], F.lit(0)))
    gap, lead = own(a) - own(b), model(b) - model(a)
    more, least = (F.coalesce(x["volume"], F.lit(0)) for x in (b, a))
    verdict = lambda take, rule: F.struct(take.alias("take_b"), F.lit(rule).alias("rule"))
    status = (a["doubtful"] != b["doubtful"]) & (F.abs(gap) <= STATUS_GAP)
    return (
        F.when(status, verdict(a["doubtful"], "status"))
        .when((F.abs(gap) <= NEAR_TIE) & (F.abs(lead) > NEAR_TIE), verdict(lead > 0, "tie, model"))
        .when(F.abs(gap) <= NEAR_TIE, verdict(more > least, "tie, volume"))
        .when((lead > 0) & (OVERRIDE[1] * lead >= OVERRIDE[0] * gap) & (more >= least), verdict(F.lit(True), "model"))
        .otherwise(verdict(F.lit(False), "own"))
    )


def paired(own: Column, model: Column, own_only: Column, model_only: Column, slots: int) -> Column:
    """Pairs (a, b, slot_no) of the picks in which two line-ups differ: same slot first, then same kind, then whoever fits, then whoever is left.

    own and model: arrays of ids by slot; own_only and model_only: the candidates (with slot_no, the
    own line-up's) that only one of them has, in order of slots.
    """
    one = lambda only, i: F.get(F.filter(only, lambda c: c["id"] == i), F.lit(0))
    at = [F.struct(one(own_only, F.get(own, F.lit(k))).alias("a"), one(model_only, F.get(model, F.lit(k))).alias("b")) for k in range(slots)]
    first = F.filter(F.array(*at), lambda p: p["a"].isNotNull() & p["b"].isNotNull())
    gone = lambda only, side: F.filter(only, lambda c: ~F.exists(first, lambda p: p[side]["id"] == c["id"]))

    def matched(rows: Column, state: Column, hit: Callable[[Column, Column], Column]) -> Column:
        def step(s: Column, a: Column) -> Column:
            b = hit(s["left"], a)
            have = b.isNotNull()
            return F.struct(
                F.when(have, F.concat(s["pairs"], F.array(F.struct(a.alias("a"), b.alias("b"))))).otherwise(s["pairs"]).alias("pairs"),
                F.when(have, F.filter(s["left"], lambda c: c["id"] != b["id"])).otherwise(s["left"]).alias("left"),
                F.when(have, s["alone"]).otherwise(F.concat(s["alone"], F.array(a))).alias("alone"),
            )

        return F.aggregate(rows, state, step)

    none = F.filter(own_only, lambda c: F.lit(False))
    same = matched(gone(own_only, "a"), F.struct(first.alias("pairs"), gone(model_only, "b").alias("left"), none.alias("alone")), lambda left, a: F.get(F.filter(left, lambda c: c["kind"] == a["kind"]), F.lit(0)))
    fit = lambda left, a: F.coalesce(F.get(F.filter(left, lambda c: c["mask"].bitwiseAND(F.pow(F.lit(2), a["slot_no"]).cast("int")) != 0), F.lit(0)), F.get(left, F.lit(0)))
    return matched(same["alone"], F.struct(same["pairs"].alias("pairs"), same["left"].alias("left"), none.alias("alone")), fit)["pairs"]


def called(rows: DataFrame, group: str, slots: Slots, borrow: list[str] = ()) -> DataFrame:
    """Three line-ups of each group: by one's own score, by the model's, and the call between them.

    rows: group, id, kind, own, model (hundredths, whole), volume, doubtful. Kinds in borrow have
    their own score where the model has none. Every two picks in which the line-ups differ are
    paired and decided; a swap is taken only if all picks still fit the slots. One row for each
    group and slot: own_id, model_id, call_id, and the rule of the pair that touches it (NULL where
    the line-ups agree; 'own, no slot' where a swap didn't fit).
    """
    n = len(slots)
    model = F.when(F.col("kind").isin(list(borrow)), F.coalesce("model", "own")).otherwise(F.col("model"))
    rows = rows.select(group, "id", "kind", F.col("own").cast("long"), model.cast("long").alias("model"), F.col("volume").cast("long"), F.coalesce("doubtful", F.lit(False)).alias("doubtful"))
    made = pools(rows, group, slots, ["own", "model"], ["volume", "doubtful"])
    pool = F.col("pool")
    made = made.withColumn("own", best_filling(pool, lambda c: c["own"], n)["picks"]).withColumn("model", best_filling(pool, lambda c: c["model"], n)["picks"])
    only = lambda x, y: F.filter(x, lambda i: i.isNotNull() & ~F.coalesce(F.array_contains(F.array_compact(y), i), F.lit(False)))
    with_slot = lambda cs: F.transform(cs, lambda c: c.withField("slot_no", (F.array_position(F.transform(F.col("own"), lambda p: F.coalesce(p, F.lit(EMPTY))), c["id"]) - 1).cast("int")))
    made = made.withColumn("own_only", with_slot(_within(pool, only(F.col("own"), F.col("model"))))).withColumn("model_only", with_slot(_within(pool, only(F.col("model"), F.col("own")))))
    made = made.withColumn("pairs", paired(F.col("own"), F.col("model"), F.col("own_only"), F.col("model_only"), n))
    mine = F.transform(_within(pool, F.col("own")), lambda c: F.struct(c["id"].alias("id"), c["mask"].alias("mask"), c["own"].alias("own")))

    def step(state: Column, p: Column) -> Column:
        verdict = decided(p["a"], p["b"])
        swapped = F.concat(F.filter(state["chosen"], lambda c: c["id"] != p["a"]["id"]), F.array(F.struct(p["b"]["id"].alias("id"), p["b"]["mask"].alias("mask"), p["b"]["own"].alias("own"))))
        may = fits(swapped, n)
        rule = F.when(verdict["take_b"] & ~may, F.lit("own, no slot")).otherwise(verdict["rule"])
        told = F.concat(state["told"], F.array(F.struct(p["a"]["id"].alias("a"), p["b"]["id"].alias("b"), rule.alias("rule"))))
        return F.struct(F.when(verdict["take_b"] & may, swapped).otherwise(state["chosen"]).alias("chosen"), told.alias("told"))

    nothing = F.array().cast("array<struct<a:bigint,b:bigint,rule:string>>")
    made = made.withColumn("end", F.aggregate("pairs", F.struct(mine.alias("chosen"), nothing.alias("told")), step))
    made = made.withColumn("call", best_filling(F.sort_array(F.col("end.chosen")), lambda c: F.coalesce(c["own"], F.lit(0).cast("long")), n)["picks"])
    out = made.select(group, "end", F.inline(by_slot(slots, own_id=F.col("own"), model_id=F.col("model"), call_id=F.col("call"))))
    touches = lambda i: F.get(F.filter("end.told", lambda t: (t["a"] == F.col(i)) | (t["b"] == F.col(i)))["rule"], F.lit(0))
    rule = F.when(~F.col("own_id").eqNullSafe(F.col("model_id")), F.coalesce(touches("own_id"), touches("model_id"), touches("call_id")))
    return out.select(group, "slot", "slot_no", "own_id", "model_id", "call_id", rule.alias("rule"))


def assigned(rows: DataFrame, group: str, slots: Slots) -> DataFrame:
    """Fill each group's slots from its rows (group, id, kind, score in whole numbers): group, slot, id, score.

    The most slots are filled, then the total is the largest. Rows without a score, and kinds that
    no slot takes, can't be used; slots that nobody is left for have no row.
    """
    made = pools(rows.where("score IS NOT NULL"), group, slots, ["score"])
    filled = made.withColumn("picks", best_filling(F.col("pool"), lambda c: c["score"], len(slots))["picks"])
    out = filled.select(group, "pool", F.inline(by_slot(slots, id=F.col("picks")))).where("id IS NOT NULL")
    return out.select(group, "slot", "id", F.get(F.filter("pool", lambda c: c["id"] == F.col("id")), F.lit(0))["score"].alias("score"))


def recorded(rows: DataFrame, before: DataFrame | None, group: str, slots: Slots, now: Column) -> DataFrame:
    """The record of each group's line-up at now, whose slots lock one after another as their picks start.

    rows: group, id, kind, score, starts (NULL: never). before: the last record, of group, slot,
    slot_no, id, starts, recorded_at, locked. A pick that has started by now keeps its slot, unless
    the slot is gone. The other slots are filled anew; once a group has a record, candidates that
    have started can't be added. Groups without candidates keep their locked slots. One row for
    each slot that has a pick; recorded_at of a kept one is that of its first record.
    """
    fields = "id, starts, recorded_at"
    rows = rows.select(group, "id", "kind", F.col("score").cast("long").alias("score"), "starts").where("score IS NOT NULL")
    if before is None:
        before = rows.limit(0).select(group, F.lit("").alias("slot"), F.lit(0).alias("slot_no"), "id", "starts", now.alias("recorded_at"), F.lit(False).alias("locked"))
    number = F.array_position(F.array(*[F.lit(s) for s in slots]), F.col("slot")) - 1
    old = before.withColumn("slot_no", number.cast("int"))
    kept = old.where((F.col("starts") <= now) & (F.col("slot_no") >= 0)).groupBy(group).agg(F.collect_list(F.struct("slot_no", *fields.split(", "))).alias("kept"))
    known = old.groupBy(group).agg(F.lit(True).alias("known")).join(kept, group, "left")
    joined = rows.join(known.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
    started, held = F.coalesce(F.col("starts") <= now, F.lit(False)), F.coalesce(F.exists("kept", lambda k: k["id"] == F.col("id")), F.lit(False))
    open_rows = joined.where(F.col("known").isNull() | ~(started | held)).select(group, "id", "kind", "score", "starts")
    pool = pools(open_rows, group, slots, ["score"], ["starts"]).join(known.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "full_outer")
    pool = pool.withColumn(group, F.coalesce(group, "_g")).drop("_g")
    taken = F.aggregate(F.coalesce("kept", F.array().cast(kept.schema["kept"].dataType)), F.lit(0), lambda a, k: a + F.pow(F.lit(2), k["slot_no"]).cast("int"))
    free = F.transform(F.coalesce("pool", F.array().cast(pool.schema["pool"].dataType)), lambda c: c.withField("mask", c["mask"].bitwiseAND(F.bitwise_not(F.col("taken")))))
    filled = pool.withColumn("taken", taken).withColumn("free", free).withColumn("picks", best_filling(F.col("free"), lambda c: c["score"], len(slots))["picks"])

    def row(i: int, name: str) -> Column:
        was = F.get(F.filter("kept", lambda k: k["slot_no"] == i), F.lit(0))
        new = F.get(F.filter("free", lambda c: c["id"] == F.get(F.col("picks"), F.lit(i))), F.lit(0))
        locked = was.isNotNull() | F.coalesce(new["starts"] <= now, F.lit(False))
        return F.struct(F.lit(name).alias("slot"), F.lit(i).alias("slot_no"), F.coalesce(was["id"], new["id"]).alias("id"), F.coalesce(was["starts"], new["starts"]).alias("starts"), F.coalesce(was["recorded_at"], now).alias("recorded_at"), locked.alias("locked"))

    return filled.select(group, F.inline(F.array(*[row(i, s) for i, s in enumerate(slots)]))).where("id IS NOT NULL")
