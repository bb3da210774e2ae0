"""Shards by balanced label propagation: linked documents move to neighbours' shards under quotas.

Seeds, few and evenly spread, start with a shard; all other linked rows have none. In rounds of Spark
joins, rows take the shard of most of their neighbours, as far as its quota has room, and later move
where more of their links are. What has no links or found no room fills shards up at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import dropped, ranked, saved, scratch

#: Rows that follow one head, at most: bounds the links of a row.
FAN = 256


def _bucket(by: Column, n: int | Column) -> Column:
    """A hash bucket of n, or of 1 at least."""
    return F.pmod(F.xxhash64(by, F.lit(7)), F.greatest(F.lit(1), n if isinstance(n, Column) else F.lit(n)).cast("long"))


def _some(n: Column) -> Column:
    """As many buckets as a bucket of n rows then has rows, so that neither is large."""
    return F.ceil(F.sqrt(n))


def _chosen(index: Column, values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), (index + 1).cast("int"))


def numbered(keyed: DataFrame, folder: str) -> DataFrame:
    """node, group, r and at of all rows that share a group: r from 0 in the group, at from 0 over all groups in turn.

    Groups are put in order by hash. Sizes are written before rows are joined with them, so that
    the rows of a hot group can be split between tasks, and rows are ranked in hash buckets, the
    more of them the larger the group.
    """
    sizes = saved(keyed.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), folder, "sizes")
    starts = saved(_running(sizes, "n", "start", folder), folder, "starts")
    linked = saved(keyed.join(starts, "group").select("node", "group", "n", "start"), folder, "linked")
    rows = ranked(linked, ["group"], _bucket(F.col("node"), _some(F.col("n"))), [F.col("node")], "r", folder)
    return saved(rows.select("node", "group", "r", (F.col("start") + F.col("r")).alias("at")), folder, "numbered")


def group_links(rows: DataFrame, folder: str, fan: int = FAN) -> DataFrame:
    """Links (a, b, weight) that hold the rows of each group together: rows as numbered() gives them.

    Every fan-th row of a group is a head, which its next rows are linked with, and heads form a
    tree of that fan-out, so a group of any size gives one link a row and no row has more than
    2 * fan. A link weighs more towards the head, so that labels run from heads to their rows.
    """
    heads = rows.where(F.col("r") % fan == 0).select("group", F.floor(F.col("r") / fan).alias("h"), F.col("node").alias("b"))
    own = F.floor(F.col("r") / fan)
    up = rows.where("r > 0").select("group", F.col("node").alias("a"), F.when(F.col("r") % fan > 0, own).otherwise(F.floor((own - 1) / fan)).alias("h"))
    pairs = saved(up.join(heads, ["group", "h"]).select("a", "b"), folder, "pairs")
    return pairs.select("a", "b", F.lit(2 * fan + 2).cast("long").alias("weight")).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(1).cast("long").alias("weight")))


def seeds(rows: DataFrame, quota: list[int], folder: str, fan: int = FAN, fill: float = 0.9) -> DataFrame:
    """node and shard of all rows of groups: heads get the shard of their place in turn, others none yet.

    Places fill shards to `fill` of their quota only (more if there are more rows), which leaves
    room to move. A group larger than that gets heads in as few shards as it needs.
    """
    total = rows.count()
    share = min(1.0, max(fill, total / max(1, sum(quota))))
    edge, shard = 0, F.lit(0)
    for q in quota[:-1]:
        edge += int(q * share)
        shard = shard + (F.col("at") >= F.lit(edge)).cast("int")
    return saved(rows.select("node", F.when(F.col("r") % fan == 0, shard).cast("int").alias("shard")), folder, "seeds")


def link_seeds(links: DataFrame, labels: DataFrame, shards: int, folder: str) -> DataFrame:
    """node and shard of the nodes of links that labels lacks: those whose hash is lower than all neighbours' are seeds.

    Seeds are dealt out evenly; the others have no shard yet.
    """
    hashed = links.groupBy(F.col("a").alias("node")).agg(F.min(F.xxhash64("b")).alias("low"))
    more = saved(hashed.select("node", (F.xxhash64("node") < F.col("low")).alias("seed")).join(labels, "node", "left_anti"), folder, "more")
    n = more.count()
    placed = ranked(more.where("seed"), [], _bucket(F.col("node"), math.isqrt(n) + 1), [F.col("node")], "r", folder)
    return placed.select("node", F.pmod("r", F.lit(shards)).cast("int").alias("shard")).unionByName(more.where("NOT seed").select("node", F.lit(None).cast("int").alias("shard")))


def within(labels: DataFrame, quota: list[int], folder: str) -> DataFrame:
    """labels, but rows beyond a shard's quota have none."""
    used = _used(labels)
    if all(used.get(s, 0) <= q for s, q in enumerate(quota)):
        return labels
    order = ranked(labels.where("shard IS NOT NULL"), ["shard"], _bucket(F.col("node"), math.isqrt(max(used.values())) + 1), [F.col("node")], "r", folder)
    return saved(order.select("node", F.when(F.col("r") < _chosen(F.col("shard"), quota), F.col("shard")).alias("shard")).unionByName(labels.where("shard IS NULL")), folder, "within")


def _used(labels: DataFrame) -> dict[int, int]:
    return {r.shard: r.n for r in labels.where("shard IS NOT NULL").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}


def propagate(labels: DataFrame, links: DataFrame, shards: int, quota: list[int], folder: str, rounds: int = 8) -> DataFrame:
    """Move nodes to the shard that most of their neighbours' link weight is in, under quotas.

    labels: node and shard, null for a node that has none yet. In each round, a node wants the
    shard with the most weight among those with room, if that weighs more than its own. The wishes
    for a shard with too little room are ranked by what they gain, and as many are granted as it
    had room for at the round's start, so no shard passes its quota. Of the nodes that have a shard
    half may move in a round, by hash and turn about, so that neighbours don't trade places for
    ever. Ends when two rounds in turn had no wish, or after `rounds`.
    """
    still, old, used = 0, "", _used(labels)
    for turn in range(rounds):
        room = [quota[s] - used.get(s, 0) for s in range(shards)]
        near = links.join(labels.where("shard IS NOT NULL").withColumnsRenamed({"node": "b", "shard": "there"}), "b")
        votes = near.groupBy("a", "there").agg(F.sum("weight").alias("votes"))
        voted = votes.join(labels.withColumnsRenamed({"node": "a", "shard": "here"}), "a")
        stays = F.col("there").eqNullSafe(F.col("here"))
        best = voted.groupBy("a").agg(
            F.first("here").alias("here"),
            F.max(F.when(stays | (_chosen(F.col("there"), room) > 0), F.struct("votes", (-F.col("there")).alias("s")))).alias("best"),
            F.coalesce(F.max(F.when(stays, F.col("votes"))), F.lit(0)).alias("now"),
        )
        may = F.col("here").isNull() | (F.pmod(F.xxhash64("a") + turn, F.lit(2)) == 0)
        moves = best.where((F.col("best.votes") > F.col("now")) & may)
        moves = saved(moves.select("a", "here", (-F.col("best.s")).alias("to"), (F.col("best.votes") - F.col("now")).alias("gain")), folder, f"moves-{turn}")
        wishes = {r.to: r.n for r in moves.groupBy("to").agg(F.count(F.lit(1)).alias("n")).collect()}
        still = 0 if wishes else still + 1
        if still == 2:
            break
        if not wishes:
            continue
        if any(n > room[s] for s, n in wishes.items()):
            size = F.lit(math.isqrt(max(wishes.values())) + 1)
            order = F.concat(F.lpad((10**9 - F.col("gain")).cast("string"), 10, "0"), F.lpad(_bucket(F.col("a"), size).cast("string"), 9, "0"))
            moves = ranked(moves, ["to"], order, [F.col("a")], "r", folder).where(F.col("r") < _chosen(F.col("to"), room))
        granted = saved(moves.select(F.col("a").alias("node"), "here", "to"), folder, f"granted-{turn}")
        new = saved(labels.join(granted.select("node", "to"), "node", "left").select("node", F.coalesce("to", "shard").alias("shard")), folder, f"labels-{turn}")
        for r in granted.groupBy("here", "to").agg(F.count(F.lit(1)).alias("n")).collect():
            used[r.to] = used.get(r.to, 0) + r.n
            if r.here is not None:
                used[r.here] -= r.n
        if old:
            dropped(labels.sparkSession, old)
        labels, old = new, f"{folder}/labels-{turn}"
    return labels


def cut_share(labels: DataFrame, links: DataFrame) -> DataFrame:
    """links, and cut: how many of them run between shards, or from a node without one."""
    a, b = labels.withColumnsRenamed({"node": "a", "shard": "sa"}), labels.withColumnsRenamed({"node": "b", "shard": "sb"})
    return links.join(a, "a").join(b, "b").agg(F.count(F.lit(1)).alias("links"), F.coalesce(F.sum((~F.coalesce(F.col("sa") == F.col("sb"), F.lit(False))).cast("long")), F.lit(0)).alias("cut"))


def _running(rows: DataFrame, count: str, name: str, folder: str) -> DataFrame:
    """Adds name: the sum of count over earlier rows in the order of hash bucket and then group, in two levels."""
    cut = saved(rows.withColumn("_b", _bucket(F.col("group"), math.isqrt(rows.count()) + 1)), folder, f"cut-{name}")
    sums = cut.groupBy("_b").agg(F.sum(count).alias("_s"))
    before = saved(sums.withColumn("_before", F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_s"), folder, f"before-{name}")
    inner = Window.partitionBy("_b").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn("_in", F.coalesce(F.sum(count).over(inner), F.lit(0))).join(before, "_b").withColumn(name, F.col("_in") + F.col("_before")).drop("_b", "_in", "_before")


def shard(docs: DataFrame, shards: int = 40, links: DataFrame | None = None, rounds: int = 8) -> DataFrame:
    """Put every row in one of `shards` shards, counts at most one apart, equal texts together.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law ("rows"), shard, slot
    (gapless from 0 in its shard) and grown_shard (null under this law). Rows with a text that
    others have too are linked by group_links; further links (a, b, weight between doc_ids) are
    added. A few seeds start with a shard, and propagate() gives the rows linked with them theirs;
    rows without links, and those that no shard had room for, then fill each shard up to its quota,
    so counts come out exactly. A group larger than a shard's quota covers several. Null texts have
    size 16, checksum 0 and no group. Null doc_ids and repeated rows are rows like others, of one
    doc_id with several texts each row has further links; extra columns are ignored; an empty table
    gives no rows. Rows are ranked in hash buckets throughout; only counts by shard and bucket reach
    one task.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "shards")
    text = F.col("text")
    slim = docs.select(
        F.monotonically_increasing_id().alias("node"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("group"),
    )
    nodes = saved(slim, folder, "nodes")  # node numbers are fixed from here on
    total = nodes.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    labels, _ = _propagated(nodes, links, shards, quota, folder, rounds)
    labels = saved(labels.where("shard IS NOT NULL"), folder, "labelled")
    rest = nodes.select("node").join(labels, "node", "left_anti")
    everyone = labels.unionByName(_filled(rest, labels, shards, quota, folder))
    placed = saved(nodes.drop("group").join(everyone, "node"), folder, "all")
    out = ranked(placed, ["shard"], _bucket(F.col("node"), math.isqrt(max(quota)) + 1), [F.col("node")], "slot", folder)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def _propagated(nodes: DataFrame, links: DataFrame | None, shards: int, quota: list[int], folder: str, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Labels of all linked nodes after propagation (null for those without room), and the links."""
    fan = max(2, min(FAN, max(quota) // 8))
    rows = numbered(nodes.where(F.col("group").isNotNull()).select("node", "group"), folder)
    ties = group_links(rows, folder, fan)
    labels = seeds(rows, quota, folder, fan)
    if links is not None:
        of = nodes.select("doc_id", "node")
        named = links.join(of.withColumnsRenamed({"doc_id": "a", "node": "na"}), "a").join(of.withColumnsRenamed({"doc_id": "b", "node": "nb"}), "b")
        further = saved(named.select(F.col("na").alias("a"), F.col("nb").alias("b"), F.col("weight").cast("long").alias("weight")), folder, "further")
        ties = ties.unionByName(further)
        labels = labels.unionByName(link_seeds(further, labels, shards, folder))
    return propagate(within(labels, quota, folder), ties, shards, quota, folder, rounds), ties


def _filled(rest: DataFrame, labels: DataFrame, shards: int, quota: list[int], folder: str) -> DataFrame:
    """node and shard for rows without a shard: by rank, into what room the shards have."""
    used = _used(labels)
    rest = saved(rest, folder, "rest")
    order = ranked(rest, [], _bucket(F.col("node"), math.isqrt(sum(quota)) + 1), [F.col("node")], "_r", folder)
    edge, shard = 0, F.lit(0)
    for s in range(shards - 1):
        edge += quota[s] - used.get(s, 0)
        shard = shard + (F.col("_r") >= F.lit(edge)).cast("int")
    return order.select("node", shard.cast("int").alias("shard"))
