"""Keyed state with event-time timers: rows that freeze at their event's start, and an as-of join of two streams.

Rows of a key may come in any order and in any batches; results depend on their event times alone,
since nothing is emitted before the watermark has passed the instant that decides it. Needs a state
store with timers: call use_keyed_state() once on a session.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EPOCH = datetime(1970, 1, 1)


def use_keyed_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _micros(t: datetime) -> int:
    """Microseconds since the epoch of a timestamp as workers see it (a local time without a zone)."""
    return round(t.timestamp() * 1_000_000) if t.tzinfo is None else round((t - EPOCH.replace(tzinfo=timezone.utc)).total_seconds() * 1_000_000)


def _stamp(micros: int) -> datetime:
    return datetime.fromtimestamp(micros / 1_000_000)


def _millis(micros: int) -> int:
    """The first whole millisecond at or after an instant, which timers count in."""
    return -(-micros // 1000)


class FreezeAtStart(StatefulProcessor):
    """Holds a key's revisions until its event starts; then emits the newest from before the start.

    When an event starts is what its newest revision says, so a start may move until it is reached.
    One timer a key; a key that has been emitted keeps a mark and takes no further rows.
    """

    def __init__(self, key: str, time: str, starts: str, value: str, value_type: str):
        self.names, self.value_type = (key, time, starts, value), value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "known long", f"starts long, value {self.value_type}")
        self.done = handle.getValueState("done", "done boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        _, time, starts, value = self.names
        if not self.done.exists():
            for r in rows:
                if r[time] is not None and r[starts] is not None:
                    self.rows.updateValue((_micros(r[time]),), (_micros(r[starts]), r[value]))
            known = [k[0] for k in self.rows.keys()]
            if known:
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(max(_millis(self.rows.getValue((max(known),))[0]), timerValues.getCurrentWatermarkInMs() + 1))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        name, _, starts, value = self.names
        held = {k[0]: v for k, v in self.rows.iterator()}
        begin = held[max(held)][0]
        before = [k for k in held if k < begin]
        self.rows.clear()
        self.done.update((True,))
        if before:
            yield Row(**{name: key[0], starts: _stamp(begin), value: held[max(before)][1]})

    def close(self) -> None:
        pass


def frozen(rows: DataFrame, key: str, starts: str, value: str, late: str, time: str = "ts") -> DataFrame:
    """key, starts and value as last known strictly before the event's start, once the watermark has passed it.

    rows: key, time (when a row became known), starts, value. Of rows known at one instant the last
    to come counts. A key all of whose rows are from its start or later gives nothing.
    """
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = f"{key} {kind[key]}, {starts} timestamp, {value} {kind[value]}"
    return rows.withWatermark(time, late).groupBy(key).transformWithState(FreezeAtStart(key, time, starts, value, kind[value]), out, "Append", "EventTime")


class AsOf(StatefulProcessor):
    """Gives each target of a key the newest row known strictly before its cutoff, when the watermark has passed the cutoff.

    Rows that no open or later target can ask for are dropped: of those before the watermark, only the
    newest stays.
    """

    def __init__(self, key: str, value: str, value_type: str):
        self.key, self.value, self.value_type = key, value, value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "known long, tie long", f"value {self.value_type}")
        self.targets = handle.getMapState("targets", "cutoff long, id long", "there boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            at = _micros(r["_time"])
            if r["_target"] is None:
                self.rows.updateValue((at, r["_tie"]), (r["_value"],))
            else:
                self.targets.updateValue((at, r["_target"]), (True,))
                self.handle.registerTimer(max(_millis(at), timerValues.getCurrentWatermarkInMs() + 1))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        known = sorted(tuple(k) for k in self.rows.keys())
        open_ = sorted(tuple(k) for k in self.targets.keys())
        for cutoff, target in open_:
            if _millis(cutoff) <= now:
                before = [k for k in known if k[0] < cutoff]
                found = self.rows.getValue(before[-1]) if before else None
                self.targets.removeKey((cutoff, target))
                yield Row(**{self.key: key[0], "target": target, "cutoff": _stamp(cutoff), "known_at": _stamp(before[-1][0]) if before else None, self.value: found[0] if found else None})
        least = min([c for c, _ in open_ if _millis(c) > now] + [timerValues.getCurrentWatermarkInMs() * 1000])
        for k in [k for k in known if k[0] < least][:-1]:
            self.rows.removeKey(k)

    def close(self) -> None:
        pass


def as_of(targets: DataFrame, rows: DataFrame, key: str, cutoff: str, target: str, known_at: str, value: str, tie: str, late: str) -> DataFrame:
    """key, target, cutoff, known_at and value: each target with the newest row known strictly before its cutoff; NULLs without one.

    targets: key, target (a long id) and cutoff; rows: key, known_at, tie (a long) and value; of rows
    known at one instant the largest tie counts. Both streams share one watermark, late behind the
    newest instant of either, so a target waits until rows before its cutoff can't come any more.
    Targets and rows that are later than that are dropped.
    """
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    a = targets.select(key, F.col(cutoff).alias("_time"), F.col(target).cast("long").alias("_target"), F.lit(None).cast("long").alias("_tie"), F.lit(None).cast(kind[value]).alias("_value"))
    b = rows.select(key, F.col(known_at).alias("_time"), F.lit(None).cast("long").alias("_target"), F.col(tie).cast("long").alias("_tie"), F.col(value).alias("_value"))
    out = f"{key} {kind[key]}, target long, cutoff timestamp, known_at timestamp, {value} {kind[value]}"
    both = a.unionByName(b).where("_time IS NOT NULL").withWatermark("_time", late)
    return both.groupBy(key).transformWithState(AsOf(key, value, kind[value]), out, "Append", "EventTime")
