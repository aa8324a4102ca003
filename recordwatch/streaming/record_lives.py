"""The lifecycle on streams, whole: late runs are left out, repeated observations count once, and each record's life is keyed state.

Observations are the batch form's log and the place of their run, ``run_seq``, the same for all rows of a run. A run's first
row announces it; the gate, one state for all runs, lets a run pass if it starts later than every run announced before, and
observations join the runs that passed. A record's life starts from :func:`operators.lifecycle.resume_states` where such a table
is given. In append mode everything comes out in the micro-batch in which it came in.

Rows that start more than ``delay`` before the latest are dropped by Spark: their runs can't pass any more, unless they were
announced in time. An observation of a run that passed, but that arrives after its record was seen by a later run, is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from recordwatch.operators.lifecycle import Policy
from recordwatch.sources import shared
from recordwatch.streaming.lifecycle_stream import step

LIFE = "state string, kind string, streak long, since long, facts string, detail double, semantic_version long, extraction_revision long, last long"
EVENTS = "record_id string, run_id string, at long, event_type string, previous_state string, state string, streak long, semantic_version long, extraction_revision long"
PASSED = "passed_id string, passed_at timestamp"
#: What of an observation a record's life needs. It goes to Python as one text, since Spark hands each value of a row over by itself.
TOLD = ("at", "seq", "run_id", "seen", "complete", "failed", "facts", "detail")
#: The columns of :data:`EVENTS` but the record; a record's events come back as one row with a list for each.
LISTS = tuple(c.split()[0] for c in EVENTS.split(", ")[1:])
OUT = ", ".join(f"{c.split()[0]} array<{c.split()[1]}>" if c.split()[0] in LISTS else c for c in EVENTS.split(", "))
#: State is kept in RocksDB, without a lookup at each write that only serves to count rows.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
EPOCH = datetime(1970, 1, 1)
SINCE, LAST = 3, 8


def _time(micros: int) -> datetime:
    return EPOCH + timedelta(microseconds=micros)


def _micros(time: datetime) -> int:
    return (time - EPOCH) // timedelta(microseconds=1)


class RunGate(StatefulProcessor):
    """Runs in the order of ``run_seq``; those that start later than every run before pass."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        latest = self.latest.get()[0] if self.latest.exists() else None
        for r in sorted((json.loads(r.told) for r in rows), key=lambda r: (r["run_seq"], r["at"])):
            if latest is None or r["at"] > latest:
                latest = at = r["at"]
                yield Row(passed_id=r["run_id"], passed_at=_time(at).replace(tzinfo=timezone.utc))
        if latest is not None:
            self.latest.update((latest,))

    def close(self) -> None:
        pass


class RecordLife(StatefulProcessor):
    """A record's life; with ``absence_timer`` a long absence is told when its days are over, not by the run after."""

    def __init__(self, policy: Policy = Policy(), absence_timer: bool = False) -> None:
        self.policy, self.absence_timer = policy, absence_timer

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.life = handle.getValueState("life", LIFE)

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: TimerValues) -> None:
        self.life.update(tuple(initialState[c.split()[0]] for c in LIFE.split(", ")))

    def _known(self) -> tuple | None:
        found = self.life.get()
        if found is None:
            return None
        found = list(found)
        found[SINCE], found[LAST] = _time(found[SINCE]), _time(found[LAST])
        return tuple(found)

    def _keep(self, life: tuple) -> None:
        kept = list(life)
        kept[SINCE], kept[LAST] = _micros(life[SINCE]), _micros(life[LAST])
        self.life.update(tuple(kept))

    def _set_timer(self, life: tuple) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if life[0] == "temporarily_missing":
            self.handle.registerTimer(_micros(life[SINCE] + timedelta(days=self.policy.absent_days)) // 1000)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        life, out = self._known(), []
        for r in sorted((json.loads(r.told) for r in rows), key=lambda r: (r["at"], r["seq"])):
            detail = None if r["detail"] is None else float(r["detail"])
            life, events, before = step(life, (r["run_id"], _time(r["at"]), r["seen"], r["complete"], r["failed"], r["facts"], detail), self.policy)
            out += [self._values(r["run_id"], r["at"], e, before, life) for e in events]
        if out:
            yield self._row(key, out)
        if life is not None:
            self._keep(life)
            if self.absence_timer:
                self._set_timer(life)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        life = self._known()
        if life is not None and life[0] == "temporarily_missing" and life[2] >= self.policy.absent_observations:
            after = ("long_absent", *life[1:])
            self._keep(after)
            yield self._row(key, [self._values(None, expiredTimerInfo.getExpiryTimeInMs() * 1000, "long_absence_reached", life[0], after)])

    @staticmethod
    def _values(run_id: str | None, at: int, event: str, before: str | None, life: tuple) -> tuple:
        return run_id, at, event, before, life[0], life[2], life[6], life[7]

    @staticmethod
    def _row(key: tuple, events: list[tuple]) -> Row:
        return Row(record_id=key[0], **{c: list(values) for c, values in zip(LISTS, zip(*events))})

    def close(self) -> None:
        pass


def passed_runs(log: DataFrame, delay: str) -> DataFrame:
    """``passed_id, passed_at`` of the runs of a stream that started later than every run announced before; one row a run goes through the gate."""
    runs = log.select("run_id", "run_seq", "started_at").withWatermark("started_at", delay).dropDuplicatesWithinWatermark(["run_id"])
    keyed = runs.select(F.lit("all").alias("gate"), F.to_json(F.struct("run_seq", F.unix_micros("started_at").alias("at"), "run_id"), {"ignoreNullFields": "false"}).alias("told")).groupBy("gate")
    return keyed.transformWithState(RunGate(), PASSED, "Append", "EventTime", eventTimeColumnName="passed_at")


def record_lives(log: DataFrame, policy: Policy = Policy(), initial: DataFrame | None = None, delay: str = "30 days", absence_timer: bool = False, gated: bool = True) -> DataFrame:
    """:data:`EVENTS` of a stream of observations; ``initial`` holds the lives so far. Without ``gated`` all runs pass."""
    rows = log.withColumn("record_id", F.col("record_id").cast("string")).withColumn("run_id", F.col("run_id").cast("string"))
    # What the join and its state don't need isn't carried through them.
    watched = rows.select("record_id", "started_at", *[c for c in TOLD if c != "at"]).withWatermark("started_at", delay)
    if gated:
        passed = passed_runs(rows, delay)
        watched = watched.join(passed, (F.col("run_id") == F.col("passed_id")) & (F.col("started_at") == F.col("passed_at"))).drop("passed_id", "passed_at")
    once = watched.dropDuplicatesWithinWatermark(["run_id", "record_id"]).withColumn("at", F.unix_micros("started_at"))
    once = once.select("record_id", F.to_json(F.struct(*TOLD), {"ignoreNullFields": "false"}).alias("told"))
    start = None if initial is None else initial.withColumn("record_id", F.col("record_id").cast("string")).groupBy("record_id")
    told = once.groupBy("record_id").transformWithState(RecordLife(policy, absence_timer), OUT, "Append", "EventTime", initialState=start)
    return told.select("record_id", F.explode(F.arrays_zip(*LISTS)).alias("e")).select("record_id", "e.*")


def events_once(events: DataFrame, delay: str, id_col: str = "event_id", time: str = "occurred_at") -> DataFrame:
    """A stream of events with each id once, however often it is sent within ``delay``."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([id_col])


def run_to_end(stream: DataFrame, folder: str | None = None, timers: bool = True) -> DataFrame:
    """All that a stream gives of what is there now, as a table in ``folder``; a run that was broken off goes on from its checkpoint there.

    Without ``timers`` nothing is told by time alone, so no micro-batch without rows follows the last one; what may go of the state goes with the next rows.
    """
    spark = stream.sparkSession
    folder = folder or shared.folder(spark, "stream")
    settings = SETTINGS | {"spark.sql.streaming.noDataMicroBatches.enabled": str(timers).lower()}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        query = stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
