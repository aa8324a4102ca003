"""Alerts with the counters that raise them: one automaton for each alert key, whose state is a table.

Readings say what a run's evaluation looked at: ``seq, run_id, started_at, alert_key, alert_type, source_id, record_id``, whether
the condition is ``met`` (null: looked at, nothing to tell from it), and how it counts. A condition without a ``given`` count
counts its own runs in a row; it stands from ``open_at`` on, with ``low_rank``, or with ``high_rank`` from ``high_at`` on if
``high_if``. An evaluation speaks for all keys of the types it looked at: open alerts of these types that it doesn't raise are
resolved, and resolving sets the counter back, so a condition has to be met as often again.

An evaluation repeated by the same run doesn't count twice: not while its alert is open from that run (``by_key``), or not at
all. Evaluations of another run that started before the last one are left out as a whole.

The state of a key - counter, rank, times, run, cooldown - is a row of :data:`STATE`; :func:`evaluate` takes such a table and gives
the next, so a run goes on from the last and history isn't read again. Folding a log at once gives the same. Rows are dealt
out by key, sorted within tasks and streamed past the state of one key. Of the runs, one row for each and alert type is ordered
in one task per type.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.functions.classify import step_outcome
from recordwatch.functions.ids import alert_key
from recordwatch.operators.alerts import alert_event_id
from recordwatch.operators.conditions import CRITICAL, HIGH, INTEGRITY_ALERTS, WARNING
from recordwatch.operators.health import rolling_median
from recordwatch.operators.keyed import keep_last, running_max_before
from recordwatch.sources.shared import settled

STATE = "alert_key string, alert_type string, source_id string, record_id string, count long, severity_rank int, first_opened_at timestamp, last_observed_at timestamp, last_notified_at timestamp, last_run_id string, occurrence_count long, consecutive long, cooldown_until timestamp"
READING = "seq long, run_id string, started_at timestamp, alert_key string, alert_type string, source_id string, record_id string, met boolean, given long, low_rank int, high_rank int, open_at long, high_at long, high_if boolean, by_key boolean"
EVENT = "seq long, run_id string, started_at timestamp, alert_key string, alert_type string, source_id string, record_id string, action string, severity_rank int, consecutive long, occurrence_count long"


@dataclass(frozen=True)
class Policy:
    """When conditions are met, from when on they are high, and how long an open alert is silent."""

    cooldown_hours: int = 24
    unreachable_high: int = 2
    validation_high: int = 3
    trend_window: int = 8
    collapse_ratio: float = 0.25
    collapse_runs: int = 2
    success_rate: float = 0.5
    success_runs: int = 2


class Evaluation(NamedTuple):
    """What happened (:data:`EVENT` and ``alert_event_id``) and the state to go on from (:data:`STATE`)."""

    events: DataFrame
    states: DataFrame


def _columns(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _reading(rows: DataFrame, kind: Column, source: Column | None = None, record: Column | None = None, **how: Column | int | bool | None) -> DataFrame:
    source, record = (F.lit(None) if c is None else c for c in (source, record))
    set_to = {"met": None, "given": None, "low_rank": WARNING, "high_rank": HIGH, "open_at": 1, "high_at": None, "high_if": True, "by_key": True} | how
    typed = [(v if isinstance(v, Column) else F.lit(v)).cast(c.split()[1]).alias(c.split()[0]) for c in READING.split(", ")[7:] for v in [set_to[c.split()[0]]]]
    return rows.select(
        F.col("seq").cast("long").alias("seq"), F.col("run_id").cast("string").alias("run_id"), F.col("started_at").cast("timestamp").alias("started_at"), alert_key(kind, source, record).alias("alert_key"),
        kind.alias("alert_type"), source.cast("string").alias("source_id"), record.cast("string").alias("record_id"), *typed,
    )


def unreachable(sources: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Readings of ``seq, run_id, started_at, source_id, reachable``."""
    return _reading(sources, F.lit("source_unreachable"), F.col("source_id"), met=~F.coalesce("reachable", F.lit(False)), high_at=policy.unreachable_high)


def collapsed(sources: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Readings of candidates (``candidate_count``) against the median of the evaluations before; none of a source that wasn't reached or seen whole (``complete``)."""
    rows = rolling_median(sources.withColumn("usable", F.coalesce("complete", F.lit(True))), ["source_id"], ["seq"], "candidate_count", "usable", policy.trend_window)
    low = F.coalesce((F.col("median_before") > 0) & (F.col("candidate_count") < F.col("median_before") * policy.collapse_ratio), F.lit(False))
    whole = F.coalesce("reachable", F.lit(False)) & F.coalesce("complete", F.lit(False))
    return _reading(rows, F.lit("candidate_discovery_degraded"), F.col("source_id"), met=F.when(whole, low), open_at=policy.collapse_runs, by_key=False)


def success_rate(runs: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Readings of runs' details (``success, failed``); runs without details say nothing."""
    rate = F.col("success") / (F.col("success") + F.col("failed"))
    rows = runs.filter(F.col("success") + F.col("failed") > 0).withColumn("__rate", rate)
    return _reading(rows, F.lit("detail_success_rate_degraded"), met=F.col("__rate") < policy.success_rate, open_at=policy.success_runs, high_at=3, high_if=F.col("__rate") == 0, by_key=False)


def validation(runs: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Readings of checks of model output (``model_status, validation_status``); runs without output say nothing."""
    status, checked = F.coalesce("model_status", F.lit("")), F.coalesce("validation_status", F.lit(""))
    failed = (checked == "failed") | (status == "validation_failed")
    rows = runs.withColumn("__failed", failed).filter(failed | ((status == "generated") & (checked == "passed")))
    return _reading(rows, F.lit("llm_validation_failed"), met=F.col("__failed"), high_at=policy.validation_high)


def steps(outcomes: DataFrame, integrity: tuple[str, ...] = INTEGRITY_ALERTS) -> DataFrame:
    """Readings of steps (``alert_type, status``, of whatever spelling); skipped, pending and unknown ones say nothing."""
    rows = outcomes.withColumn("__outcome", step_outcome(F.col("status"))).filter(F.col("__outcome").isin("success", "failure", "cancelled"))
    bad = F.col("__outcome") != "success"
    return _reading(rows, F.col("alert_type"), met=bad, given=bad.cast("long"), low_rank=F.when(F.col("alert_type").isin(*integrity), CRITICAL).otherwise(WARNING))


def late_runs(runs: DataFrame) -> DataFrame:
    """Readings of runs whose lifecycle was ignored (``stale``)."""
    return _reading(runs, F.lit("stale_run_ignored"), met=F.col("stale"), given=F.col("stale").cast("long"))


def records(states: DataFrame) -> DataFrame:
    """Readings of the records' states (``source_id, record_id, state, streak``): all three types in every evaluation, raised or not."""
    kinds = {"temporarily_missing": "temporarily_missing", "long_absent": "long_absent", "detail_fetch_failed": "fetch_failed"}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("of")) for k, v in kinds.items()]))
    rows = states.withColumn("__x", each).withColumn("__met", F.col("state") == F.col("__x.of"))
    high = (F.col("__x.kind") == "long_absent") | ((F.col("__x.kind") == "detail_fetch_failed") & (F.col("streak") >= 3))
    given = F.when(F.col("__met"), F.greatest(F.coalesce("streak", F.lit(1)), F.lit(1))).otherwise(0)
    return _reading(rows, F.col("__x.kind"), F.col("source_id"), F.col("record_id"), met=F.col("__met"), given=given, low_rank=F.when(high, HIGH).otherwise(WARNING))


def in_time(readings: DataFrame, applied: tuple[str, datetime] | None = None) -> DataFrame:
    """Readings with ``late`` (another run that started later was evaluated before) and ``repeated`` (the run was evaluated before).

    ``applied`` is the run that was evaluated last, before these. All evaluations of a run have its one start.
    """
    runs = readings.select("seq", "run_id", F.unix_micros("started_at").alias("__at")).distinct()
    latest = running_max_before(runs, "seq", "__at")
    until = F.lit(None).cast("timestamp") if applied is None else F.lit(applied[1])
    late = F.coalesce(F.col("__at") < F.greatest("max_before", F.unix_micros(until)), F.lit(False))
    if applied is not None:
        late = late & ~((F.col("run_id") == applied[0]) & F.coalesce(F.col("__at") >= F.col("max_before"), F.lit(True)))
    marked = latest.withColumn("late", late)
    first = F.min(F.when(~F.col("late"), F.col("seq"))).over(Window.partitionBy("run_id"))
    again = F.coalesce(F.col("seq") > first, F.lit(False))
    if applied is not None:
        again = again | (F.col("run_id") == applied[0])
    return readings.join(marked.withColumn("repeated", again).select("seq", "late", "repeated"), "seq")


def _with_silent(readings: DataFrame, opened: DataFrame) -> DataFrame:
    """``readings`` and a row, without anything to tell, where the next evaluation of a key's type leaves the key out.

    One row after each gap is enough: it resolves what is open, and nothing opens in the rest of the gap.
    """
    types = readings.select("alert_type", "seq", "run_id", "started_at", "repeated").distinct()
    after = F.lead(F.struct("seq", "run_id", "started_at", "repeated")).over(Window.partitionBy("alert_type").orderBy("seq"))
    then = types.select("alert_type", "seq", after.alias("then"))
    own = F.lead("seq").over(Window.partitionBy("alert_key").orderBy("seq"))
    gone = readings.withColumn("__own", own).join(then, ["alert_type", "seq"]).filter("then is not null and (__own is null or __own > then.seq)")
    told = ["alert_key", "alert_type", "source_id", "record_id"]
    silent = gone.select(*told, "then.*")
    first = types.groupBy("alert_type").agg(F.min(F.struct("seq", "run_id", "started_at", "repeated")).alias("then"))
    seen = readings.groupBy("alert_key").agg(F.min("seq").alias("__own"))
    missed = opened.join(first, "alert_type").join(seen, "alert_key", "left").filter("__own is null or __own > then.seq")
    return readings.unionByName(silent.unionByName(missed.select(*told, "then.*")), allowMissingColumns=True)


def _values(column: pa.Array) -> list:
    """The values of a column as Python's, null as None; all at once, since a row at a time costs many times as much."""
    if pa.types.is_integer(column.type) and column.null_count:
        found = pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(object)
        found[np.asarray(column.is_null())] = None
        return found.tolist()
    return column.to_numpy(zero_copy_only=False).tolist()


#: What is asked of every row; the rest is read at the first row of a key and of a state.
_EACH = ("is_state", "alert_key", "seq", "run_id", "at", "met", "given", "low_rank", "high_rank", "open_at", "high_at", "high_if", "by_key", "repeated")
_AT_FIRST = ("count", "severity_rank", "first_opened_at", "last_observed_at", "last_notified_at", "last_run_id", "occurrence_count", "consecutive", "cooldown_until")


def _fold(cooldown_micros: int):
    """Rows of a key, the state it had first, as rows of what happens and, at the key's end, its state."""
    out_names = ["is_state", *_columns(EVENT), "count", "first_opened_at", "last_notified_at", "cooldown_until"]
    kinds = dict(c.split() for c in (EVENT + ", " + STATE).split(", ")) | {"is_state": "boolean"}
    arrow = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "timestamp": pa.timestamp("us", "UTC")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = names = None
        count, rank, first, seen, told, last_run, times, streak, until = [None] * 9
        for batch in batches:
            out: list[tuple] = []
            each = zip(*(_values(batch.column(c)) for c in _EACH))
            for i, (is_state, now_key, seq, run_id, at, met, n, low_rank, high_rank, open_at, high_at, high_if, by_key, repeated) in enumerate(each):
                if now_key != key:
                    if key is not None and (rank is not None or count):
                        out.append((True, None, last_run, seen, key, *names, None, rank, streak, times, count, first, told, until))
                    key, names = now_key, tuple(batch.column(c)[i].as_py() for c in ("alert_type", "source_id", "record_id"))
                    count, rank, first, seen, told, last_run, times, streak, until = 0, None, None, None, None, None, None, None, None
                if is_state:
                    count, rank, first, seen, told, last_run, times, streak, until = (batch.column(c)[i].as_py() for c in _AT_FIRST)
                    count = count or 0
                    continue
                same = rank is not None and last_run == run_id
                if n is None and met is not None:
                    again = same if by_key else repeated
                    count = count + (not again) if met else 0
                    n = count
                action = None
                if met and n >= open_at:
                    now = high_rank if high_at is not None and high_if and n >= high_at else low_rank
                    if rank is None:
                        action, first, times = "open", at, 0
                    elif now > rank:
                        action = "escalate"
                    elif not same:
                        action = "update" if until <= at else "suppress"
                    times, rank, streak, seen, last_run = times + (not same), now, n, at, run_id
                    if action in ("open", "escalate", "update"):
                        told, until = at, at + cooldown_micros
                elif rank is not None:
                    action = "resolve"
                if action:
                    out.append((False, seq, run_id, at, key, *names, action, rank, streak, times, None, None, None, None))
                if action == "resolve":
                    count, rank, first, seen, told, last_run, times, streak, until = 0, None, None, None, None, None, None, None, None
            yield pack(out)
        if key is not None and (rank is not None or count):
            yield pack([(True, None, last_run, seen, key, *names, None, rank, streak, times, count, first, told, until)])

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(out_names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), arrow[kinds[name]]) for name, c in zip(out_names, columns)], names=out_names)

    return run, ", ".join(f"{name} {kinds[name]}" for name in out_names)


def evaluate(readings: DataFrame, opened: DataFrame | None = None, applied: tuple[str, datetime] | None = None, policy: Policy = Policy(), stored: bool = False) -> Evaluation:
    """What the ``readings`` do to the alerts ``opened`` (:data:`STATE`), the run ``applied`` having been evaluated last.

    For a preview, evaluate alike and don't keep the states. Readings are written once first, unless they are ``stored`` already.
    """
    spark = readings.sparkSession
    opened = spark.createDataFrame([], STATE) if opened is None else opened.select(*_columns(STATE))
    timely = settled(in_time(readings if stored else settled(readings), applied).filter(~F.col("late")).drop("late"))
    rows = _with_silent(timely, opened).withColumn("is_state", F.lit(False)).withColumn("at", F.unix_micros("started_at")).drop("started_at")
    micros = {c: F.unix_micros(c) for c in ("first_opened_at", "last_observed_at", "last_notified_at", "cooldown_until")}
    known = opened.withColumns(micros).withColumn("is_state", F.lit(True))
    both = rows.unionByName(known, allowMissingColumns=True)
    run, ddl = _fold(policy.cooldown_hours * 3_600_000_000)
    order = ["alert_key", F.desc("is_state"), F.asc_nulls_first("seq")]
    told = both.repartition("alert_key").sortWithinPartitions(*order).mapInArrow(run, ddl)
    event_id = alert_event_id(F.col("run_id"), F.col("alert_key"), F.col("action")).alias("alert_event_id")
    events = told.filter(~F.col("is_state")).select(*_columns(EVENT), event_id)
    states = told.filter("is_state").withColumnsRenamed({"started_at": "last_observed_at", "run_id": "last_run_id"}).select(*_columns(STATE))
    return Evaluation(events, states)


def merged_events(events: DataFrame, keep: int | None) -> DataFrame:
    """One row for each ``alert_event_id``, the latest, at the place of the first; the last ``keep`` of them (None: all). ``position`` tells the place."""
    rest = [c for c in events.columns if c != "alert_event_id"]
    merged = events.groupBy("alert_event_id").agg(F.max(F.struct("seq", *[c for c in rest if c != "seq"])).alias("r"), F.min("seq").alias("position"))
    return keep_last(merged.select("alert_event_id", *[F.col(f"r.{c}").alias(c) for c in rest], "position"), [F.desc("position"), F.desc("alert_event_id")], keep)
