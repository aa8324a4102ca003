"""The life of a record over runs, in batch: gaps and islands over its observations.

Input is a log with one row per run and record: ``seq`` (arrival), ``run_id``, ``started_at``, ``record_id``, ``seen``,
``complete``, ``failed``, ``facts`` (hash or text of the facts) and optionally ``detail`` (a number that grows when extraction
improves). A run that isn't later than every run before it is ignored as a whole. What isn't seen counts as missing only
in a complete view. One shuffle by record serves all windows, which share partition and order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.functions.ids import event_id
from recordwatch.functions.times import days_between
from recordwatch.operators.keyed import running_max_before


@dataclass(frozen=True)
class Policy:
    """When an absence is long, and when failures ask for attention."""

    absent_observations: int = 4
    absent_days: int = 14
    failures_for_attention: int = 3


def accepted_runs(log: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of runs that start after every run that arrived before; with ``strict`` off a run may start at the same time."""
    runs = log.select("seq", "run_id", "started_at").groupBy("run_id").agg(F.min("seq").alias("seq"), F.min("started_at").alias("started_at"))
    marked = running_max_before(runs, "seq", "started_at")
    later = F.col("started_at") > F.col("max_before") if strict else F.col("started_at") >= F.col("max_before")
    return log.join(marked.filter(F.col("max_before").isNull() | later).select("run_id"), "run_id", "left_semi")


def by_number(last: Column) -> dict[str, Column]:
    """What differs from the last good reading where extraction is one number: ``changed, improved, degraded``."""
    return {"changed": ~F.col("facts").eqNullSafe(last["facts"]), "improved": F.col("detail") > last["detail"], "degraded": F.col("detail") < last["detail"]}


def timeline(log: DataFrame, policy: Policy = Policy(), payload: tuple[str, ...] = ("facts", "detail"), compare: Callable[[Column], dict[str, Column]] = by_number, carry: tuple[str, ...] = ()) -> DataFrame:
    """Accepted observations with ``kind, state, previous_state, streak, semantic_version, extraction_revision, attention, events``.

    ``payload`` names the columns of a reading; ``compare`` tells, for a good reading and a struct of the last good one's payload,
    whether facts ``changed`` and extraction ``improved`` or ``degraded``. Other columns that it gives are passed on, null where
    there is nothing to compare; ``carry`` names columns of the log to pass on as they are.
    """
    by_record = Window.partitionBy("record_id").orderBy("started_at", "seq")
    so_far = by_record.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_record.rowsBetween(Window.unboundedPreceding, -1)
    kind = F.when(F.col("seen") & ~F.col("failed"), "ok").when(F.col("seen"), "fail").when(F.col("complete"), "missing")
    rows = log.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    # Nothing is known of a record before it is first seen; that first time it is active even if reading it failed.
    rows = rows.withColumn("__known", F.max(F.col("seen").cast("int")).over(so_far)).filter("__known = 1")
    rows = rows.withColumn("__n", F.row_number().over(by_record)).withColumn("kind", F.when(F.col("__n") == 1, "ok").otherwise(F.col("kind")))
    turned = F.coalesce((F.col("kind") != F.lag("kind").over(by_record)).cast("int"), F.lit(1))
    rows = rows.withColumn("__turned", turned).withColumn("__island", F.sum("__turned").over(so_far))
    # Start and length of an island from the last turn, so that the partition stays the record.
    start = F.last(F.when(F.col("__turned") == 1, F.struct("__n", "started_at")), ignorenulls=True).over(so_far)
    rows = rows.withColumn("__start", start).withColumn("streak", (F.col("__n") - F.col("__start.__n") + 1).cast("long"))
    absent = (F.col("streak") >= policy.absent_observations) & (days_between(F.col("__start.started_at"), F.col("started_at")) >= policy.absent_days)
    state = F.when(F.col("kind") == "ok", "active").when(F.col("kind") == "fail", "fetch_failed").when(absent, "long_absent").otherwise("temporarily_missing")
    rows = rows.withColumn("state", state).withColumn("previous_state", F.lag("state").over(by_record))
    good = F.col("kind") == "ok"
    last_good = F.last(F.when(good, F.struct(*payload)), ignorenulls=True).over(before)
    rows = rows.withColumn("__last", last_good)
    known = F.col("__last").isNotNull() & good
    told = compare(F.col("__last"))
    marks = {k: known & F.coalesce(told.pop(k), F.lit(False)) for k in ("changed", "improved", "degraded")}
    rows = rows.withColumns(marks | {k: F.when(known, c) for k, c in told.items()})
    events = named_events()
    return rows.select(
        "seq", "run_id", "started_at", "record_id", "kind", "state", "previous_state", "streak", F.col("__start.started_at").alias("since"), "changed", "improved",
        (1 + F.sum(F.col("changed").cast("int")).over(so_far)).cast("long").alias("semantic_version"),
        (1 + F.sum(F.col("improved").cast("int")).over(so_far)).cast("long").alias("extraction_revision"),
        ((F.col("kind") == "fail") & (F.col("streak") >= policy.failures_for_attention)).alias("attention"), events.alias("events"), *told, *carry,
    )


def named_events() -> Column:
    """What an observation tells, in order, from ``kind, state, previous_state, changed, improved, degraded``."""
    absent = ("temporarily_missing", "long_absent")
    good, was_absent = F.col("kind") == "ok", F.col("previous_state").isin(*absent)
    entered = F.col("previous_state").isNull() | (F.col("previous_state") != F.col("state"))
    named: list[tuple[str, Column]] = [
        ("item_discovered", F.col("previous_state").isNull()),
        ("reappeared", F.col("kind").isin("ok", "fail") & was_absent),
        ("detail_fetch_failed", F.col("kind") == "fail"),
        ("detail_fetch_recovered", good & (F.col("previous_state") == "fetch_failed")),
        ("semantic_content_changed", F.col("changed")),
        ("extraction_improved", F.col("improved")),
        ("extraction_degraded", F.col("degraded")),
        ("temporarily_missing", (F.col("state") == "temporarily_missing") & ~was_absent),
        ("long_absence_reached", (F.col("state") == "long_absent") & entered),
    ]
    return F.array_compact(F.array(*[F.when(on, F.lit(name)) for name, on in named]))


def events(timed: DataFrame) -> DataFrame:
    """One row per event, with its id."""
    rows = timed.select("seq", "run_id", "started_at", "record_id", "previous_state", "state", "attention", F.explode("events").alias("event_type"))
    needs = F.col("attention") | (F.col("event_type") == "semantic_content_changed")
    return rows.withColumn("attention", needs).withColumn("event_id", event_id(F.col("run_id"), F.col("record_id"), F.col("event_type")))


def versions(timed: DataFrame) -> DataFrame:
    """One row per version of a record: when it is first seen, and when facts change or extraction improves."""
    kind = F.when(F.col("previous_state").isNull(), "new_item").when(F.col("changed"), "semantic_change").when(F.col("improved"), "extraction_improvement")
    return timed.withColumn("version_kind", kind).filter(F.col("version_kind").isNotNull()).select("record_id", "run_id", "started_at", "version_kind", "semantic_version", "extraction_revision")


def final_states(timed: DataFrame) -> DataFrame:
    """The last state of each record."""
    row = F.max(F.struct("started_at", "seq", "state", "streak", "semantic_version", "extraction_revision", "attention")).alias("r")
    return timed.groupBy("record_id").agg(row).select("record_id", "r.state", "r.streak", "r.semantic_version", "r.extraction_revision", "r.attention")


def resume_states(log: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """What has to be known of each record to go on without its log: ``final_states``, times as microseconds, and the last good reading.

    The lifecycle on streams takes these rows as its initial state.
    """
    timed = timeline(log, policy, carry=("facts", "detail"))
    place = ("started_at", "seq")
    last = F.max(F.struct(*place, "state", "kind", "streak", "since", "semantic_version", "extraction_revision")).alias("r")
    good = F.max(F.when(F.col("kind") == "ok", F.struct(*place, "facts", "detail"))).alias("g")
    return timed.groupBy("record_id").agg(last, good).select(
        "record_id", "r.state", "r.kind", "r.streak", F.unix_micros("r.since").alias("since"), "g.facts", F.col("g.detail").cast("double").alias("detail"), "r.semantic_version", "r.extraction_revision",
        F.unix_micros("r.started_at").alias("last"),
    )


def totals(found: DataFrame, types: list[str]) -> DataFrame:
    """Number of events of each type, as one row."""
    return found.agg(*[F.count_if(F.col("event_type") == t).alias(t) for t in types])


def by_source(states: DataFrame, found: DataFrame, source: str) -> DataFrame:
    """States and events of each source, each counted apart and then joined."""
    s = states.groupBy(F.col(source).alias("source")).agg(
        F.count_if(F.col("state") == "active").alias("active"), F.count_if(F.col("state") == "fetch_failed").alias("fetch_failed"),
        F.count_if(F.col("state").isin("temporarily_missing", "long_absent")).alias("absent"),
    )
    e = found.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("events"), F.count_if("attention").alias("needs_attention"))
    return s.join(e, "source", "full_outer").na.fill(0)


def initialize(existing: DataFrame, states: DataFrame, run_id: str, started_at: Column) -> DataFrame:
    """Records that have no state yet become active: ``record_id, run_id, started_at, event_type, version_kind, state, event_id``.

    Done again it gives nothing, since every record then has a state.
    """
    fresh = existing.select("record_id").distinct().join(states.select("record_id"), "record_id", "left_anti")
    rows = fresh.select(
        "record_id", F.lit(run_id).alias("run_id"), started_at.alias("started_at"), F.lit("lifecycle_initialized").alias("event_type"), F.lit("initial_snapshot").alias("version_kind"), F.lit("active").alias("state")
    )
    return rows.withColumn("event_id", event_id(F.col("run_id"), F.col("record_id"), F.col("event_type")))


def view_complete(reachable: Column, discovered: Column, truncated: Column, render_warning: Column) -> Column:
    """Whether what a run didn't see may count as missing."""
    no = F.lit(False)
    return F.coalesce(reachable, no) & F.coalesce(discovered, no) & ~F.coalesce(truncated, no) & ~F.coalesce(render_warning, no)
