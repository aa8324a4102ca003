"""Alerts: conditions, notifications, and the open/escalate/update/suppress/resolve machine.

The machine is a fold per alert key, since what a run does depends on when the key last notified. Observations are dealt
out by key, sorted within tasks and streamed in Arrow batches past a state of three numbers, so a key's history is never
gathered; a key has one observation per run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwatch.functions.ids import alert_key, digest, joined

# Lifecycle events that are told once, with severity and category.
NOTIFIED = {
    "item_discovered": ("info", "collection"),
    "semantic_content_changed": ("warning", "content_review"),
    "extraction_improved": ("info", "extraction"),
    "detail_fetch_recovered": ("info", "collection"),
    "reappeared": ("info", "collection"),
}
COOLDOWN_HOURS = 24


def notifications(events: DataFrame, processed: DataFrame, rules: dict[str, tuple[str, str]] = NOTIFIED, initialized: bool = True) -> DataFrame:
    """Events that haven't been processed and have a rule, with severity and category. The rules are a few rows.

    The first evaluation of all (``initialized`` false) tells nothing; afterwards every event counts as :func:`processed_after`.
    """
    told = events.sparkSession.createDataFrame([(k, *v) for k, v in rules.items()], "event_type string, severity string, category string")
    fresh = events.join(processed.select("event_id"), "event_id", "left_anti").join(F.broadcast(told), "event_type")
    return fresh if initialized else fresh.filter(F.lit(False))


def processed_after(events: DataFrame, processed: DataFrame) -> DataFrame:
    """Ids that count as processed after an evaluation: all there were and all it saw, told or not."""
    return processed.select("event_id").unionByName(events.filter(F.coalesce("event_id", F.lit("")) != "").select("event_id")).distinct()


def lifecycle_conditions(states: DataFrame) -> DataFrame:
    """``alert_key, alert_type, severity`` of records that are missing, absent or failing; keys hold ``source_id`` where states have it."""
    kind = F.when(F.col("state") == "temporarily_missing", "temporarily_missing").when(F.col("state") == "long_absent", "long_absent").when(F.col("state") == "fetch_failed", "detail_fetch_failed")
    severity = F.when((F.col("state") == "long_absent") | ((F.col("state") == "fetch_failed") & (F.col("streak") >= 3)), "high").otherwise("warning")
    rows = states.withColumn("alert_type", kind).filter(F.col("alert_type").isNotNull()).withColumn("severity", severity)
    source = F.col("source_id") if "source_id" in states.columns else F.lit(None)
    return rows.select(alert_key(F.col("alert_type"), source, F.col("record_id")).alias("alert_key"), "alert_type", "severity")


def step_conditions(steps: DataFrame, integrity: list[str]) -> DataFrame:
    """Conditions of steps that failed; those of integrity are critical. ``steps``: alert_type, outcome."""
    failed = F.col("outcome").isin("failure", "cancelled")
    observed = steps.filter(F.col("outcome").isin("success", "failure", "cancelled"))
    severity = F.when(F.col("alert_type").isin(*integrity), "critical").otherwise("warning")
    return observed.select(alert_key(F.col("alert_type"), F.lit(None), F.lit(None)).alias("alert_key"), "alert_type", F.when(failed, severity).alias("severity"))


def machine(observed: DataFrame, cooldown_hours: int = COOLDOWN_HOURS) -> DataFrame:
    """``alert_key, run_id, started_at, action, severity_rank`` for each run that does something.

    ``observed`` has one row per key and run that looked for it: ``alert_key, started_at, run_id, severity_rank``, where a null
    rank means that the condition is not met. Runs that didn't look for a key have no row and leave it as it is.
    """
    pause = cooldown_hours * 3_600_000_000
    rows = observed.select("alert_key", F.unix_micros("started_at").alias("at"), F.col("run_id").cast("string").alias("run_id"), F.col("severity_rank").cast("long").alias("rank"))
    dealt = rows.repartition("alert_key").sortWithinPartitions("alert_key", "at", "run_id", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = open_rank = until = last_run = None
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                now, at, run_id, rank = row
                if now != key:
                    key, open_rank, until, last_run = now, None, None, None
                action = None
                if open_rank is None:
                    action = "open" if rank is not None else None
                elif rank is None:
                    action = "resolve"
                elif rank > open_rank:
                    action = "escalate"
                elif run_id != last_run:
                    action = "update" if until <= at else "suppress"
                if action in ("open", "escalate", "update"):
                    until = at + pause
                if action:
                    for column, value in zip(out, (key, run_id, at, action, open_rank if rank is None else rank)):
                        column.append(value)
                open_rank, last_run = rank, run_id
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["alert_key", "run_id", "at", "action", "severity_rank"])

    told = dealt.mapInArrow(run, "alert_key string, run_id string, at long, action string, severity_rank long")
    return told.select("alert_key", "run_id", F.timestamp_micros("at").alias("started_at"), "action", "severity_rank")


def alert_event_id(run_id: Column, key: Column, action: Column, related: Column | None = None) -> Column:
    """Id of what a run did to an alert; ``related`` is the lifecycle event that a notification tells."""
    return digest(joined(run_id, key, action, F.lit("") if related is None else related), 20)


def action_counts(actions: DataFrame) -> DataFrame:
    """Counts by action and by severity; suppressed ones aren't counted by severity."""
    told = F.col("action") != "suppress"
    return actions.agg(
        *[F.count_if(F.col("action") == a).alias(f"n_{a}") for a in ("open", "escalate", "update", "suppress", "resolve")],
        *[F.count_if(told & (F.col("severity_rank") == k)).alias(f"severity_{k}") for k in range(4)],
    )


def counters(log: DataFrame, key: str, order: str, run: str, met: str) -> DataFrame:
    """``log`` with ``count``: runs in a row that met a condition, a run that looks twice counted once."""
    from pyspark.sql import Window

    runs = log.groupBy(key, run).agg(F.max(met).alias(met), F.min(order).alias(order))
    by = Window.partitionBy(key).orderBy(order)
    n = F.row_number().over(by)
    rows = runs.withColumn("__n", n)
    last = F.coalesce(F.max(F.when(~F.col(met), F.col("__n"))).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    return rows.withColumn("count", (F.col("__n") - last).cast("long")).drop("__n")


def is_stale(run_id: Column, started_at: Column, last_run_id: Column, last_started_at: Column) -> Column:
    """Whether an evaluation comes too late to change the state: another run that started before the last one."""
    return F.coalesce((run_id != last_run_id) & (started_at < last_started_at), F.lit(False))
