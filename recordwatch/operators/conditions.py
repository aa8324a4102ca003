"""Conditions of runs: what each run looked for and whether it was met, as rows for the alert machine.

Every function gives ``seq, run_id, started_at, alert_key, alert_type, count, severity_rank``, a row for each key that the run
looked for; a null rank says that the condition isn't met, so an open alert of the key is resolved. What a run did not look
for has no row and leaves alerts as they are. ``count`` is the number of runs in a row that met it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.functions.classify import step_outcome
from recordwatch.functions.ids import alert_key
from recordwatch.operators.health import rolling_median

INFO, WARNING, HIGH, CRITICAL = range(4)


@dataclass(frozen=True)
class Policy:
    """When conditions of runs are met, and from when on they are high."""

    unreachable_high: int = 2
    validation_high: int = 3
    trend_window: int = 8
    collapse_ratio: float = 0.5
    collapse_runs: int = 2
    success_rate: float = 0.5
    success_runs: int = 2


# Steps of a run by the alert they raise; failures of the second set are critical.
STEP_ALERTS = ("email_delivery_failed", "mirror_sync_failed", "output_validation_failed", "project_audit_failed", "state_integrity_failed", "transaction_failed", "stable_id_collision")
INTEGRITY_ALERTS = ("output_validation_failed", "project_audit_failed", "state_integrity_failed", "transaction_failed", "stable_id_collision")


def _streak(rows: DataFrame, met: Column, by: list[str]) -> DataFrame:
    """``rows`` with ``met`` and ``count``, the number of rows in a row that met it."""
    over = Window.partitionBy(*by).orderBy("seq") if by else Window.orderBy("seq")
    so_far = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn("met", F.coalesce(met, F.lit(False))).withColumn("__n", F.row_number().over(over))
    broken = F.coalesce(F.max(F.when(~F.col("met"), F.col("__n"))).over(so_far), F.lit(0))
    return numbered.withColumn("count", (F.col("__n") - broken).cast("long")).drop("__n")


def _told(rows: DataFrame, kind: Column, source: Column, record: Column, rank: Column) -> DataFrame:
    return rows.select("seq", "run_id", "started_at", alert_key(kind, source, record).alias("alert_key"), kind.alias("alert_type"), "count", rank.cast("int").alias("severity_rank"))


def unreachable(sources: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Sources that could not be reached (``seq, run_id, started_at, source_id, reachable``): a warning, high after some runs in a row."""
    rows = _streak(sources, ~F.col("reachable"), ["source_id"])
    rank = F.when(F.col("met"), F.when(F.col("count") >= policy.unreachable_high, HIGH).otherwise(WARNING))
    return _told(rows, F.lit("source_unreachable"), F.col("source_id"), F.lit(None), rank)


def collapsed(sources: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Sources whose candidates (``candidate_count``) fell far below the median of the runs before.

    Only reachable sources whose index was seen whole (``complete``) count; in other runs the condition isn't met and the streak stands.
    """
    whole = F.col("reachable") & F.col("complete")
    rows = rolling_median(sources.withColumn("usable", F.col("complete")), ["source_id"], ["seq"], "candidate_count", "usable", policy.trend_window)
    low = (F.col("median_before") > 0) & (F.col("candidate_count") < F.col("median_before") * policy.collapse_ratio)
    seen = _streak(rows.filter(whole), low, ["source_id"]).withColumn("rank", F.when(F.col("met") & (F.col("count") >= policy.collapse_runs), WARNING))
    rest = rows.filter(~whole).withColumn("count", F.lit(0).cast("long")).withColumn("rank", F.lit(None).cast("int"))
    both = seen.select(*rest.columns).unionByName(rest)
    return _told(both, F.lit("candidate_discovery_degraded"), F.col("source_id"), F.lit(None), F.col("rank"))


def success_rate(runs: DataFrame, by: list[str], policy: Policy = Policy()) -> DataFrame:
    """Runs whose details often failed (``success, failed``): a warning after some in a row, high from the third without any success. ``by`` names a stream of runs."""
    rows = runs.filter(F.col("success") + F.col("failed") > 0).withColumn("rate", F.col("success") / (F.col("success") + F.col("failed")))
    rows = _streak(rows, F.col("rate") < policy.success_rate, by)
    high = (F.col("count") >= 3) & (F.col("rate") == 0)
    rank = F.when(F.col("met") & (F.col("count") >= policy.success_runs), F.when(high, HIGH).otherwise(WARNING))
    return _told(rows, F.lit("detail_success_rate_degraded"), F.lit(None) if not by else F.col(by[0]), F.lit(None), rank)


def validation(runs: DataFrame, by: list[str], policy: Policy = Policy()) -> DataFrame:
    """Runs whose model output failed its checks (``model_status, validation_status``); runs without output say nothing."""
    failed = (F.col("validation_status") == "failed") | (F.col("model_status") == "validation_failed")
    passed = (F.col("model_status") == "generated") & (F.col("validation_status") == "passed")
    rows = _streak(runs.filter(failed | passed), failed, by)
    rank = F.when(F.col("met"), F.when(F.col("count") >= policy.validation_high, HIGH).otherwise(WARNING))
    return _told(rows, F.lit("llm_validation_failed"), F.lit(None) if not by else F.col(by[0]), F.lit(None), rank)


def steps(outcomes: DataFrame) -> DataFrame:
    """Steps that failed (``seq, run_id, started_at, alert_type, status``), of whatever spelling; skipped, pending and unknown ones say nothing."""
    rows = outcomes.withColumn("outcome", step_outcome(F.col("status"))).filter(F.col("outcome").isin("success", "failure", "cancelled"))
    bad = F.col("outcome") != "success"
    rank = F.when(bad, F.when(F.col("alert_type").isin(*INTEGRITY_ALERTS), CRITICAL).otherwise(WARNING))
    return _told(rows.withColumn("count", bad.cast("long")), F.col("alert_type"), F.lit(None), F.lit(None), rank)


def stale_runs(runs: DataFrame) -> DataFrame:
    """Runs that came too late to count (``stale``)."""
    rows = runs.withColumn("count", F.col("stale").cast("long"))
    return _told(rows, F.lit("stale_run_ignored"), F.lit(None), F.lit(None), F.when(F.col("stale"), WARNING))


def records(states: DataFrame) -> DataFrame:
    """Records that are missing, absent for long or failing, in each run (``seq, run_id, started_at, record_id, state, streak``, and ``source_id`` for their keys)."""
    source = F.col("source_id") if "source_id" in states.columns else F.lit(None)
    kinds = {"temporarily_missing": "temporarily_missing", "long_absent": "long_absent", "detail_fetch_failed": "fetch_failed"}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("of")) for k, v in kinds.items()]))
    rows = states.select("seq", "run_id", "started_at", source.alias("source_id"), "record_id", "state", "streak", each.alias("x")).withColumn("met", F.col("state") == F.col("x.of"))
    high = (F.col("x.kind") == "long_absent") | ((F.col("x.kind") == "detail_fetch_failed") & (F.col("streak") >= 3))
    rows = rows.withColumn("count", F.when(F.col("met"), F.col("streak")).otherwise(0).cast("long"))
    return _told(rows, F.col("x.kind"), F.col("source_id"), F.col("record_id"), F.when(F.col("met"), F.when(high, HIGH).otherwise(WARNING)))


def observed_types(conditions: DataFrame) -> DataFrame:
    """``seq, alert_type``: what each run looked for at all; open alerts of other types stay open."""
    return conditions.select("seq", "alert_type").distinct()
