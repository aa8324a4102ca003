"""Data-quality rules: each a row with its name, whether it holds and how many rows break it.

All row rules of a table are counted in one pass over it; keys and references take one shuffle each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _told(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    one = df.agg(*[c.cast("long").alias(f"c{k}") for k, c in enumerate(counts.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.coalesce(F.col(f"c{k}"), F.lit(0)).alias("violations")) for k, name in enumerate(counts)])
    return one.select(F.inline(rows))


def row_rules(df: DataFrame, **broken: Column) -> DataFrame:
    """Rules on single rows: each given as the condition that breaks it (null doesn't)."""
    return _told(df, {k: F.count_if(c) for k, c in broken.items()})


def unique(df: DataFrame, name: str, *key: str) -> DataFrame:
    """Rows beyond the first of each key, and rows with a blank in the key."""
    blank = reduce(lambda a, b: a | b, [F.col(k).isNull() | (F.col(k).cast("string") == "") for k in key])
    grouped = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return _told(grouped, {name: F.sum(F.when(blank, F.col("__n")).otherwise(F.col("__n") - 1))})


def refers(child: DataFrame, name: str, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent."""
    lost = child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias("__p")), F.col(key) == F.col("__p"), "left_anti")
    return _told(lost, {name: F.count(F.lit(1))})


def same_set(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Rows that only one of two single-column tables has."""
    x, y = a.toDF("v").distinct(), b.toDF("v").distinct()
    return _told(x.exceptAll(y).unionByName(y.exceptAll(x)), {name: F.count(F.lit(1))})


def report(*parts: DataFrame) -> DataFrame:
    """All rules with ``passed``."""
    return reduce(DataFrame.unionByName, parts).select("rule", (F.col("violations") == 0).alias("passed"), "violations")


def transition_rules(timed: DataFrame) -> DataFrame:
    """Legality of a timeline (see lifecycle): what recovers had failed, what reappears was missing, numbers never fall."""
    has = lambda e: F.array_contains("events", e)
    return row_rules(
        timed,
        recovered_after_failure=has("detail_fetch_recovered") & ~F.coalesce(F.col("previous_state") == "fetch_failed", F.lit(False)),
        reappeared_after_absence=has("reappeared") & ~F.coalesce(F.col("previous_state").isin("temporarily_missing", "long_absent"), F.lit(False)),
        missing_only_if_not_seen=has("temporarily_missing") & (F.col("kind") != "missing"),
        versions_from_one=(F.col("semantic_version") < 1) | (F.col("extraction_revision") < 1),
    )


def monotone(df: DataFrame, name: str, key: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value is below the one before them in their key."""
    from pyspark.sql import Window

    before = F.lag(value).over(Window.partitionBy(key).orderBy(*order))
    return _told(df.select((F.col(value) < before).alias("__broken")), {name: F.count_if("__broken")})


def derived_ids(df: DataFrame, name: str, expected: Column, actual: str) -> DataFrame:
    """Rows whose id isn't what its parts give."""
    return _told(df.select((~F.col(actual).eqNullSafe(expected)).alias("__broken")), {name: F.count_if("__broken")})


def no_replay(events: DataFrame, notified: DataFrame, bootstrap_at: Column, name: str = "bootstrap_did_not_replay_history") -> DataFrame:
    """Notifications of events (``event_id, occurred_at``) that had happened by the time of the first evaluation, and events notified twice."""
    old = events.filter(F.col("occurred_at") <= bootstrap_at).select("event_id").distinct()
    replayed = notified.join(old, "event_id", "left_semi")
    return _told(replayed, {name: F.count(F.lit(1))}).unionByName(unique(notified, "notified_once", "event_id"))


# What a component may say at the end of a run.
FINAL_STATUSES = ("healthy", "degraded", "unhealthy", "not_applicable", "unknown")


def final_health(health: DataFrame, history: DataFrame, alert_reports: DataFrame, components: tuple[str, ...], step_components: dict[str, bool], keep: int) -> DataFrame:
    """Consistency of final health (one row per run: ``run_id, health_phase, is_final, overall_health``, components, outcomes of steps in ``<step>_outcome``).

    Its history (``run_id, health_phase, overall_health``) holds every final run once, with the same health, and no more
    than ``keep``; alert reports (``run_id``) exist for it; and each step's status is the one its outcome means.
    """
    from recordwatch.functions.classify import component_health, step_outcome

    any_of = lambda conditions: reduce(lambda a, b: a | b, conditions)
    expected = {k: component_health(step_outcome(F.col(f"{k}_outcome")), F.lit(critical)) for k, critical in step_components.items()}
    rows = row_rules(
        health,
        final_run_health_phase=~((F.col("health_phase") == "final") & F.col("is_final")),
        final_components_complete=any_of([F.col(c).isNull() for c in components]),
        final_component_statuses_valid=any_of([~F.col(c).isin(*FINAL_STATUSES) for c in components]),
        final_has_no_pending_components=any_of([F.col(c) == "pending_at_render_time" for c in components]),
        final_step_outcome_mapping_consistent=any_of([~F.col(k).eqNullSafe(F.when(e == "pending", "unknown").otherwise(e)) for k, e in expected.items()]),
    )
    now = health.select("run_id", F.col("overall_health").alias("__now"))
    stored = history.select("run_id", "overall_health").distinct()
    current = now.join(stored, "run_id", "left").select((~F.col("overall_health").eqNullSafe(F.col("__now"))).alias("__broken"))
    return report(
        rows,
        unique(history, "final_health_history_unique", "run_id"),
        row_rules(history, final_health_history_only_final=~F.col("health_phase").eqNullSafe(F.lit("final"))),
        _told(current, {"final_health_history_current_upserted": F.count_if("__broken")}),
        _told(history, {"final_health_history_retention": F.greatest(F.count(F.lit(1)) - keep, F.lit(0))}),
        _told(health.join(alert_reports.select("run_id"), "run_id", "left_anti"), {"final_alert_report_aligned": F.count(F.lit(1))}),
    )
