"""Health of runs: trends, rates, worst-status rollups, phases and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COMPONENT = ("healthy", "degraded", "unhealthy")


def success_rate(success: Column, failed: Column) -> Column:
    """Share of successes, null if there was nothing."""
    return F.try_divide(success, success + failed)


def rolling_median(df: DataFrame, keys: list[str], order: list[str], value: str, usable: str, window: int) -> DataFrame:
    """``median_before``: median of the usable values among the last ``window`` rows before each row; null below three values.

    Rows are taken first and unusable ones dropped then, so a gap shortens the window.
    """
    over = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-window, -1)
    got = F.array_sort(F.collect_list(F.when(F.col(usable), F.col(value).cast("double"))).over(over))
    n = F.size("__v")
    half = F.floor(n / 2).cast("int")
    middle = F.when(n % 2 == 1, F.get("__v", half)).otherwise((F.get("__v", half - 1) + F.get("__v", half)) / 2)
    return df.withColumn("__v", got).withColumn("median_before", F.when(n >= 3, middle)).drop("__v")


def collapse_streak(df: DataFrame, keys: list[str], order: list[str], value: str, ratio: float) -> DataFrame:
    """``collapsed`` where the value is under that share of a positive median, and the number of rows in a row that are."""
    flag = F.coalesce((F.col("median_before") > 0) & (F.col(value) < F.col("median_before") * ratio), F.lit(False))
    by = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn("collapsed", flag).withColumn("__n", F.row_number().over(by))
    last_up = F.coalesce(F.max(F.when(~F.col("collapsed"), F.col("__n"))).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    return rows.withColumn("collapse_streak", (F.col("__n") - last_up).cast("long")).drop("__n")


def worst(rank: Column, order: tuple[str, ...] = COMPONENT) -> Column:
    """Name of the greatest rank."""
    return F.element_at(F.array(*[F.lit(o) for o in order]), F.coalesce(F.max(rank), F.lit(0)).cast("int") + 1)


def overall(components: DataFrame, keys: list[str], runtime: str | None = None, runtime_limit: float = 900.0) -> DataFrame:
    """Overall health of each run: its worst component; what is unknown at the end, or takes too long, degrades it."""
    rank = F.when(F.col("status") == "unhealthy", 2).when(F.col("status").isin("degraded", "unknown"), 1).otherwise(0)
    late = F.when(F.max(runtime) > runtime_limit, 1).otherwise(0) if runtime else F.lit(0)
    return components.groupBy(*keys).agg(F.element_at(F.array(*[F.lit(o) for o in COMPONENT]), F.greatest(F.max(rank), late).cast("int") + 1).alias("overall_health"))


def duration_seconds(started: Column, finished: Column, given: Column) -> Column:
    """Seconds of a run: what is given, else the difference, never below 0."""
    return F.coalesce(given, F.greatest(F.lit(0.0), (F.unix_micros(finished) - F.unix_micros(started)) / 1_000_000))


def upsert_history(history: DataFrame, record: DataFrame, keep: int) -> DataFrame:
    """Final records of runs, a run's row replaced where it stands, the last ``keep`` of them. Needs ``pos``."""
    from recordwatch.operators.keyed import union_last_value

    final = record.filter(F.coalesce("health_phase", F.lit("final")) == "final")
    old = history.withColumn("health_phase", F.coalesce("health_phase", F.lit("final")))
    return union_last_value([old, final], "run_id").orderBy(F.desc("position")).limit(keep)


#: Steps after the run itself, and whether their failure is critical; before the run's end all of them are pending.
STEPS = {"output_validation": True, "project_audit": True, "email": False, "mirror_sync": False, "workflow_core": True}
INTERNAL = ("source_collection", "candidate_discovery", "detail_extraction", "lifecycle", "summarizer")
RATE, RUNTIME_SECONDS = 0.5, 900.0


def run_components(runs: DataFrame, least_rate: float = RATE) -> DataFrame:
    """``runs`` with a column for the status of each component, and ``success_rate``.

    Needs ``health_phase, reachable_sources, complete_sources, total_sources, success, failed, stale, attention_items,
    model_status, validation_status`` and, for each of ``STEPS``, the outcome in a column of its name with ``_outcome``.
    """
    from recordwatch.functions.classify import component_health, step_outcome

    share = lambda n: F.when(F.col("total_sources") == 0, "unknown").when(F.col(n) == F.col("total_sources"), "healthy").otherwise("degraded")
    rate = success_rate(F.col("success"), F.col("failed"))
    off = F.col("model_status").isin("skipped_disabled", "disabled", "not_enabled")
    fine = (F.col("model_status") == "generated") & (F.col("validation_status") == "passed")
    provisional = F.col("health_phase") == "provisional"

    def step(name: str, critical: bool) -> Column:
        found = component_health(step_outcome(F.col(f"{name}_outcome")), F.lit(critical))
        # An outcome that still says pending at the end is as good as unknown.
        return F.when(provisional, "pending_at_render_time").otherwise(F.when(found == "pending", "unknown").otherwise(found))

    return runs.withColumns(
        {
            "success_rate": rate,
            "source_collection": share("reachable_sources"),
            "candidate_discovery": share("complete_sources"),
            "detail_extraction": F.when(rate.isNull(), "unknown").when(rate >= least_rate, "healthy").otherwise("degraded"),
            "lifecycle": F.when(F.col("stale") | (F.col("attention_items") > 0), "degraded").otherwise("healthy"),
            "summarizer": F.when(off | fine, "healthy").when(F.col("validation_status") == "failed", "degraded").otherwise("unknown"),
            **{name: step(name, critical) for name, critical in STEPS.items()},
        }
    )


def run_health(runs: DataFrame, least_rate: float = RATE, runtime_limit: float = RUNTIME_SECONDS) -> DataFrame:
    """Health of each run in its phase: :func:`run_components`, ``duration_seconds``, ``overall_health, is_final, write_allowed, warning``.

    Besides what components need: ``started_at, finished_at, duration_given, open_warning, open_high, open_critical`` and
    ``latest_started_at`` of all other runs. A run without valid times or phase is unhealthy and one that started before
    the latest is degraded; neither may be written, whatever its components say.
    """
    known = F.col("health_phase").isin("provisional", "final")
    timed = F.col("run_id").isNotNull() & F.col("started_at").isNotNull() & F.col("finished_at").isNotNull()
    late = F.coalesce(F.col("started_at") < F.col("latest_started_at"), F.lit(False))
    rows = run_components(runs, least_rate).withColumn("duration_seconds", duration_seconds(F.col("started_at"), F.col("finished_at"), F.when(F.col("duration_given").isNotNull(), F.greatest(F.lit(0.0), F.col("duration_given")))))
    every = [F.col(c) for c in (*INTERNAL, *STEPS)]
    some = lambda status: F.array_contains(F.array(*every), status)
    slow = F.col("duration_seconds") > runtime_limit
    doubtful = (F.col("open_high") > 0) | (F.col("open_warning") > 0) | ((F.col("health_phase") == "final") & some("unknown")) | some("degraded") | slow
    whole = F.when((F.col("open_critical") > 0) | some("unhealthy"), "unhealthy").when(doubtful, "degraded").otherwise("healthy")
    warning = F.when(~F.coalesce(known, F.lit(False)), "invalid_health_phase").when(~timed, "invalid_run_context").when(late, "stale_run_ignored").when(slow, "runtime_above_threshold")
    return rows.withColumns(
        {
            "warning": warning,
            "overall_health": F.when(F.coalesce(F.col("health_phase"), F.lit("")).isin("provisional", "final") & timed, F.when(late, "degraded").otherwise(whole)).otherwise("unhealthy"),
            "is_final": F.coalesce((F.col("health_phase") == "final") & timed, F.lit(False)),
            "write_allowed": F.coalesce(known & timed & ~late, F.lit(False)),
        }
    )


def alert_status(alerts: DataFrame, keys: list[str]) -> DataFrame:
    """``overall_alert_status`` of each run from its open conditions and its actions (``severity_rank, action``, null for open ones): suppressed actions don't count."""
    counts = F.max(F.when(F.coalesce(F.col("action") != "suppress", F.lit(True)), F.col("severity_rank")))
    name = F.when(counts >= 3, "critical").when(counts == 2, "high_attention").when(counts == 1, "attention").otherwise("normal")
    return alerts.groupBy(*keys).agg(name.alias("overall_alert_status"))
