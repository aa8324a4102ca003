"""A run as a whole, from fetched pages to tables that change together: collect, merge, lifecycle, versions, alerts, rules, one commit.

Everything a run needs of the past is read from the store's current tables; everything it makes is written beside them and
becomes current at once, if all rules hold on what was written. A run that is there already, or starts before the last one, changes
nothing, so a run may be repeated until it succeeds. Nothing but the last run's row, and the rules, reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwatch.operators import alert_state as AS
from recordwatch.operators import alerts as AL
from recordwatch.operators import keyed as K
from recordwatch.operators import lifecycle as L
from recordwatch.operators import lifecycle_step as LS
from recordwatch.operators import record_versions as RV
from recordwatch.operators import rules as Q
from recordwatch.plans import extraction as X
from recordwatch.plans.reconcile import _must_hold
from recordwatch.sources.shared import settled
from recordwatch.sources.store import Store

RUNS = "seq long, run_id string, started_at timestamp"
VIEWS = "seq long, run_id string, started_at timestamp, source_id string, reachable boolean, candidate_count long, complete boolean"
STATES = ("active", "temporarily_missing", "fetch_failed", "long_absent")
# Kinds of versions and of events.
VERSION_KINDS = ("initial_snapshot", "new_item", "semantic_change", "extraction_improvement")
EVENT_TYPES = ("lifecycle_initialized", "item_discovered", "semantic_content_changed", "extraction_improved", "extraction_degraded", "temporarily_missing", "long_absence_reached", "reappeared", "detail_fetch_failed", "detail_fetch_recovered", "stale_run_ignored")


@dataclass(frozen=True)
class Retention:
    """How many versions of a record, events and alert events stay, the last ones; None keeps all."""

    versions: int | None = None
    events: int | None = None
    alert_events: int | None = None


def run_order(store: Store, run_id: str, started_at: datetime) -> tuple[str, tuple[int, str, datetime] | None]:
    """``current``, ``duplicate`` or ``stale``, and the last run."""
    last = store.read("runs", RUNS).orderBy(F.desc("seq")).first()
    if last is None:
        return "current", None
    return ("duplicate" if last.run_id == run_id else "stale" if started_at <= last.started_at else "current"), tuple(last)


def merged_items(stored: DataFrame | None, now: DataFrame, views: DataFrame) -> DataFrame:
    """Stored items, unseen where their source's view was complete, with this run's items over them."""
    if stored is None:
        return now
    unseen = K.reset_unseen(stored, views.filter("complete"), seen="seen_in_current_index")
    return K.upsert(unseen, now, "id")


def observations(items: DataFrame, lives: DataFrame, views: DataFrame, run: tuple[int, str, datetime]) -> DataFrame:
    """This run's items as readings, and what the views of their sources say of the records that aren't among them."""
    seq, run_id, started_at = (F.lit(v).alias(c) for v, c in zip(run, ("seq", "run_id", "started_at")))
    whole = views.select(F.col("source_id").alias("__source"), "complete")
    facts = F.create_map(*[x for c in ("title", "published_at", "summary", "evidence") for x in (F.lit(c), F.col(c).cast("string"))])
    seen = items.filter(F.col("record_scope") == "item").join(whole, F.col("source_id") == F.col("__source"), "left").select(
        seq, run_id, started_at, F.col("id").alias("record_id"), "source_id", F.lit(True).alias("seen"), F.coalesce("complete", F.lit(False)).alias("complete"), (F.col("detail_fetch_status") != "success").alias("failed"),
        facts.alias("facts"), F.col("field_evidence").alias("evidence"), F.col("source_quality").alias("quality"), F.col("extraction_confidence").cast("double").alias("confidence"),
    )
    rest = lives.select("record_id", "source_id").join(seen.select("record_id"), "record_id", "left_anti").join(whole, F.col("source_id") == F.col("__source"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("facts", LS.MAP), ("evidence", LS.MAP), ("quality", "string"), ("confidence", "double"))]
    return seen.unionByName(rest.select(seq, run_id, started_at, "record_id", "source_id", F.lit(False).alias("seen"), "complete", F.lit(False).alias("failed"), *none))


def _rules(tables: dict[str, DataFrame], run_id: str) -> DataFrame:
    lives, versions, events = tables["lives"], tables["versions"], tables["events"]
    return Q.report(
        Q.row_rules(lives, states_known=~F.col("state").isin(*STATES), versions_from_one=(F.col("semantic_version") < 1) | (F.col("extraction_revision") < 1)), Q.unique(lives, "lives_unique", "record_id"),
        Q.unique(versions, "version_ids_unique", "version_id"), Q.row_rules(versions, version_kinds_known=~F.col("version_kind").isin(*VERSION_KINDS)),
        Q.unique(events, "event_ids_unique", "event_id"), Q.row_rules(events, event_types_known=~F.col("event_type").isin(*EVENT_TYPES)),
        Q.unique(tables["items"], "items_unique", "id"), Q.row_rules(tables["runs"].orderBy(F.desc("seq")).limit(1), last_run_is_this=F.col("run_id") != run_id), Q.refers(versions, "versions_have_lives", "record_id", lives, "record_id"),
    )


def plan(
    store: Store, run_id: str, started_at: datetime, index_pages: DataFrame, details: DataFrame, sources: list[X.Source], catalog: DataFrame, most: int | None = 20, render: str = "auto", dom_links: DataFrame | None = None,
    policy: L.Policy = L.Policy(), alerts: AS.Policy = AS.Policy(), retention: Retention = Retention(),
) -> dict[str, DataFrame] | None:
    """The tables that a run makes; None for a run that may not change anything. Inputs as for :func:`extraction.extract`."""
    order, last = run_order(store, run_id, started_at)
    if order != "current":
        return None
    spark = store.spark
    now = (1 if last is None else last[0] + 1, run_id, started_at)
    stamp = {c: F.lit(v) for v, c in zip(now, ("seq", "run_id", "started_at"))}
    stored = store.read("items") if "items" in store.current() else None
    known = stored if stored is not None else spark.createDataFrame([], "id string, source_id string, title string")
    found = X.extract(index_pages, details, sources, catalog, known.filter("record_scope = 'item'") if stored is not None else known, F.lit(started_at.isoformat()), most, render, dom_links)
    items, views, diagnostics = (settled(found[k]) for k in ("items", "views", "diagnostics"))
    lives = store.read("lives", LS.LIVES)
    done = LS.step(lives, observations(items, lives, views, now), policy)
    timed, after = settled(done.timed), settled(done.lives)

    new_events = L.events(timed).select("seq", "run_id", "started_at", "record_id", "event_type", "previous_state", "state", "attention", "event_id")
    old_events = store.read("events", ", ".join(f"{c} {t}" for c, t in new_events.dtypes))
    events = K.keep_last(old_events.unionByName(K.not_yet_stored(new_events, old_events, "event_id")), [F.desc("seq"), F.desc("event_id")], retention.events)
    new_versions = RV.versions(timed).withColumn("pos", F.struct("seq", "record_id"))
    old_versions = store.read("versions", ", ".join(f"{c} {t}" for c, t in new_versions.drop("pos").dtypes)).withColumn("pos", F.struct("seq", "record_id"))
    versions = RV.merged_versions(old_versions, new_versions, retention.versions).drop("position")

    told_views = views.withColumns(stamp | {"candidate_count": F.col("candidate_count").cast("long")}).select(*[c.split()[0] for c in VIEWS.split(", ")])
    history = store.read("views", VIEWS).unionByName(told_views)
    counts = diagnostics.agg(F.count_if(F.col("final_status") == "success").alias("success"), F.count_if(F.col("final_status") != "success").alias("failed")).withColumns(stamp)
    readings = AS.records(after.withColumns(stamp)).unionByName(AS.unreachable(told_views, alerts)).unionByName(AS.collapsed(history, alerts).filter(F.col("seq") == now[0])).unionByName(AS.success_rate(counts, alerts))
    evaluated = AS.evaluate(readings, store.read("alert_states", AS.STATE), None if last is None else (last[1], last[2]), alerts)
    alert_kind = ", ".join(f"{c} {t}" for c, t in evaluated.events.dtypes)
    alert_events = AS.merged_events(store.read("alert_events", alert_kind).unionByName(evaluated.events), retention.alert_events).drop("position")
    notified = AL.notifications(new_events, old_events, initialized=last is not None).select("event_id", "record_id", "event_type", "severity", "category", "run_id")

    tables = {
        "items": merged_items(stored, items, views), "diagnostics": diagnostics, "views": history, "lives": after, "events": events, "versions": versions, "alert_states": evaluated.states, "alert_events": alert_events, "notifications": notified,
        "runs": store.read("runs", RUNS).unionByName(spark.createDataFrame([now], RUNS)),
    }
    return tables | {"rules": _rules(tables, run_id)}


def run(store: Store, run_id: str, started_at: datetime, index_pages: DataFrame, details: DataFrame, sources: list[X.Source], catalog: DataFrame, dry_run: bool = False, **how) -> bool:
    """Plan a run, write its tables and make them current if all rules hold; False if nothing was changed."""
    tables = plan(store, run_id, started_at, index_pages, details, sources, catalog, **how)
    return tables is not None and store.commit(run_id, tables, _must_hold, dry_run=dry_run)
