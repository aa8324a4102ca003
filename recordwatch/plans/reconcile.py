"""One run from observations to committed tables: merge, lifecycle, conditions, alerts, rules, all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwatch.functions.classify import SEVERITY, rank
from recordwatch.operators import alerts as AL
from recordwatch.operators import lifecycle as L
from recordwatch.operators import rules as Q
from recordwatch.sources.store import Store


def plan_run(log: DataFrame, policy: L.Policy = L.Policy()) -> dict[str, DataFrame]:
    """Tables that a log of observations gives: ``states, events, versions, conditions, rules``. Nothing is written."""
    timed = L.timeline(L.accepted_runs(log), policy)
    states = L.final_states(timed)
    rules = Q.report(Q.transition_rules(timed), Q.unique(L.events(timed), "event_ids_unique", "event_id"), Q.unique(states, "record_ids_unique", "record_id"))
    conditions = AL.lifecycle_conditions(states)
    return {"states": states, "events": L.events(timed), "versions": L.versions(timed), "conditions": conditions.withColumn("severity_rank", rank(F.col("severity"), SEVERITY)), "rules": rules}


def _must_hold(tables: dict[str, DataFrame]) -> None:
    broken = [r.rule for r in tables["rules"].filter(~F.col("passed")).collect()]
    if broken:
        raise ValueError(f"rules do not hold: {', '.join(broken)}")


def commit_run(store: Store, run_id: str, log: DataFrame, policy: L.Policy = L.Policy(), dry_run: bool = False) -> bool:
    """Plan a run over ``log``, write its tables and make them current if all rules hold on what was written."""
    return store.commit(run_id, plan_run(log, policy), _must_hold, dry_run=dry_run)
