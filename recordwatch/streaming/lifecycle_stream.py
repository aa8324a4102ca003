"""The life of a record, incrementally: one state per record, the rules of the batch form.

Observations come as a stream of the batch form's log. Those of runs that were ignored as a whole must be filtered
before; an observation that isn't later than the last one of its record is dropped here too.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from recordwatch.operators.lifecycle import Policy

OUT = "record_id string, run_id string, started_at timestamp, event_type string, previous_state string, state string, streak long, semantic_version long, extraction_revision long"
STATE = "state string, kind string, streak long, since timestamp, facts string, detail double, semantic_version long, extraction_revision long, last timestamp"


def step(was: tuple | None, row: tuple, policy: Policy) -> tuple[tuple | None, list[str], str | None]:
    """State after an observation (run_id, started_at, seen, complete, failed, facts, detail), its events, and the state before."""
    _, at, seen, complete, failed, facts, detail = row
    if was is None:
        return (("active", "ok", 1, at, facts, detail, 1, 1, at), ["item_discovered"], None) if seen else (None, [], None)
    state, kind, streak, since, old, level, version, revision, last = was
    now = "ok" if seen and not failed else "fail" if seen else "missing" if complete else None
    if now is None or at <= last:
        return was, [], state
    streak, since = (streak + 1, since) if now == kind else (1, at)
    events: list[str] = []
    if now != "missing" and state in ("temporarily_missing", "long_absent"):
        events.append("reappeared")
    if now == "ok":
        after = "active"
        if state == "fetch_failed":
            events.append("detail_fetch_recovered")
        if facts != old:
            events.append("semantic_content_changed")
            version += 1
        if detail is not None and level is not None and detail != level:
            events.append("extraction_improved" if detail > level else "extraction_degraded")
            revision += detail > level
        old, level = facts, detail
    elif now == "fail":
        after = "fetch_failed"
        events.append("detail_fetch_failed")
    else:
        absent = streak >= policy.absent_observations and (at - since).days >= policy.absent_days
        after = "long_absent" if absent else "temporarily_missing"
        if absent and state != "long_absent":
            events.append("long_absence_reached")
        if not absent and state not in ("temporarily_missing", "long_absent"):
            events.append("temporarily_missing")
    return (after, now, streak, since, old, level, version, revision, at), events, state


def lifecycle_stream(log: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Events of a stream of observations, in append mode; the state of a record is a few values, kept by key."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        was = tuple(group.get) if group.exists else None
        out: list[tuple] = []
        rows = pd.concat(list(batches)).sort_values(["started_at", "seq"])
        for r in rows.itertuples(index=False):
            detail = None if pd.isna(r.detail) else float(r.detail)
            was, events, before = step(was, (r.run_id, r.started_at.to_pydatetime(), bool(r.seen), bool(r.complete), bool(r.failed), r.facts, detail), policy)
            out += [(key[0], r.run_id, r.started_at, e, before, was[0], was[2], was[6], was[7]) for e in events]
        if was is not None:
            group.update(was)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    return log.groupBy("record_id").applyInPandasWithState(run, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
