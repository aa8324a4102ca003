"""Scenarios of a record's life, through the batch form and through the stream."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recordwatch.operators import lifecycle as L
from recordwatch.streaming.lifecycle_stream import lifecycle_stream

SCHEMA = "seq long, run_id string, started_at timestamp, record_id string, seen boolean, complete boolean, failed boolean, facts string, detail double"

# month-day, seen, complete, failed, facts, detail
OK = (True, True, False)
MISSING = (False, True, False)
HIDDEN = (False, False, False)
FAILED = (True, True, True)
SCENARIOS = {
    "new_then_same": ([("01-01", *OK, "a", 1), ("01-02", *OK, "a", 1)], ["item_discovered"], "active"),
    "changed_then_same": ([("01-01", *OK, "a", 1), ("01-02", *OK, "b", 1), ("01-03", *OK, "b", 1)], ["item_discovered", "semantic_content_changed"], "active"),
    "improved_then_same": ([("01-01", *OK, "a", 1), ("01-02", *OK, "a", 2), ("01-03", *OK, "a", 2)], ["item_discovered", "extraction_improved"], "active"),
    "degraded": ([("01-01", *OK, "a", 2), ("01-02", *OK, "a", 1)], ["item_discovered", "extraction_degraded"], "active"),
    "long_absent": ([("01-01", *OK, "a", 1), ("01-08", *MISSING, None, None), ("01-15", *MISSING, None, None), ("01-22", *MISSING, None, None), ("01-29", *MISSING, None, None)], ["item_discovered", "temporarily_missing", "long_absence_reached"], "long_absent"),
    "not_long_enough": ([("01-01", *OK, "a", 1)] + [(f"01-1{k}", *MISSING, None, None) for k in range(6)], ["item_discovered", "temporarily_missing"], "temporarily_missing"),
    "index_incomplete": ([("01-01", *OK, "a", 1), ("01-08", *HIDDEN, None, None)], ["item_discovered"], "active"),
    "reappeared": ([("01-01", *OK, "a", 1), ("01-08", *MISSING, None, None), ("01-09", *OK, "a", 1)], ["item_discovered", "temporarily_missing", "reappeared"], "active"),
    "failed_then_recovered": ([("01-01", *OK, "a", 1), ("01-02", *FAILED, None, None), ("01-03", *FAILED, None, None), ("01-04", *FAILED, None, None), ("01-05", *OK, "a", 1)], ["item_discovered", *["detail_fetch_failed"] * 3, "detail_fetch_recovered"], "active"),
    "reappeared_and_changed": ([("01-01", *OK, "a", 1), ("01-08", *MISSING, None, None), ("01-09", *OK, "b", 1)], ["item_discovered", "temporarily_missing", "reappeared", "semantic_content_changed"], "active"),
    "recovered_and_changed": ([("01-01", *OK, "a", 1), ("01-02", *FAILED, None, None), ("01-05", *OK, "b", 1)], ["item_discovered", "detail_fetch_failed", "detail_fetch_recovered", "semantic_content_changed"], "active"),
    "first_seen_failing": ([("01-01", *FAILED, "a", 1), ("01-02", *FAILED, None, None)], ["item_discovered", "detail_fetch_failed"], "fetch_failed"),
    "missing_before_seen": ([("01-01", *MISSING, None, None), ("01-02", *OK, "a", 1)], ["item_discovered"], "active"),
    "failed_then_missing_then_seen": ([("01-01", *OK, "a", 1), ("01-02", *FAILED, None, None), ("01-03", *MISSING, None, None), ("01-04", *OK, "a", 1)], ["item_discovered", "detail_fetch_failed", "temporarily_missing", "reappeared"], "active"),
}


def log_of(spark, order=lambda rows: rows):
    rows = []
    for name, (observations, _, _) in SCENARIOS.items():
        for k, (day, seen, complete, failed, facts, detail) in enumerate(observations):
            rows.append((k, f"{name}-{k}", datetime.fromisoformat(f"2026-{day}"), name, seen, complete, failed, facts, None if detail is None else float(detail)))
    return spark.createDataFrame(order(rows), SCHEMA)


def listed(events):
    out = {}
    for r in events:
        out.setdefault(r.record_id, []).append(((r.started_at), r.event_type))
    return {k: [e for _, e in sorted(v, key=lambda x: x[0])] for k, v in out.items()}


@pytest.mark.parametrize("order", [list, lambda rows: rows[::-1]])
def test_scenarios_in_batch(spark, order):
    timed = L.timeline(log_of(spark, order))
    assert listed(L.events(timed).collect()) == {k: e for k, (_, e, _) in SCENARIOS.items()}
    states = {r.record_id: r for r in L.final_states(timed).collect()}
    assert {k: r.state for k, r in states.items()} == {k: s for k, (_, _, s) in SCENARIOS.items()}
    assert states["changed_then_same"].semantic_version == 2 and states["improved_then_same"].extraction_revision == 2
    needs = {r.record_id for r in timed.filter("attention").collect()}
    assert needs == {"failed_then_recovered"}
    kinds = {(r.record_id, r.version_kind) for r in L.versions(timed).collect()}
    assert ("recovered_and_changed", "semantic_change") in kinds and ("new_then_same", "new_item") in kinds


def test_scenarios_as_a_stream(spark, tmp_path):
    log_of(spark).coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "log"))
    query = lifecycle_stream(stream).writeStream.format("memory").queryName("lives").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = listed(spark.table("lives").collect())
    assert got == {k: e for k, (_, e, _) in SCENARIOS.items()}


def test_stale_and_repeated_runs_are_ignored(spark):
    days = {"r1": "02-01", "r2": "02-10", "r3": "02-01", "r4": "02-11", "r5": "02-11"}
    rows = [(k, run, datetime.fromisoformat(f"2026-{day}"), "x", True, True, False, run, 1.0) for k, (run, day) in enumerate(days.items())]
    kept = {r.run_id for r in L.accepted_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {"r1", "r2", "r4"}
    loose = {r.run_id for r in L.accepted_runs(spark.createDataFrame(rows, SCHEMA), strict=False).collect()}
    assert loose == {"r1", "r2", "r4", "r5"}


def test_replay_is_idempotent(spark):
    log = log_of(spark)
    once = L.events(L.timeline(log)).select("event_id").distinct()
    again = L.events(L.timeline(L.accepted_runs(log.filter(F.col("record_id") == "reappeared")))).select("event_id").distinct()
    assert again.exceptAll(once).count() == 0
