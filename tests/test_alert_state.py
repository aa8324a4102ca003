"""Alerts as one automaton per key: counters with alerts, repeated and late runs, keys that vanish, states handed over."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordwatch.operators import alert_state as AS
from recordwatch.operators import alerts as AL

@pytest.fixture(autouse=True)
def without_compiling(spark):
    """Plans this large take longer to compile than these few rows take to go through them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")


START = datetime(2026, 1, 1)
SOURCE = "seq long, run_id string, started_at timestamp, source_id string, reachable boolean, complete boolean, candidate_count long"
RECORD = "seq long, run_id string, started_at timestamp, source_id string, record_id string, state string, streak long"


def at(hours):
    return START + timedelta(hours=hours)


def told(evaluation):
    return [(r.alert_key, r.run_id, r.action, r.severity_rank, r.consecutive) for r in evaluation.events.orderBy("seq", "alert_key").collect()]


def sources(spark, rows):
    return spark.createDataFrame([(k, run, at(h), "s", ok, whole, n) for k, (run, h, ok, whole, n) in enumerate(rows)], SOURCE)


def test_a_failing_record_opens_once_escalates_resolves_and_opens_again(spark):
    states = [("fetch_failed", 1, 0), ("fetch_failed", 2, 1), ("fetch_failed", 3, 24), ("active", 0, 48), ("fetch_failed", 1, 72)]
    rows = spark.createDataFrame([(k, f"r{k}", at(h), "s", "x", state, n) for k, (state, n, h) in enumerate(states)], RECORD)
    key = "detail_fetch_failed|s|x"
    assert told(AS.evaluate(AS.records(rows))) == [(key, "r0", "open", 1, 1), (key, "r1", "suppress", 1, 2), (key, "r2", "escalate", 2, 3), (key, "r3", "resolve", 2, 3), (key, "r4", "open", 1, 1)]


def test_a_resolved_collapse_needs_its_runs_again(spark):
    whole = [(f"r{k}", k, True, True, 20) for k in range(4)]
    rows = sources(spark, [*whole, ("a", 10, True, True, 1), ("b", 20, True, True, 1), ("c", 30, True, False, 1), ("d", 40, True, True, 1), ("e", 50, True, True, 1)])
    assert [x[1:] for x in told(AS.evaluate(AS.collapsed(rows)))] == [("b", "open", 1, 2), ("c", "resolve", 1, 2), ("e", "open", 1, 2)]


def test_a_run_evaluated_twice_counts_once(spark):
    rows = sources(spark, [("a", 0, False, True, 5), ("a", 0, False, True, 5), ("b", 1, False, True, 5), ("b", 1, False, True, 5)])
    got = AS.evaluate(AS.unreachable(rows))
    assert told(got) == [("source_unreachable|s|global", "a", "open", 1, 1), ("source_unreachable|s|global", "b", "escalate", 2, 2)]
    state = got.states.collect()[0]
    assert (state["count"], state.occurrence_count, state.cooldown_until) == (2, 2, at(25))
    runs = spark.createDataFrame([(k, run, at(h), 1, 3) for k, (run, h) in enumerate([("a", 0), ("a", 0), ("b", 1)])], "seq long, run_id string, started_at timestamp, success long, failed long")
    assert [x[1:3] for x in told(AS.evaluate(AS.success_rate(runs)))] == [("b", "open")]


def test_late_runs_are_left_out(spark):
    rows = sources(spark, [("a", 10, False, True, 5), ("old", 5, True, True, 5), ("b", 11, False, True, 5)])
    assert [x[1:3] for x in told(AS.evaluate(AS.unreachable(rows)))] == [("a", "open"), ("b", "escalate")]
    late = AS.in_time(AS.unreachable(rows), ("z", at(10.5)))
    assert {r.run_id: r.late for r in late.collect()} == {"a": True, "old": True, "b": False}
    again = AS.in_time(AS.unreachable(rows.filter("run_id = 'a'")), ("a", at(10)))
    assert [(r.late, r.repeated) for r in again.collect()] == [(False, True)]


def test_steps_and_models(spark):
    outcomes = [("a", "email_delivery_failed", "failed"), ("a", "project_audit_failed", "failure"), ("a", "transaction_failed", "skipped"), ("b", "email_delivery_failed", "success"), ("b", "project_audit_failed", "pending")]
    rows = spark.createDataFrame([(0 if run == "a" else 1, run, at(0 if run == "a" else 1), kind, status) for run, kind, status in outcomes], "seq long, run_id string, started_at timestamp, alert_type string, status string")
    assert [(k.split("|")[0], *x) for k, *x in told(AS.evaluate(AS.steps(rows)))] == [("email_delivery_failed", "a", "open", 1, 1), ("project_audit_failed", "a", "open", 3, 1), ("email_delivery_failed", "b", "resolve", 1, 1)]
    models = [("validation_failed", "failed")] * 3 + [("skipped_disabled", "not_run"), ("generated", "passed"), (None, None)]
    rows = spark.createDataFrame([(k, f"r{k}", at(24 * k), *m) for k, m in enumerate(models)], "seq long, run_id string, started_at timestamp, model_status string, validation_status string")
    assert [x[1:] for x in told(AS.evaluate(AS.validation(rows)))] == [("r0", "open", 1, 1), ("r1", "update", 1, 2), ("r2", "escalate", 2, 3), ("r4", "resolve", 2, 3)]


def test_keys_that_vanish_are_resolved_by_the_next_look_at_their_type(spark):
    rows = [(0, "a", at(0), "s", "x", "long_absent", 4), (1, "b", at(1), "s", "y", "active", 0), (2, "c", at(2), "s", "y", "active", 0), (3, "d", at(3), "s", "x", "long_absent", 5)]
    states = spark.createDataFrame(rows, RECORD)
    assert [(k, run, action) for k, run, action, *_ in told(AS.evaluate(AS.records(states)))] == [("long_absent|s|x", "a", "open"), ("long_absent|s|x", "b", "resolve"), ("long_absent|s|x", "d", "open")]
    opened = AS.evaluate(AS.records(states.filter("seq = 0"))).states
    steps = spark.createDataFrame([(5, "e", at(5), "email_delivery_failed", "passed")], "seq long, run_id string, started_at timestamp, alert_type string, status string")
    kept = AS.evaluate(AS.steps(steps), opened)
    assert told(kept) == [] and [r.alert_key for r in kept.states.collect()] == ["long_absent|s|x"]
    assert [x[2] for x in told(AS.evaluate(AS.records(states.filter("seq = 1")), opened))] == ["resolve"]


class Plain:
    """The rules, one evaluation after the other."""

    def __init__(self):
        self.count, self.open, self.last, self.out = {}, {}, None, []

    def evaluate(self, run, when, rows):
        if self.last and run != self.last[0] and when < self.last[1]:
            return
        again, current, kinds = bool(self.last and run == self.last[0]), {}, set()
        for r in rows:
            key = r["alert_key"]
            kinds.add(r["alert_type"])
            n = r["given"]
            if n is None and r["met"] is not None:
                same = key in self.open and self.open[key]["run"] == run if r["by_key"] else again
                n = self.count[key] = self.count.get(key, 0) + (not same) if r["met"] else 0
            if r["met"] and n >= r["open_at"]:
                current[key] = (r["high_rank"] if r["high_at"] is not None and r["high_if"] and n >= r["high_at"] else r["low_rank"], n)
        for key, (rank, n) in current.items():
            was = self.open.get(key)
            if was is None:
                self.open[key] = {"rank": rank, "n": n, "run": run, "until": when + timedelta(hours=24)}
                self.out.append((key, run, "open", rank, n))
                continue
            action = "escalate" if rank > was["rank"] else None if was["run"] == run else "update" if was["until"] <= when else "suppress"
            was |= {"rank": rank, "n": n, "run": run}
            if action in ("escalate", "update"):
                was["until"] = when + timedelta(hours=24)
            if action:
                self.out.append((key, run, action, rank, n))
        for key in [k for k in self.open if k not in current and k.split("|")[0] in kinds]:
            was = self.open.pop(key)
            self.count[key] = 0
            self.out.append((key, run, "resolve", was["rank"], was["n"]))
        self.last = (run, when)


def random_readings(spark, seed):
    rng = random.Random(seed)
    runs, h = [], 0
    for k in range(24):
        if runs and rng.random() < 0.25:
            runs.append(runs[-1])
        else:
            h += rng.choice([1, 9, 30])
            runs.append((f"r{k}", at(h - rng.choice([0] * 6 + [50]))))
    source_rows, state_rows = [], []
    for seq, (run, when) in enumerate(runs):
        for s in "abc":
            if rng.random() < 0.8:
                source_rows.append((seq, run, when, s, rng.random() < 0.6, rng.random() < 0.8, rng.choice([2, 9, 10, 11])))
        for record in "xyz":
            if rng.random() < 0.7:
                state_rows.append((seq, run, when, "abc"["xyz".index(record)], record, rng.choice(["active", "fetch_failed", "long_absent", "temporarily_missing"]), rng.randint(1, 4)))
    seen = spark.createDataFrame(source_rows, SOURCE)
    return AS.unreachable(seen).unionByName(AS.collapsed(seen)).unionByName(AS.records(spark.createDataFrame(state_rows, RECORD)))


def test_random_logs_against_the_rules_and_handed_over(spark):
    for seed in (2,):
        readings = random_readings(spark, seed).cache()
        by_seq = {}
        for r in readings.collect():
            by_seq.setdefault(r.seq, []).append(r.asDict())
        plain = Plain()
        for seq in sorted(by_seq):
            plain.evaluate(by_seq[seq][0]["run_id"], by_seq[seq][0]["started_at"], by_seq[seq])
        whole = AS.evaluate(readings)
        assert sorted(told(whole), key=str) == sorted(plain.out, key=str)
        assert {r.alert_key: (r.severity_rank, r["count"]) for r in whole.states.collect() if r.severity_rank is not None or r["count"]} == {
            k: (plain.open.get(k, {}).get("rank"), plain.count.get(k, 0)) for k in {*plain.open, *plain.count} if k in plain.open or plain.count[k]
        }
        states, last, out = None, None, []
        for low, high in ((0, 9), (9, 99)):
            part = readings.filter((F.col("seq") >= low) & (F.col("seq") < high))
            got = AS.evaluate(part, states, last)
            out += told(got)
            timely = AS.in_time(part, last).filter("not late").orderBy(F.desc("seq")).first()
            last = (timely.run_id, timely.started_at) if timely else last
            states = spark.createDataFrame(got.states.collect(), AS.STATE)
        assert sorted(out, key=str) == sorted(plain.out, key=str)
        readings.unpersist()


def test_event_ids_are_kept_once_in_the_order_of_the_first(spark):
    got = AS.evaluate(AS.unreachable(sources(spark, [("a", 0, False, True, 5), ("a", 0, True, True, 5), ("a", 0, False, True, 5), ("b", 1, True, True, 5)])))
    assert [x[1:3] for x in told(got)] == [("a", "open"), ("a", "resolve"), ("a", "open"), ("b", "resolve")]
    kept = AS.merged_events(got.events, 10).collect()
    assert [(r.run_id, r.action, r.position, r.seq) for r in kept] == [("b", "resolve", 3, 3), ("a", "resolve", 1, 1), ("a", "open", 0, 2)]
    assert AS.merged_events(got.events, 1).collect()[0].run_id == "b"
    related = spark.range(1).select(AL.alert_event_id(F.lit("r"), F.lit("k"), F.lit("notify"), F.lit("e1")).alias("x"), F.substring(F.sha2(F.lit("r|k|notify|e1"), 256), 1, 20).alias("y")).first()
    assert related.x == related.y


def test_nothing_to_evaluate(spark):
    none = AS.unreachable(sources(spark, [("a", 0, True, True, 5)])).limit(0)
    assert told(AS.evaluate(none)) == [] and AS.evaluate(none).states.collect() == []


def test_values_of_a_column_are_read_at_once_and_whole():
    import pyarrow as pa

    great = (1 << 53) + 1  # no float holds it
    assert AS._values(pa.array([great, None, 3])) == [great, None, 3] and AS._values(pa.array([great])) == [great]
    assert AS._values(pa.array([True, None])) == [True, None] and AS._values(pa.array(["a", None])) == ["a", None]


def test_stored_readings_are_not_written_again(spark, monkeypatch):
    written = []
    monkeypatch.setattr(AS, "settled", lambda df, whole=AS.settled: written.append(1) or whole(df))
    rows = AS.unreachable(sources(spark, [("a", 0, False, True, 5), ("b", 24, False, True, 5)])).localCheckpoint()
    first, n = told(AS.evaluate(rows)), len(written)
    assert told(AS.evaluate(rows, stored=True)) == first and len(written) - n == n - 1
