"""The lifecycle on streams: against the batch form, in several micro-batches, over late and repeated runs, restarted, and from an initial state."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordwatch.operators import lifecycle as L
from recordwatch.streaming import record_lives as RL

@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


SCHEMA = "seq long, run_seq long, run_id string, started_at timestamp, record_id string, seen boolean, complete boolean, failed boolean, facts string, detail double"
START = datetime(2026, 1, 1)
POLICY = L.Policy(absent_observations=2, absent_days=2)


def random_log(seed, n_runs=30):
    """Runs, some of them late or sent twice; every run sees some records."""
    rng = random.Random(seed)
    rows, seq = [], 0
    for run in range(n_runs):
        at = START + timedelta(hours=30 * run - rng.choice([0, 0, 0, 70]), minutes=run)
        complete = rng.random() < 0.8
        for record in "abcde":
            if rng.random() < 0.85:
                row = (run, f"r{run}", at, record, rng.random() < 0.6, complete, rng.random() < 0.3, rng.choice("xyz"), float(rng.randint(0, 3)))
                rows += [(seq, *row)] * rng.choice([1, 1, 2])
                seq += 1
    return rows


def batch(spark, rows):
    log = spark.createDataFrame(rows, SCHEMA).dropDuplicates(["run_id", "record_id"])
    found = L.events(L.timeline(L.accepted_runs(log), POLICY).filter(F.size("events") > 0))
    timed = L.timeline(L.accepted_runs(log), POLICY).select("seq", "record_id", "streak", "semantic_version", "extraction_revision")
    return sorted(tuple(map(str, r)) for r in found.join(timed, ["seq", "record_id"]).select("record_id", "run_id", "event_type", "previous_state", "state", "streak", "semantic_version", "extraction_revision").collect())


def listed(table):
    return sorted(tuple(map(str, r)) for r in table.select("record_id", "run_id", "event_type", "previous_state", "state", "streak", "semantic_version", "extraction_revision").collect())


def put(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def read(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_and_batch_agree_over_restarts(spark, tmp_path):
    rows = random_log(3)
    log, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    cuts = [0, len(rows) // 3, len(rows) // 3 + 20, len(rows)]
    for low, high in zip(cuts, cuts[1:]):
        put(spark, rows[low:high], log)
        got = RL.run_to_end(RL.record_lives(read(spark, log), POLICY), kept)
    expected = batch(spark, rows)
    assert listed(got) == expected and len(expected) > 40
    assert listed(RL.run_to_end(RL.record_lives(read(spark, log), POLICY), kept)) == expected


def test_stream_goes_on_from_the_states_of_a_batch(spark, tmp_path):
    rows = [r for r in random_log(5) if r[1] % 7 != 6]
    passed = {r.run_id for r in L.accepted_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    rows = [r for r in rows if r[2] in passed]
    old, new = [r for r in rows if r[1] < 14], [r for r in rows if r[1] >= 14]
    states = L.resume_states(spark.createDataFrame(old, SCHEMA).dropDuplicates(["run_id", "record_id"]), POLICY)
    put(spark, new, str(tmp_path / "log"))
    got = RL.run_to_end(RL.record_lives(read(spark, str(tmp_path / "log")), POLICY, initial=states), str(tmp_path / "kept"))
    new_runs = {r[2] for r in new}
    assert listed(got) == [x for x in batch(spark, rows) if x[1] in new_runs]


def test_a_timer_tells_a_long_absence_without_another_run(spark, tmp_path):
    days = {0: ("a", True), 1: ("a", False), 2: ("a", False), 9: ("b", True), 10: ("b", True)}
    rows = [(k, k, f"r{d}", START + timedelta(days=d), name, seen, True, False, "x", 1.0) for k, (d, (name, seen)) in enumerate(days.items())]
    for timer in (True, False):
        log = str(tmp_path / f"log{timer}")
        for row in rows:
            put(spark, [row], log)
        got = RL.run_to_end(RL.record_lives(read(spark, log), L.Policy(absent_observations=2, absent_days=5), delay="1 hour", absence_timer=timer), str(tmp_path / f"kept{timer}"))
        told = [(r.event_type, r.run_id, r.at) for r in got.filter("record_id = 'a'").orderBy("at").collect()]
        absent = [("long_absence_reached", None, int((START + timedelta(days=6) - datetime(1970, 1, 1)).total_seconds() * 1_000_000))]
        assert [t[0] for t in told] == ["item_discovered", "temporarily_missing", *["long_absence_reached"] * timer]
        assert told[2:] == absent * timer


def test_events_sent_again_are_told_once(spark, tmp_path):
    kind = "event_id string, occurred_at timestamp"
    for part in ([("e1", START), ("e2", START)], [("e1", START), ("e3", START + timedelta(days=1)), ("e3", START + timedelta(days=1))]):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    got = RL.run_to_end(RL.events_once(stream, "10 days"), str(tmp_path / "kept"))
    assert sorted(r.event_id for r in got.collect()) == ["e1", "e2", "e3"]


def test_version_history_works_out_the_timeline_once(spark):
    from recordwatch.plans import stateful

    found = stateful.version_history(spark, "/root/testdata/sf0.001")
    assert not [f for f in found.inputFiles() if "events.parquet" in f]
    assert found.count() > 0 and found.select("version_id").distinct().count() == found.count()


def test_odd_values_come_through_and_no_batch_without_rows_follows(spark, tmp_path):
    odd = {"x": 'a "b"\n\\c', "y": "", "z": "é \U0001f600"}
    rows = [(*r[:8], odd[r[8]], r[9] if r[0] % 4 else None) for r in random_log(11, 12)]
    put(spark, rows, str(tmp_path / "log"))
    kept = spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled", None)
    got = RL.run_to_end(RL.record_lives(read(spark, str(tmp_path / "log")), POLICY), str(tmp_path / "timers"))
    one = RL.run_to_end(RL.record_lives(read(spark, str(tmp_path / "log")), POLICY), str(tmp_path / "kept"), timers=False)
    assert listed(one) == listed(got) == batch(spark, rows) and one.count() > 20
    assert [p.name for p in (tmp_path / "kept/state/commits").iterdir() if not p.name.startswith(".")] == ["0"]
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled", None) == kept
