"""Runs from pages to tables that change together, and the lifecycle a run at a time against the whole log."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordwatch.operators import lifecycle as L
from recordwatch.operators import lifecycle_step as LS
from recordwatch.operators import record_versions as RV
from recordwatch.plans import extraction as X
from recordwatch.plans import whole_run as W
from recordwatch.sources.store import Store

START = datetime(2026, 1, 1)
TEXT = "A made-up paragraph with enough words in it to serve as evidence of what a page says, and no claim at all."
SITES = [X.Source("s", "https://www.a.invalid/news", "a.invalid", "/news/", "a.invalid")]


@pytest.fixture(autouse=True)
def without_compiling(spark):
    """Plans this large take longer to compile than these few rows take to go through them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame([("s", "S", "official", "a", "en")], "source_id string, name string, source_type string, reliability_tier string, language string")


def inputs(spark, listed, pages):
    """An index page that lists some items, and the pages that were fetched: title, or a status."""
    index = spark.createDataFrame([("s", "".join(f'<li><a href="/news/{k}">Item {k}</a></li>' for k in listed))], "source_id string, html string")
    rows = [(f"https://a.invalid/news/{k}", f"<h1>{t}</h1><main><p>{TEXT}</p></main>" if isinstance(t, str) else "gone", None, 200 if isinstance(t, str) else t, "text/html") for k, t in pages.items()]
    return index, spark.createDataFrame(rows, "url string, html string, rendered_html string, http_status int, content_type string")


def test_runs_from_pages_to_one_commit(spark, tmp_path, catalog, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    go = lambda n, listed, pages, **how: W.run(store, f"r{n}", START + timedelta(days=n), *inputs(spark, listed, pages), SITES, catalog, **how)
    told = lambda n: sorted((r.event_type, names[r.record_id]) for r in store.read("events").filter(F.col("run_id") == f"r{n}").collect())
    assert go(1, "abc", {"a": "One", "b": "Two", "c": "Three"})
    names = {r.id: r.canonical_url[-1] for r in store.read("items").collect()}
    assert told(1) == [("item_discovered", k) for k in "abc"] and store.read("notifications").count() == 0

    assert go(2, "ab", {"a": "One, told anew", "b": 404})
    assert told(2) == [("detail_fetch_failed", "b"), ("semantic_content_changed", "a"), ("temporarily_missing", "c")]
    assert {(r.alert_type, r.severity_rank) for r in store.read("alert_states").filter("severity_rank is not null").collect()} == {("detail_fetch_failed", 1), ("temporarily_missing", 1)}
    assert {(r.event_type, r.severity) for r in store.read("notifications").collect()} == {("semantic_content_changed", "warning")}
    seen = {names[r.id]: (r.seen_in_current_index, r.title, r.detail_fetch_status) for r in store.read("items").collect()}
    assert seen == {"a": (True, "One, told anew", "success"), "b": (True, "Two", "failed_this_run"), "c": (False, "Three", "success")}

    before = store.current()
    assert not go(2, "ab", {"a": "Other"}) and not go(1.5, "ab", {"a": "Other"})
    with monkeypatch.context() as m:
        m.setattr(W, "STATES", ("active",))
        broken = {name: store.read(name) for name in ("lives", "versions", "events", "items", "runs")}
        with pytest.raises(ValueError, match="states_known"):
            store.commit("r3", broken | {"rules": W._rules(broken, "r2")}, W._must_hold)
    assert store.current() == before

    # More candidates than are taken: what isn't seen doesn't count as missing, what is seen counts.
    assert go(3, "cab", {"c": "Three"}, most=1)
    assert told(3) == [("reappeared", "c")] and [r.complete for r in store.read("views").orderBy("seq").collect()] == [True, True, False]
    assert go(4, "abc", {"a": "One", "b": "Two", "c": "Three"})
    assert told(4) == [("detail_fetch_recovered", "b"), ("semantic_content_changed", "a")]
    # "One" again is the first version again: it stands in its place, and no id is there twice.
    kinds = [(names[r.record_id], r.version_kind, r.semantic_version) for r in store.read("versions").orderBy("seq", "record_id").collect()]
    assert sorted(kinds) == [("a", "semantic_change", 2), ("a", "semantic_change", 3), ("b", "new_item", 1), ("c", "new_item", 1)]
    assert store.read("alert_states").filter("severity_rank is not null").count() == 0
    assert {r.state for r in store.read("lives").collect()} == {"active"} and store.read("runs").count() == 4


def test_no_event_is_left_out_unless_asked(spark, tmp_path, catalog):
    store, n = Store(spark, str(tmp_path / "store")), 2001
    go = lambda day, told, **how: W.run(store, f"r{day}", START + timedelta(days=day), *inputs(spark, range(n), {k: told for k in range(n)}), SITES, catalog, most=None, **how)
    count = lambda name: {r.run_id: r["count"] for r in store.read(name).groupBy("run_id").count().collect()}
    assert go(1, "One") and count("events") == {"r1": n} and count("versions") == {"r1": n}
    assert go(2, 404) and count("events") == {"r1": n, "r2": n} and count("alert_events")["r2"] >= n
    assert [r.complete for r in store.read("views").collect()] == [True, True]
    assert go(3, "One", retention=W.Retention(events=5, alert_events=3)) and count("events") == {"r3": 5} and store.read("alert_events").count() == 3


def test_versions_of_a_record_all_stay_unless_asked(spark):
    rows = [(n, f"v{n}", "a", n) for n in range(25)]
    new = spark.createDataFrame(rows, "pos long, version_id string, record_id string, seq long")
    assert RV.merged_versions(new.limit(0), new, None).count() == 25 and RV.merged_versions(new.limit(0), new, 20).count() == 20


def test_a_run_at_a_time_against_the_whole_log(spark):
    rng = random.Random(4)
    rows = []
    for n in range(6):
        for k in "vwxyz":
            if rng.random() < 0.85:
                facts = {"title": rng.choice(["a", "b"]), "summary": rng.choice(["", "short", "a short text"])} | ({"f.x": "1"} if rng.random() < 0.5 else {})
                rows.append((n, f"r{n}", START + timedelta(days=3 * n), k, "s", rng.random() < 0.65, rng.random() < 0.8, rng.random() < 0.3, facts, {"title": rng.choice(["", "h1"])}, rng.choice(["low", "high", None]), rng.choice([0.25, 0.5, None])))
    log = spark.createDataFrame(rows, LS.OBSERVED)
    policy = L.Policy(absent_observations=2, absent_days=5, failures_for_attention=2)
    shown = ["run_id", "record_id", "kind", "state", "previous_state", "streak", "since", "semantic_version", "extraction_revision", "attention", "events", "changed_fields", "improved_reasons", "degraded_reasons", "change_evidence", "previous_semantic_hash", "semantic_hash", "extraction_hash"]
    listed = lambda df: sorted(str(r) for r in df.select(*shown).collect())
    expected = listed(RV.timeline(log, policy))
    lives, got = spark.createDataFrame([], LS.LIVES), []
    for n in range(6):
        done = LS.step(lives, log.filter(F.col("seq") == n), policy)
        got += listed(done.timed)
        lives = spark.createDataFrame(done.lives.collect(), LS.LIVES)
    assert sorted(got) == expected and len(expected) > 12
    again = LS.step(lives, log.filter("seq = 5"), policy)
    assert again.timed.collect() == [] and sorted(map(str, again.lives.collect())) == sorted(map(str, lives.collect()))
