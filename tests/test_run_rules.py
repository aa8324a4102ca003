"""Runs, records and pages by the rules that the operators promise: conditions, baselines, health, candidates, two readings of a page."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordwatch.functions import html as HT
from recordwatch.functions import urls as U
from recordwatch.operators import alerts as AL
from recordwatch.operators import conditions as CN
from recordwatch.operators import diff as D
from recordwatch.operators import health as H
from recordwatch.operators import keyed as K
from recordwatch.operators import records as RC
from recordwatch.operators import rules as Q
from recordwatch.plans import extraction as X

START = datetime(2026, 1, 1)
TEXT = "A made-up paragraph with enough words in it to serve as evidence of what a page says, and no real claim at all."
SITE = X.Source("site", "https://www.example.invalid/updates", "example.invalid", "/updates/", "example.invalid", HT.Site(("updates",), "Example"), "orbit", ("previously launched",), "orbit mission")


def actions(conditions):
    told = AL.machine(conditions.select("alert_key", "started_at", "run_id", "severity_rank"))
    return [(r.alert_key.split("|")[0], r.run_id, r.action, r.severity_rank) for r in told.orderBy("started_at", "alert_key").collect()]


def test_failing_details_open_are_suppressed_escalate_and_resolve(spark):
    states = [("fetch_failed", 1, 0), ("fetch_failed", 2, 1), ("fetch_failed", 3, 30), ("active", 0, 60), ("temporarily_missing", 1, 90), ("active", 0, 91), ("temporarily_missing", 1, 92)]
    rows = [(k, f"r{k}", START + timedelta(hours=h), "x", state, streak) for k, (state, streak, h) in enumerate(states)]
    got = actions(CN.records(spark.createDataFrame(rows, "seq long, run_id string, started_at timestamp, record_id string, state string, streak long")))
    failed = [(run, action, rank) for kind, run, action, rank in got if kind == "detail_fetch_failed"]
    assert failed == [("r0", "open", 1), ("r1", "suppress", 1), ("r2", "escalate", 2), ("r3", "resolve", 2)]
    assert [(run, action) for kind, run, action, _ in got if kind == "temporarily_missing"] == [("r4", "open"), ("r5", "resolve"), ("r6", "open")]


def test_sources_and_models_escalate_by_runs_in_a_row(spark):
    sources = spark.createDataFrame([(k, f"r{k}", START + timedelta(days=k), "s", ok, True, 5) for k, ok in enumerate([False, False, True, False])], "seq long, run_id string, started_at timestamp, source_id string, reachable boolean, complete boolean, candidate_count long")
    assert [x[1:] for x in actions(CN.unreachable(sources))] == [("r0", "open", 1), ("r1", "escalate", 2), ("r2", "resolve", 2), ("r3", "open", 1)]
    models = [("validation_failed", "failed")] * 3 + [("skipped_disabled", "not_run"), ("generated", "passed")]
    rows = spark.createDataFrame([(k, f"r{k}", START + timedelta(days=k), *m) for k, m in enumerate(models)], "seq long, run_id string, started_at timestamp, model_status string, validation_status string")
    assert [x[1:] for x in actions(CN.validation(rows, []))] == [("r0", "open", 1), ("r1", "update", 1), ("r2", "escalate", 2), ("r4", "resolve", 2)]


def test_steps_are_critical_where_integrity_is_at_stake(spark):
    rows = spark.createDataFrame([(1, "r", START, "mirror_sync_failed", "failed"), (1, "r", START, "output_validation_failed", "failed"), (1, "r", START, "email_delivery_failed", "skipped")], "seq long, run_id string, started_at timestamp, alert_type string, status string")
    assert {r.alert_type: r.severity_rank for r in CN.steps(rows).collect()} == {"mirror_sync_failed": CN.WARNING, "output_validation_failed": CN.CRITICAL}
    assert {r.alert_type for r in CN.observed_types(CN.steps(rows)).collect()} == {"mirror_sync_failed", "output_validation_failed"}


def test_collapsed_candidates_need_runs_in_a_row(spark):
    counts = [10, 10, 10, 4, 4, 10]
    rows = spark.createDataFrame([(k, f"r{k}", START + timedelta(days=k), "s", True, True, n) for k, n in enumerate(counts)], "seq long, run_id string, started_at timestamp, source_id string, reachable boolean, complete boolean, candidate_count long")
    assert [x[1:] for x in actions(CN.collapsed(rows))] == [("r4", "open", 1), ("r5", "resolve", 1)]


def test_first_evaluation_tells_nothing(spark):
    kinds = ["item_discovered", "semantic_content_changed", "extraction_improved", "detail_fetch_recovered", "reappeared", "extraction_degraded"]
    old, new = (spark.createDataFrame([(f"{n}{k}", t) for k, t in enumerate(kinds)], "event_id string, event_type string") for n in "on")
    none = old.limit(0)
    assert AL.notifications(old, none, initialized=False).count() == 0
    processed = AL.processed_after(old, none)
    told = AL.notifications(old.unionByName(new), processed)
    assert {(r.event_type, r.severity, r.category) for r in told.collect()} == {(t, *AL.NOTIFIED[t]) for t in kinds if t in AL.NOTIFIED} and told.count() == 5
    assert AL.notifications(new, AL.processed_after(new, processed)).count() == 0


ITEM = "id string, source_id string, reused boolean, fetched_at int, parser_version string, semantic_hash string, extraction_hash string, title string, published string, evidence string"


@pytest.mark.parametrize(
    "change,known,failed,previous,booted,expected",
    [
        ({"parser_version": "v2"}, True, False, None, True, ("unchanged", "improved", "parser_enrichment")),
        ({"parser_version": "v2", "published": "2026-01-01"}, True, False, None, True, ("unchanged", "improved", "parser_enrichment")),
        ({"parser_version": "v2", "title": "A TITLE: longer"}, True, False, None, True, ("unchanged", "improved", "parser_enrichment")),
        ({"parser_version": "v2", "title": "Other"}, True, False, None, True, ("changed", "unchanged", "semantic_content_changed")),
        ({"title": "Other"}, True, False, None, True, ("changed", "unchanged", "semantic_content_changed")),
        ({"evidence": "quite other words"}, True, False, None, True, ("changed", "unchanged", "semantic_content_changed")),
        ({"extraction_hash": "e2"}, True, False, None, True, ("unchanged", "improved", "parser_enrichment")),
        ({}, True, False, None, True, ("unchanged", "unchanged", "no_semantic_change")),
        ({}, False, False, "v0", True, ("unchanged", "improved", "parser_enrichment_discovery")),
        ({}, False, True, None, True, ("unchanged", "improved", "detail_failure_recovered")),
        ({}, False, False, None, True, ("new", "unchanged", "new_item")),
        ({}, True, False, None, False, ("baseline", "unchanged", "baseline_established")),
        ({"reused": True}, True, False, None, True, ("unchanged", "failed", "detail_fetch_failed_reused_previous_success")),
    ],
)
def test_baseline_changes(spark, change, known, failed, previous, booted, expected):
    item = {"id": "i", "source_id": "s", "reused": False, "fetched_at": 2, "parser_version": "v1", "semantic_hash": "h", "extraction_hash": "e", "title": "A title", "published": None, "evidence": "some words"}
    old = spark.createDataFrame([tuple(item.values())] if known else [], ITEM).withColumns({"content_hash": F.lit("h"), "first_seen_at": F.lit(1), "last_changed_at": F.lit(1)})
    failures = spark.createDataFrame([("i",)] if failed else [], "id string")
    sources = spark.createDataFrame([("s", booted, previous)], "source_id string, bootstrapped boolean, previous_parser_version string")
    r = D.baseline_changes(spark.createDataFrame([tuple((item | change).values())], ITEM), old, failures, sources, ["title", "published", "evidence"]).first()
    assert (r.change_status, r.extraction_change_status, r.change_reason) == expected
    assert r.first_seen_at == (1 if known else 2) and r.last_changed_at == (1 if known and expected[2] != "semantic_content_changed" else 2)


def test_health_in_two_phases(spark):
    step = {f"{name}_outcome": "success" for name in H.STEPS}
    base = {"run_id": "r", "health_phase": "final", "started_at": START, "finished_at": START + timedelta(seconds=60), "duration_given": None, "total_sources": 2, "reachable_sources": 2, "complete_sources": 2, "success": 3, "failed": 1, "stale": False, "attention_items": 0,
            "model_status": "skipped_disabled", "validation_status": "not_run", "open_warning": 0, "open_high": 0, "open_critical": 0, "latest_started_at": None, **step}
    changes = [{}, {"health_phase": "provisional"}, {"email_outcome": "failure"}, {"project_audit_outcome": "cancelled"}, {"mirror_sync_outcome": None}, {"duration_given": 1000.0}, {"open_high": 1}, {"open_critical": 1}, {"latest_started_at": START + timedelta(1)}, {"health_phase": "x"}, {"started_at": None}, {"success": 0, "failed": 0}, {"health_phase": "provisional", "email_outcome": "failure"}]
    schema = ", ".join(f"{k} {'timestamp' if k.endswith('_at') else 'double' if k == 'duration_given' else 'boolean' if k == 'stale' else 'int' if isinstance(v, int) else 'string'}" for k, v in base.items())
    rows = spark.createDataFrame([tuple((base | c).values()) for c in changes], schema).withColumn("n", F.monotonically_increasing_id())
    got = H.run_health(rows).orderBy("n").collect()
    assert [r.overall_health for r in got] == ["healthy", "healthy", "degraded", "unhealthy", "degraded", "degraded", "degraded", "unhealthy", "degraded", "unhealthy", "unhealthy", "degraded", "healthy"]
    assert [r.write_allowed for r in got] == [True] * 8 + [False] * 3 + [True] * 2
    assert (got[1].email, got[4].mirror_sync, got[0].duration_seconds, got[1].is_final) == ("pending_at_render_time", "unknown", 60.0, False)
    final = H.run_health(rows).filter("is_final and write_allowed").limit(1)
    checks = Q.final_health(final, final.select("run_id", "health_phase", "overall_health"), final.select("run_id"), (*H.INTERNAL, *H.STEPS), H.STEPS, 400)
    assert checks.filter("not passed").count() == 0


def test_candidates_by_the_rules_of_a_site(spark):
    at = lambda u: spark.range(1).select(U.candidate_url(F.lit(u), SITE.url, SITE.root, SITE.prefix, SITE.canonical_host).alias("v")).first().v
    assert at("/updates/x?utm_source=test") == "https://example.invalid/updates/x" and at("updates/../updates/./a/#top") == "https://example.invalid/updates/a"
    assert [at(u) for u in ("https://other.invalid/updates/x", "/updates/", "/media/example", "/updates/a.PDF", "mailto:a@b", "", "javascript:void(0)", "#top")] == [None] * 8
    html = """<li>All about <a href="/updates/one">One</a> here</li><a href="https://www.example.invalid/updates/one#x"></a>
        <script id="__NEXT_DATA__" type="application/json">{"items": [{"url": "/updates/two", "title": "Two"}, "/updates/three"]}</script>
        <script type="application/ld+json">{"@id": "/updates/one", "name": "Uno", "description": "a longer description of it"}</script>"""
    dom = spark.createDataFrame([("site", 0, "/updates/four", "", "Read more", "context of four")], "source_id string, pos int, href string, heading string, text string, context string")
    got = {r.url.rsplit("/", 1)[1]: (r.title, r.evidence, r.origin) for r in X.discover(spark.createDataFrame([("site", html)], "source_id string, html string"), [SITE], dom).collect()}
    assert got == {"one": ("One", "a longer description of it", "json_ld"), "two": ("Two", "", "embedded_json"), "three": ("", "", "embedded_json"), "four": ("", "context of four", "rendered_dom")}


def test_records_tell_where_fields_come_from():
    page = HT.read(f"<title>Named | Example site</title><meta name='date' content='soon'><article><h2>x</h2><p>On July 4, 2026 it began. {TEXT}</p></article>")
    found = HT.record(page, SITE.site)
    assert (found.title, found.date_text, found.published_at) == ("Named", "July 4, 2026", "2026-07-04T00:00:00+00:00")
    assert found.sources == {"title": "static_document_title", "published_at": "static_explicit_date", "summary": "static_article", "evidence": "static_article"} and found.complete
    bare = HT.record(HT.read("<body><h1>Title only</h1></body>"), SITE.site)
    assert not bare.complete and bare.published_at is None
    assert HT.record(HT.read(f"<h1>Updates</h1><p>{TEXT}</p>"), SITE.site).title == ""
    error = lambda html, rendered=False: HT.page_error(html, HT.read(html), HT.record(HT.read(html)), SITE.site, rendered)
    assert error("<p>Checking your browser</p>") == "blocked_or_challenge_page" and error('<div id="__next"></div>') == "javascript_shell" and error('<div id="__next"></div>', True) == "rendered_missing_required_fields"
    assert error(f"<p>{TEXT}</p>") == "missing_title" and error(f"<p>{TEXT}</p>", True) == "rendered_missing_title" and error("<h1>A heading that stands here</h1><p>too short to be evidence of it</p>") == "missing_evidence"
    assert error(f"<h1>Head</h1><p>captcha and access denied are words too. {TEXT}</p>") is None


def test_extraction_reads_renders_reuses_and_falls_back(spark):
    index = spark.createDataFrame([("site", "".join(f'<a href="/updates/{n}">Item {n}</a>' for n in "abcd")), ("void", "<p>nothing</p>")], "source_id string, html string")
    whole = f"<main><h1>Head</h1><p>{TEXT}</p></main>"
    address = "https://example.invalid/updates/"
    details = spark.createDataFrame([(address + "a", whole, None, 200, "text/html"), (address + "b", '<div id="root"></div><script></script>', whole, 200, "text/html"), (address + "c", whole, whole, 404, "text/html")], "url string, html string, rendered_html string, http_status int, content_type string")
    catalog = spark.createDataFrame([("site", "Site", "official", "a", "en"), ("void", "Void", "official", "a", "en")], "source_id string, name string, source_type string, reliability_tier string, language string")
    from recordwatch.functions.ids import record_id

    stored = spark.createDataFrame([("site", "old")], "source_id string, title string").select(record_id(F.lit("site"), F.lit(address + "c")).alias("id"), "source_id", "title")
    got = X.extract(index, details, [SITE, X.Source("void", "https://void.invalid/x", "void.invalid", "/x/", "void.invalid")], catalog, stored, F.lit("now"))
    told = {r.canonical_url[-1]: (r.final_status, r.final_error, r.render) for r in got["diagnostics"].collect()}
    assert told == {"a": ("success", None, False), "b": ("success", None, True), "c": ("reused_previous_success", "http_4xx", False), "d": ("failed", "request_error", False)}
    items = sorted((r.source_id, r.record_scope or "", r.title or "", r.relevance or "", bool(r.current_run_data_reused)) for r in got["items"].collect())
    assert items == [("site", "", "old", "", True), ("site", "item", "Head", "not_direct", False), ("site", "item", "Head", "not_direct", False), ("void", "page", "", "", False)]


def test_two_readings_are_merged_by_method(spark):
    shape = "title string, date_text string, published_at string, modified_at string, summary string, evidence string, sources map<string,string>, complete boolean, unparsed_date boolean, text_hash string, blocks array<string>"
    a = ("Static", None, None, None, "s", TEXT, {"title": "static_og_title", "summary": "static_meta_description", "evidence": "static_main"}, True, False, "h0", ["x"])
    b = ("Rendered", "2026", "2026-01-01", None, "s", "other " + TEXT, {"title": "rendered_h1", "published_at": "rendered_time", "summary": "rendered_h1", "evidence": "rendered_main"}, True, False, "h1", ["y"])
    rows = spark.createDataFrame([(1, a, b), (2, a, None), (3, None, b)], f"k int, a struct<{shape.replace(' ', ':').replace(',:', ', ')}>, b struct<{shape.replace(' ', ':').replace(',:', ', ')}>")
    got = {r.k: r for r in X.merged_reading(rows, "a", "b").collect()}
    assert (got[1].read.title, got[1].read.published_at, got[1].read.evidence, got[1].conflicts) == ("Rendered", "2026-01-01", TEXT, ["field_conflict:title", "field_conflict:evidence"])
    assert got[1].read.sources["title"] == "rendered_h1" and got[1].read.sources["evidence"] == "static_main"
    assert got[2].read.title == "Static" and got[3].read.title == "Rendered" and got[3].conflicts == []


def test_running_maximum_over_sparse_numbers(spark):
    rows = [((k * 2654435761) % (1 << 40), (k * 31) % 101) for k in range(300)]
    got = {r.seq: r.max_before for r in K.running_max_before(spark.createDataFrame(rows, "seq long, v long"), "seq", "v", bits=2).collect()}
    best, expected = None, {}
    for seq, v in sorted(rows):
        expected[seq] = best
        best = v if best is None else max(best, v)
    assert got == expected
    assert K.running_max_before(spark.createDataFrame([], "seq long, v long"), "seq", "v").count() == 0


def test_views_of_reports(spark):
    manifest = spark.createDataFrame([("2026-W01", 1, "a"), ("2026-W02", 2, "b")], "iso_week string, n int, note string")
    week = spark.createDataFrame([("2026-W02", 20), ("2026-W03", 30)], "iso_week string, n int")
    assert {tuple(r) for r in RC.week_index(manifest, week).collect()} == {("2026-W01", 1, "a"), ("2026-W02", 20, "b"), ("2026-W03", 30, None)}
