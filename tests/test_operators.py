"""Operators and functions on small tables."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordwatch.functions import classify as C
from recordwatch.functions import html as HT
from recordwatch.functions import ids as I
from recordwatch.functions import text as T
from recordwatch.functions import times as TM
from recordwatch.functions import urls as U
from recordwatch.operators import alerts as AL
from recordwatch.operators import diff as D
from recordwatch.operators import health as H
from recordwatch.operators import keyed as K
from recordwatch.operators import references as R
from recordwatch.operators import report as RP
from recordwatch.operators import selection as S
from recordwatch.sources import files
from recordwatch.sources.store import Store


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "url,expected",
    [
        ("https://example.com/news/?utm_source=test#top", "https://example.com/news"),
        ("https://EXAMPLE.com/news", "https://example.com/news"),
        ("HTTPS://Example.com", "https://example.com"),
        ("https://example.com/a?a-b=1&a=1&x=%7e%2F+z&b", "https://example.com/a?a=1&a-b=1&b=&x=~%2F+z"),
        ("https://example.com:0443/", "https://example.com:443/"),
        ("https://example.com:x/", "https://example.com:x/"),
        ("https://example.com/a?x=50%&fbclid=1", "https://example.com/a?x=50%25"),
        ("https://example.com/a?b=2&a=1&UTM_Medium=x", "https://example.com/a?a=1&b=2"),
        ("https://example.com/?id=1", "https://example.com/?id=1"),
        ("https://User:Pass@Example.com:8080/x/", "https://User:Pass@example.com:8080/x"),
        ("not an address", "not an address"),
        (None, ""),
    ],
)
def test_normalized_urls(spark, url, expected):
    assert value(spark, U.normalize(F.lit(url).cast("string"))) == expected
    assert value(spark, U.normalize(U.normalize(F.lit(url).cast("string")))) == expected


def test_url_rules(spark):
    allowed = lambda u: value(spark, U.allowed(F.lit(u), ["example.invalid"], ["/updates/"], ["/updates"]))
    assert allowed("https://www.example.invalid/updates/one") and not allowed("https://other.invalid/updates/one")
    assert not allowed("https://example.invalid/updates/a.PNG") and not allowed("https://example.invalid/updates/")
    assert value(spark, U.strip_query(F.lit("/a/?x=1"), "https://h.invalid/b")) == "https://h.invalid/a"
    assert value(spark, U.excluded(F.lit("https://h.invalid/legal/x"), ["legal"]))


def test_text_functions(spark):
    assert value(spark, T.semantic_text(F.lit("a&amp;b  “ﬁne”–x \r\n y"))) == 'a&b "fine"-x y'
    assert value(spark, T.semantic_text_ascii(F.lit("“it’s”  so"))) == '"it\'s" so'
    assert value(spark, T.semantic_text(F.lit(None).cast("string"))) == ""
    assert value(spark, T.excerpt(F.lit("abcdef"), 4)) == "abc…" and value(spark, T.excerpt(F.lit("abcd"), 4)) == "abcd"
    assert value(spark, T.grows(F.lit("Short"), F.lit("a SHORT text"))) and not value(spark, T.grows(F.lit("x"), F.lit("x")))
    assert value(spark, T.truthy_or(F.lit(0), F.lit(5))) == 5
    assert value(spark, T.first_filled(F.lit(" "), F.lit(None).cast("string"), F.lit(" b "))) == "b"
    assert value(spark, T.has_secret(F.lit("key ghp_" + "a" * 24))) and not value(spark, T.has_secret(F.lit("ghp_short")))
    assert value(spark, T.table_cell(F.lit("a|b\nc"))) == "a\\|b c"
    assert value(spark, T.completeness(F.lit("a"), F.lit(""), F.lit(None))) == 1


def test_times(spark):
    assert value(spark, TM.parse(F.lit("2026-01-01T08:00:00+08:00"))) == datetime(2026, 1, 1)
    assert value(spark, TM.parse(F.lit("2026-01-01T00:00:00Z"))) == datetime(2026, 1, 1)
    assert value(spark, TM.parse(F.lit("soon"))) is None
    day = lambda s: F.lit(s).cast("timestamp")
    assert value(spark, TM.days_between(day("2026-01-01 12:00:00"), day("2026-01-16 11:00:00"))) == 14
    assert value(spark, TM.days_between(day("2026-01-02"), day("2026-01-01"))) == 0
    assert value(spark, TM.iso_week(day("2027-01-01"))) == "2026-W53"
    assert str(value(spark, TM.date_in_prose(F.lit("On March 5, 2026 it flew")))) == "2026-03-05"
    assert value(spark, TM.date_in_prose(F.lit("On March 35, 2026"))) is None


def test_ids(spark):
    a = value(spark, I.record_id(F.lit("s"), F.lit("u")))
    assert len(a) == 16 and a == value(spark, I.record_id(F.lit("s"), F.lit("u")))
    assert value(spark, I.alert_key(F.lit("t"), F.lit(None), F.lit(""))) == "t|global|global"
    assert value(spark, I.canonical_json(b=F.lit(None).cast("string"), a=F.lit("x"))) == '{"a":"x","b":null}'


def test_classes(spark):
    error = lambda valid=True, failure=None, landed="inside", status=200, kind="text/html", size=10, blank=False: value(spark, C.fetch_error(F.lit(valid), F.lit(failure).cast("string"), *[F.lit(x) for x in (landed, status, kind, size, blank)]))
    assert error() is None and error(valid=False, status=404) == "invalid_candidate_url" and error(failure="timeout") == "request_timeout" and error(failure="x") == "request_error"
    assert error(landed="index", status=500) == "redirect_to_index_page" and error(landed="outside") == "redirect_outside_allowed_domain" and error(status=404, kind="x") == "http_4xx" and error(status=503) == "http_5xx"
    assert error(kind="image/png", size=3_000_000) == "invalid_content_type" and error(size=3_000_000) == "response_too_large" and error(blank=True) == "empty_response"
    quality = lambda *a: tuple(value(spark, c) for c in C.parser_quality(*[F.lit(x) for x in a]))
    assert quality(False, 3, True, 100, 0) == ("low", 0.35) and quality(True, 3, True, 100, 0) == ("high", 0.9)
    assert quality(True, 2, False, 10, 0) == ("medium", 0.75) and quality(True, 0, False, 10, 0) == ("medium", 0.65) and quality(True, 4, True, 10, 0) == ("medium", 0.84)
    render = lambda mode, err, static: value(spark, C.render_decision(F.lit(mode), F.lit(err).cast("string"), F.lit(static)))
    assert [render("never", "missing_title", False), render("always", "http_4xx", False), render("always", None, True), render("auto", "javascript_shell", False), render("auto", "javascript_shell", True), render("auto", "http_5xx", False)] == [False, False, True, True, False, False]
    assert [value(spark, C.warning_category(F.lit(w))) for w in ("Bad date", "发布时间", "Field_conflict:Title", "other")] == ["unparsed_date", "unparsed_date", "field_conflict:title", "parser_warning"]
    assert [value(spark, C.method_rank(F.lit(m))) for m in ("static_json_ld_headline", "rendered_h1", "static_main", "static_meta_description", "", None)] == [5, 4, 3, 2, 1, 1]
    level = lambda *a: value(spark, C.candidate_level(*[F.lit(x) for x in a]))
    assert level("next_data", False, "t", "e" * 60) == "item_level" and level("embedded_json", False, "t", "e" * 60) == "link_level" and level("json_ld", True, "t", "e" * 60) == "link_level"
    assert value(spark, C.step_outcome(F.lit(" Canceled "))) == "cancelled" and value(spark, C.step_outcome(F.lit(None))) == "unknown"
    blocks = F.array(F.lit("the network grows"), F.lit("as seen with orbit before"))
    about = lambda title, b: value(spark, C.relevance(F.lit(title), b, "orbit", ("as seen with",), "targeting .* orbit"))
    assert about("Orbit news", blocks) == "direct" and about("x", blocks) == "incidental"
    assert about("x", F.array(F.lit("targeting a low orbit"))) == "direct" and about("x", F.array(F.lit("none"))) == "not_direct"
    later = F.array(*[F.lit(t) for t in ("a", "b", "c", "orbit at last")])
    assert about("orbital news", F.array(F.lit("none"))) == "unknown" and about("x", later) == "not_direct" and about("", F.array(F.lit("none"))) == "unknown"
    assert value(spark, C.rank(F.lit("HIGH"), C.QUALITY)) == 3 and value(spark, C.rank(F.lit("odd"), C.QUALITY)) == 0
    assert value(spark, C.valid_email(F.lit("a@b.cd"))) and not value(spark, C.valid_port(F.lit("70000")))


def test_upsert_and_retention(spark):
    old = spark.createDataFrame([(1, "a", "x", True), (2, "b", "y", True)], "id long, v string, keep string, seen boolean")
    new = spark.createDataFrame([(2, None, 7), (3, "c", 8)], "id long, v string, added int")
    got = {r.id: (r.v, r.keep, r.added) for r in K.upsert(old, new, "id").collect()}
    assert got == {1: ("a", "x", None), 2: (None, "y", 7), 3: ("c", None, 8)}
    once = K.upsert(old, new, "id")
    assert sorted(map(tuple, K.upsert(once, new, "id").select(once.columns).collect())) == sorted(map(tuple, once.collect()))
    reset = K.reset_unseen(old.withColumn("source_id", F.lit("s")), spark.createDataFrame([("s",)], "source_id string"))
    assert not reset.filter("seen").count()
    a = spark.createDataFrame([("k", 1, 0), ("", 9, 1), ("m", 2, 2)], "key string, v int, pos long")
    b = spark.createDataFrame([("k", 3, 0), (None, 9, 1)], "key string, v int, pos long")
    assert [(r.key, r.v) for r in K.union_last_value([a, b], "key").orderBy("position").collect()] == [("k", 3), ("m", 2)]
    assert K.keep_last(a, [F.desc("pos")], 2).count() == 2
    run = spark.createDataFrame([(k, (k * 37) % 11) for k in range(50)], "seq long, v long")
    assert all(r.max_before == max(((j * 37) % 11 for j in range(r.seq)), default=None) for r in K.running_max_before(run, "seq", "v", bits=3).collect())


def test_siblings_and_candidates(spark):
    rows = spark.createDataFrame([("k", 1, "old", None), ("k", 2, None, None), ("k", 3, "x", "full"), ("j", 1, None, "q")], "key string, t int, a string, b string")
    filled = {(r.key, r.t): (r.a, r.b) for r in K.fill_from_siblings(rows, ["key"], ["a", "b"], T.completeness(F.col("a"), F.col("b")), F.col("t")).collect()}
    assert filled[("k", 2)] == ("x", "full") and filled[("k", 1)] == ("old", "full") and filled[("j", 1)] == (None, "q")
    found = spark.createDataFrame([("u", 0, "", "short", ["b"], "anchor"), ("u", 1, "T", "much longer", ["a", "b"], "json_ld"), ("u", 2, "S", "mid", ["c"], "anchor")], "url string, pos long, title string, evidence string, keywords array<string>, origin string")
    r = K.merge_candidates(found, ["url"]).first()
    assert (r.title, r.evidence, r.keywords, r.origin) == ("T", "much longer", ["a", "b", "c"], "json_ld")


def test_diffs(spark):
    lit = lambda x: F.lit(x).cast("string")
    fields = {"title": (lit("a"), lit("b")), "summary": (lit("one"), lit("more than ONE")), "date": (lit(None), lit("x")), "place": (lit("x"), lit("")), "note": (lit(None), lit(""))}
    row = spark.range(1).select(*[c.alias(k) for k, c in D.semantic_diff(fields).items()], D.change_evidence(fields).alias("e")).first()
    assert (row.changed_fields, row.improved_fields, row.degraded_fields) == (["title"], ["date", "summary"], ["place"])
    assert {k: tuple(v) for k, v in row.e.items()} == {"title": ("a", "b")}
    maps = F.create_map(lit("a"), lit("1"), lit("b"), lit("2")), F.create_map(lit("a"), lit("1"), lit("c"), lit("3"))
    row = spark.range(1).select(*[c.alias(k) for k, c in D.map_diff(*maps).items()]).first()
    assert (row.changed_fields, row.improved_fields, row.degraded_fields) == ([], ["c"], ["b"])
    none = {k: F.array().cast("array<string>") for k in ("changed_fields", "improved_fields", "degraded_fields")}
    same = F.create_map(lit("title"), lit("h1"))
    out = D.extraction_diff(none, (same, same), (lit("low"), lit("high")), (F.lit(0.9), F.lit(0.8)))
    row = spark.range(1).select(*[c.alias(k) for k, c in out.items()]).first()
    assert (row.status, row.improved_reasons, row.degraded_reasons) == ("improved", ["source_quality"], ["extraction_confidence"])
    log = spark.createDataFrame([("s", 1, "h", False), ("s", 2, None, True), ("s", 3, "h", False), ("s", 4, "h", False), ("s", 5, "i", False)], "s string, t int, h string, failed boolean")
    status = lambda **k: [r.change_status for r in D.page_change(log, "s", ["t"], "h", "failed", **k).orderBy("t").collect()]
    assert status() == ["new", "failed", "new", "unchanged", "changed"]
    assert status(ignore_failures=True) == ["new", "failed", "unchanged", "unchanged", "changed"]
    states = [(False, True, False, False, True), (True, True, True, False, True), (True, False, False, True, False), (True, False, False, False, False), (True, True, False, False, True), (True, True, False, False, False)]
    assert [value(spark, D.baseline_status(*[F.lit(x) for x in s])) for s in states] == ["baseline", "unchanged", "unchanged", "new", "changed", "unchanged"]
    current = spark.createDataFrame([("a", True, None), ("b", True, None), ("c", False, "new")], "id string, failed boolean, title string")
    good = spark.createDataFrame([("a", "kept"), ("c", "old")], "id string, title string")
    assert {r.id: (r.title, r.reused) for r in D.reuse_last_success(current, good, "id", ["title"]).collect()} == {"a": ("kept", True), "b": (None, False), "c": ("new", False)}


def test_alert_machine(spark):
    start = datetime(2026, 1, 1)
    ranks = [(0, 1), (10, 1), (30, 1), (31, 2), (32, 1), (60, None), (61, None), (70, 1)]
    rows = [("k", start + timedelta(hours=h), f"r{h:03d}", r) for h, r in ranks] + [("k", start + timedelta(hours=10), "r010", 1)]
    seen = spark.createDataFrame(rows, "alert_key string, started_at timestamp, run_id string, severity_rank int")
    got = [(r.run_id, r.action) for r in AL.machine(seen).orderBy("run_id").collect()]
    assert got == [("r000", "open"), ("r010", "suppress"), ("r030", "update"), ("r031", "escalate"), ("r032", "suppress"), ("r060", "resolve"), ("r070", "open")]
    counts = AL.action_counts(AL.machine(seen)).first()
    assert (counts.n_open, counts.n_suppress, counts.severity_2) == (2, 2, 1)


def test_conditions(spark):
    steps = spark.createDataFrame([("transaction_failed", "failure"), ("email_delivery_failed", "cancelled"), ("output_validation_failed", "success"), ("sync", "skipped")], "alert_type string, outcome string")
    got = {r.alert_type: r.severity for r in AL.step_conditions(steps, ["transaction_failed", "output_validation_failed"]).collect()}
    assert got == {"transaction_failed": "critical", "email_delivery_failed": "warning", "output_validation_failed": None}


def test_health(spark):
    rows = [("s", k, n, u) for k, (n, u) in enumerate([(8, True), (8, True), (8, False), (8, True), (1, True), (1, True)])]
    m = H.rolling_median(spark.createDataFrame(rows, "s string, t int, n int, u boolean"), ["s"], ["t"], "n", "u", 8)
    got = [(r.median_before, r.collapse_streak) for r in H.collapse_streak(m, ["s"], ["t"], "n", 0.25).orderBy("t").collect()]
    assert got == [(None, 0), (None, 0), (None, 0), (None, 0), (8.0, 1), (8.0, 2)]
    parts = spark.createDataFrame([("a", "healthy", 10.0), ("a", "not_applicable", 10.0), ("b", "unknown", 1.0), ("c", "unhealthy", 1.0), ("d", "healthy", 901.0)], "run string, status string, secs double")
    assert {r.run: r.overall_health for r in H.overall(parts, ["run"], "secs").collect()} == {"a": "healthy", "b": "degraded", "c": "unhealthy", "d": "degraded"}
    history = spark.createDataFrame([("r1", None, 1, 0), ("r2", "final", 2, 1)], "run_id string, health_phase string, v int, pos long")
    new = spark.createDataFrame([("r1", "final", 9, 0), ("r3", "provisional", 5, 1)], "run_id string, health_phase string, v int, pos long")
    assert {(r.run_id, r.v) for r in H.upsert_history(history, new, 10).collect()} == {("r1", 9), ("r2", 2)}
    assert value(spark, H.success_rate(F.lit(0), F.lit(0))) is None


def test_references(spark):
    pairs = R.allowed_pairs(spark.createDataFrame([("a", "ua"), ("b", "ub"), ("", "x")], "id string, url string"), "id", "url")
    points = spark.createDataFrame([("p", ["a", "a", "zz", "zz", None], ["ua", "ub", "ub", "no"])], "point string, ids array<string>, urls array<string>")
    got = R.align(R.references(points, "point", "ids", "urls"), pairs)
    assert [(r.status, r.record_id) for r in got.orderBy("pos").collect()] == [("valid", "a"), ("url_repaired", "a"), ("id_repaired", "b"), ("invalid", None), ("invalid", None)]
    assert R.alignment_counts(got, ["point"]).first().verdict == "repaired"


def test_priority(spark):
    none = F.array().cast("array<string>")
    p = lambda change, events=none, attention=False, page="": value(spark, S.priority(F.lit(change), events, F.lit(attention), F.lit(page)))
    assert [p("new"), p("changed"), p("x", F.array(F.lit("detail_fetch_recovered"))), p("x", F.array(F.lit("reappeared"))), p("x", attention=True), p("baseline"), p("unchanged", page="changed"), p("unchanged"), p("x")] == list(range(9))


PAGE = """<html><head><title>Site</title><meta property="og:title" content="A title"><meta property="article:published_time" content="2026-02-03"></head>
<body><nav><p>navigation that is long enough</p></nav><main><h1>Head</h1><p>A first paragraph that is long enough to count as evidence.</p><p>A second one, with <a href="/x?y=1">a link</a> that people may follow.</p>
<p>short</p></main><script type="application/ld+json">{"itemListElement": [{"url": "/u", "name": "Named  item"}]}</script></body></html>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>Please enable JavaScript to go on</p><script>1</script>"), (3, ""), (4, None), (5, "<div><p>unclosed <b>tags")], "page_id long, html string")
    f = {r.page_id: r for r in HT.page_features(pages, "page_id").collect()}
    assert (f[1].title, f[1].sources["title"], f[1].published_at, f[1].error, f[1].complete) == ("Named item", "static_json_ld_name", "2026-02-03T00:00:00+00:00", "missing_evidence", False)
    assert (f[2].error, f[3].error, f[4].error) == ("javascript_shell", "empty_response", "empty_response")
    blocks = [r.a for r in HT.page_rows(pages, "page_id", "blocks").filter("page_id = 1").orderBy("pos").collect()]
    assert len(blocks) == 2 and blocks[0].startswith("A first")
    assert [(r.a, r.b) for r in HT.page_rows(pages, "page_id", "links").collect()] == [("/x?y=1", "a link")]
    assert [(r.a, r.b) for r in HT.page_rows(pages, "page_id", "json").collect()] == [("/u", "Named item"), ("/u", "")]
    assert pages.filter("page_id = 1").select(HT.title_native(F.col("html")).alias("t")).first().t == "Site"


def test_scans(spark, tmp_path):
    lines = tmp_path / "a.jsonl"
    lines.write_text('{"id": "1", "n": 2}\nnot json\n[1]\n\n{"id": "2", "n": 3}\n')
    assert {r.id for r in files.json_lines(spark, str(lines), "id string, n int").collect()} == {"1", "2"}
    assert files.json_lines_strict(spark, str(lines), "id string, n int").count() == 0
    lines.write_text('{"id": "1", "n": 2}\n{"id": "2", "n": 3}\n')
    assert files.json_lines_strict(spark, str(lines), "id string, n int").count() == 2
    document = tmp_path / "d.json"
    document.write_text(json.dumps({"items": {"a": {"v": 1}, "b": {"v": 2}}}))
    assert {(r.key, r.v) for r in files.keyed_document(spark, str(document), "items", "v int").collect()} == {("a", 1), ("b", 2)}
    assert files.keyed_document(spark, str(tmp_path / "none.json"), "items", "v int").count() == 0
    document.write_text("{broken")
    assert files.keyed_document(spark, str(document), "items", "v int").count() == 0
    text = "sources:\n- {id: a, enabled: true, url: u}\n- {id: b, enabled: false}\n- {id: c, enabled: true}\n"
    assert [r.id for r in files.catalog(spark, text).collect()] == ["a", "c"] and files.catalog(spark, text, "c").count() == 1
    with pytest.raises(ValueError):
        files.catalog(spark, "sources: 3")
    md = spark.createDataFrame([("d", k, x) for k, x in enumerate(["intro", "### one", "- key: value", "- 名：值", "### two", "- key: other"])], "doc string, pos int, line string")
    assert [(r.record, r.key, r.value) for r in files.markdown_records(md).orderBy("record", "key").collect()] == [(1, "key", "value"), (1, "名", "值"), (2, "key", "other")]


def test_store_is_all_or_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    one, two = spark.range(3), spark.range(5)
    assert store.read("items", "id long").count() == 0
    assert store.commit("r1", {"items": one, "events": two})
    assert not store.commit("r2", {"items": two}, dry_run=True) and not store.commit("r2", {"items": two}, allowed=False)

    def refuse(tables):
        raise ValueError("broken")

    with pytest.raises(ValueError):
        store.commit("r2", {"items": two, "events": one}, refuse)
    assert (store.read("items").count(), store.read("events").count()) == (3, 5)
    assert store.commit("r2", {"items": store.read("items").union(two.toDF("id"))})
    assert (store.read("items").count(), store.read("events").count()) == (8, 5)
    assert store.commit("r2", {"items": store.read("items")}) and store.read("items").count() == 8


def test_reports(spark):
    df = spark.createDataFrame([(2, "b|c"), (1, "a")], "k int, v string")
    assert RP.to_markdown(df, [F.col("k")]).split("\n") == ["| k | v |", "| --- | --- |", "| 1 | a |", "| 2 | b\\|c |"]
    text = "# T\n\n## A\n\nold\n\n## B\n\nkept\n"
    once = RP.upsert_section(text, "A", "new")
    assert "old" not in once and "kept" in once and RP.upsert_section(once, "A", "new") == once
    assert RP.upsert_section(text, "C", "x", before="B").index("## C") < text.index("## B") + 20


def test_a_run_is_committed_whole(spark, tmp_path):
    from recordwatch.operators import lifecycle as L
    from recordwatch.plans.reconcile import commit_run

    schema = "seq long, run_id string, started_at timestamp, record_id string, seen boolean, complete boolean, failed boolean, facts string, detail double"
    rows = [(k, f"r{k}", datetime(2026, 1, 1 + k), "x", True, True, k == 1, "a", 1.0) for k in range(3)]
    store = Store(spark, str(tmp_path / "runs"))
    log = spark.createDataFrame(rows, schema)
    assert not commit_run(store, "r", log, dry_run=True) and store.current() == {}
    assert commit_run(store, "r", log)
    assert store.read("states").first().state == "active" and store.read("events").count() == 3
    before = sorted(map(str, store.read("events").collect()))
    assert commit_run(store, "r", log) and sorted(map(str, store.read("events").collect())) == before
    fresh = L.initialize(log, store.read("states"), "r9", F.lit("2026-01-09"))
    assert fresh.count() == 0 and L.initialize(log, store.read("states").limit(0), "r9", F.lit("2026-01-09")).count() == 1


def test_core_records_ask_all_rows_in_view_for_items(spark):
    rows = [("a", True, "item", True), ("a", True, "page", True), ("b", None, "page", False), ("c", True, "item", False), ("c", True, "page", True), ("d", False, "item", True), ("d", True, "page", True), (None, True, "page", False), ("e", True, "item", None)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id long, source string, seen boolean, scope string, direct boolean")
    from recordwatch.operators import selection

    kept = selection.core_records(df, F.col("seen"), F.col("scope") == "item", "source", F.col("source").isin("a", "b", "c", "e"), F.col("direct"))
    # b has pages only and keeps them; c's only item isn't direct, so neither it nor its page stays; d's item is out of view.
    assert sorted(r.id for r in kept.collect()) == [0, 2, 6, 7]
