"""Stored pages in web archives, followed redirects, and extractors as table functions."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recordwatch.functions import extractors as E
from recordwatch.functions import html as HT
from recordwatch.operators import redirects as RD
from recordwatch.plans import extraction as X
from recordwatch.sources import warc

PAGE = "url string, status int, location string, content_type string, fetched_at timestamp, html string"
AT = datetime(2026, 1, 1)


def responses(spark, rows):
    return spark.createDataFrame([(u, s, loc, "text/html; charset=utf-8", AT, html) for u, s, loc, html in rows], PAGE)


@pytest.mark.parametrize("range_bytes", [64, 700, 1 << 20])
def test_archives_are_read_in_ranges(spark, tmp_path, range_bytes):
    warc.register(spark)
    tricky = "body with \r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n within, é \U0001f600"
    rows = [(f"https://a.invalid/{k}", 200 if k % 3 else 301, None if k % 3 else "/x", tricky if k % 5 == 0 else "p" * (k * 37) if k % 4 else "") for k in range(40)]
    responses(spark, rows).repartition(3).write.format("warc").mode("append").save(str(tmp_path / "archive"))
    got = spark.read.format("warc").option("rangeBytes", range_bytes).load(str(tmp_path / "archive"))
    assert sorted((r.url, r.status, r.location, r.html) for r in got.collect()) == sorted(rows, key=lambda r: r[0])
    assert {r.fetched_at for r in got.select("fetched_at").distinct().collect()} == {AT}
    heads = spark.read.format("warc").schema("status int, url string").option("rangeBytes", range_bytes).load(str(tmp_path / "archive"))
    assert heads.columns == ["status", "url"] and sorted(r.url for r in heads.filter("status = 301").collect()) == sorted(u for u, s, *_ in rows if s == 301)
    assert got.rdd.getNumPartitions() > 1 or range_bytes > 700


def test_empty_and_missing_archives(spark, tmp_path):
    warc.register(spark)
    assert spark.read.format("warc").load(str(tmp_path / "none")).collect() == []
    responses(spark, []).write.format("warc").mode("append").save(str(tmp_path / "empty"))
    assert spark.read.format("warc").load(str(tmp_path / "empty")).collect() == []


def test_redirects_are_followed_to_their_end(spark):
    rows = [("https://a.invalid/1", 301, "/2", ""), ("https://a.invalid/2", 302, "3?x=1", ""), ("https://a.invalid/3?x=1", 200, None, "end"), ("https://a.invalid/d/4", 301, "//b.invalid/", ""), ("https://b.invalid/", 404, None, "no"),
            ("https://a.invalid/5", 301, "https://a.invalid/6", ""), ("https://a.invalid/6", 301, "https://a.invalid/5", ""), ("https://a.invalid/7", 302, "https://c.invalid/unfetched", ""), ("https://a.invalid/8", 302, None, "")]
    asked = spark.createDataFrame([(u,) for u, *_ in rows[:1] + rows[3:4] + rows[5:]] + [("https://a.invalid/none",)] * 2, "url string")
    got = {r.url: (r.final_url, r.n_redirects, r.http_status, r.html) for r in RD.followed(asked, responses(spark, rows), hops=4).collect()}
    assert got["https://a.invalid/1"] == ("https://a.invalid/3?x=1", 2, 200, "end")
    assert got["https://a.invalid/d/4"] == ("https://b.invalid/", 1, 404, "no")
    assert got["https://a.invalid/5"] == ("https://a.invalid/5", 4, 301, "") and got["https://a.invalid/8"][1:3] == (0, 302)
    assert got["https://a.invalid/7"] == ("https://c.invalid/unfetched", 1, None, None) and got["https://a.invalid/none"] == ("https://a.invalid/none", 0, None, None)


def test_where_fetches_end_is_told_in_diagnostics(spark):
    site = X.Source("s", "https://www.a.invalid/news", "a.invalid", "/news/", "a.invalid")
    text = "A made-up paragraph with enough words in it to serve as evidence of what a page says, and no claim."
    page = f"<html><h1>Title</h1><main><p>{text}</p></main></html>"
    index = spark.createDataFrame([("s", "".join(f'<li><a href="/news/{k}">Item {k}</a></li>' for k in range(4))), ("t", " ")], "source_id string, html string")
    url = lambda k: f"https://a.invalid/news/{k}"
    fetched = responses(spark, [(url(0), 200, None, page), (url(1), 301, "/news", ""), ("https://a.invalid/news", 200, None, page), (url(2), 302, "https://b.invalid/x", ""), ("https://b.invalid/x", 200, None, page), (url(3), 302, "/news/new-3", ""), ("https://a.invalid/news/new-3", 200, None, page), (url(9), 200, None, page)])
    dom = spark.createDataFrame([("s", 0, "/news/9", "Rendered", "Read more", "around it")], "source_id string, pos int, href string, heading string, text string, context string")
    asked = spark.createDataFrame([(url(k),) for k in (0, 1, 2, 3, 9)], "url string")
    details = RD.followed(asked, fetched).withColumn("rendered_html", F.lit(None).cast("string"))
    catalog = spark.createDataFrame([("s", "S", "official", "a", "en")], "source_id string, name string, source_type string, reliability_tier string, language string")
    none = spark.createDataFrame([], "id string, source_id string, title string")
    got = X.extract(index, details, [site], catalog, none, F.lit("2026-01-01"), dom_links=dom)
    told = {r.canonical_url.rsplit("/", 1)[1]: (r.discovery_method, r.final_error, r.n_redirects) for r in got["diagnostics"].collect()}
    assert told == {"0": ("anchor", None, 0), "1": ("anchor", "redirect_to_index_page", 1), "2": ("anchor", "redirect_outside_allowed_domain", 1), "3": ("anchor", None, 1), "9": ("rendered_dom", None, 0)}
    assert {r.source_id: (r.reachable, r.candidate_count, r.complete) for r in got["views"].collect()} == {"s": (True, 5, True), "t": (False, 0, False)}
    few = X.extract(index, details, [site], catalog, none, F.lit("2026-01-01"), most=2)["views"]
    assert {r.source_id: r.complete for r in few.collect()} == {"s": False, "t": False}


DATA = {"@graph": [{"mainEntityOfPage": {"@id": "https://a.invalid/m/1"}, "headline": {"name": "Nested title"}, "description": "About it"}, {"url": "/m/2", "title": "Second"}, {"url": "/m/3"}]}
HTML = f"""
<div><h2>Outer</h2><ul><li><a href="/m/10"><b>First</b> link</a><h3>Inner heading</h3></li><li><a href="/m/11"></a></li></ul><a href="mailto:x@a.invalid">Mail</a></div>
<a href="/other/1">Elsewhere</a><section><p><a href="/m/2">SECOND</a></p><h4>Late</h4><h1>Later</h1></section><a href="/m/12"> </a>
<script type="application/ld+json">{json.dumps(DATA)}</script><script id="__NEXT_DATA__" type="application/json">{json.dumps({"props": [{"slug": "/m/2", "name": "second"}, {"path": "/m/4", "name": "Fourth", "summary": "kept orbit"}]})}</script>
<script type="application/ld+json">not json</script>
"""


def test_links_take_the_heading_of_their_area():
    page = HT.read(HTML)
    assert page.headed_links() == [("/m/10", "First link", "Inner heading"), ("/m/11", "", ""), ("mailto:x@a.invalid", "Mail", "Outer"), ("/other/1", "Elsewhere", ""), ("/m/2", "SECOND", "Late"), ("/m/12", "", "")]
    assert HT.described(page) == [("https://a.invalid/m/1", "Nested title", "Nested title About it", "json_ld"), ("/m/2", "Second", "Second", "json_ld"), ("/m/2", "second", "second", "next_data"), ("/m/4", "Fourth", "Fourth kept orbit", "next_data")]


def test_two_extractors_in_one_table(spark):
    pages = spark.createDataFrame([("a", HTML), ("b", HTML), ("c", HTML), ("a", None)], "source_id string, html string")
    registry = [E.Reading("a", "https://www.a.invalid/index", "Site A", "headings", ("orbit", "link"), "/m/"), E.Reading("b", "https://www.a.invalid/index", "Site B", "context", (), "/m/")]
    raw = E.found(pages, registry)
    page = HT.read(HTML)
    expected = [(*x, "anchor") for x in page.contexts()] + HT.json_candidates(page)
    assert [(r.address, r.title, r.evidence, r.origin) for r in raw.filter("source_id = 'b'").orderBy("pos").collect()] == expected
    merged = {(r.url, r.title): (r.evidence, r.origin, r.keywords) for r in E.candidates(pages, registry).filter("source_id = 'a'").collect()}
    at = "https://www.a.invalid/m/"
    assert merged == {
        (f"{at}10", "First link"): ("First link Inner heading", "anchor", ["link"]),
        (f"{at}11", "Site A"): ("Site A", "anchor", []),
        (f"{at}12", "Site A"): ("Site A", "anchor", []),
        (f"{at}2", "SECOND"): ("SECOND Late", "json_ld", []),
        ("https://a.invalid/m/1", "Nested title"): ("Nested title About it", "json_ld", []),
        (f"{at}4", "Fourth"): ("Fourth kept orbit", "next_data", ["orbit"]),
    }
    assert {r.source_id for r in E.candidates(pages, registry).collect()} == {"a", "b"}
