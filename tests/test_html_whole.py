"""Long pages keep all their links and blocks."""

from recordwatch.functions import html


def test_long_pages_are_read_to_the_end(spark):
    outside = "".join(f"<p>paragraph number {k} outside of main</p>" for k in range(2001))
    inside = "".join(f"<li><a href='/item/{k}'>link number {k} inside of main</a></li>" for k in range(2001))
    pages = spark.createDataFrame([(1, f"<body>{outside}<main>{inside}{inside}</main></body>")], "page_id long, html string")
    links = html.page_rows(pages, "page_id", "links").orderBy("pos").collect()
    assert [r.a for r in links] == [f"/item/{k}" for k in range(2001)] * 2
    blocks = html.page_rows(pages, "page_id", "blocks").orderBy("pos").collect()
    assert [r.a for r in blocks] == [f"link number {k} inside of main" for k in range(2001)]
    found = html.page_features(pages, "page_id").first()
    assert (found.n_links, found.n_blocks) == (4002, 2001)


def test_results_of_a_batch_are_handed_on_a_few_pages_at_a_time(spark):
    import pyarrow as pa

    from recordwatch.functions import html as HT

    parts = [b.num_rows for b in HT.few_at_a_time(iter([pa.RecordBatch.from_pydict({"k": list(range(150))}), pa.RecordBatch.from_pydict({"k": [1]})]))]
    assert parts == [64, 64, 22, 1] and max(parts) <= HT.AT_ONCE
    pages = spark.range(0, 150, 1, 1).selectExpr("id", "if(id % 2 = 0, concat('<h1>Title ', id, '</h1><p>a paragraph of more than twenty characters</p>'), null) AS html")
    rows = HT.page_features(pages, "id").select("id", "title", "sources").collect()
    assert [r.id for r in rows] == list(range(150)) and all(r.title == (f"Title {r.id}" if r.id % 2 == 0 else "") for r in rows)
    assert rows[0].sources["title"] == "static_h1" and rows[1].sources == {}
    assert [r.pos for r in HT.page_rows(pages, "id", "blocks").collect()] == [0] * 75


def test_a_page_is_worked_out_once_and_in_any_spelling_of_its_words(monkeypatch):
    calls = []
    flat = html._flat
    monkeypatch.setattr(html, "_flat", lambda parts, limit=None: calls.append(limit) or flat(parts, limit))
    page = "<main><p>A paragraph that is long enough to be a block of its own.</p></main>"
    assert html.features(page)[-2:] == (0, 1)
    assert calls.count(html.BLOCK_CHARS) == 1
    for notice in ("Please ENABLE  JavaScript", "javaſcript disabled", "JAVASCRİPT is required", "javascrıpt required"):
        assert html.NOTICE.search(notice) and html._asks_for_scripts(notice)
    assert not html._asks_for_scripts("javascript is fun") and not html._asks_for_scripts("enable it")
    assert html.prose_date("x 1, 2026, then MARCH 5,  2026.")[0] == "MARCH 5,  2026"
    assert html.prose_date("no 12, 345 date") == ("", None)


def test_index_pages_are_read_once_and_their_links_dealt_out(spark):
    from recordwatch.plans import extraction as X

    page = '<li><a href="/items/1">One</a></li><script type="application/ld+json">{"url": "/items/1", "name": "First"}</script><li><a href="/items/2">Two</a></li><a href="/else">No</a><script type="application/json">["/items/3"]</script>'
    pages = spark.createDataFrame([("s", page)], "source_id string, html string")
    found = X.discover(pages, [X.Source("s", "https://s.invalid/items", "s.invalid", "/items/", "s.invalid")])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = [(r.url.rsplit("/", 1)[1], r.title, r.origin, tuple(r.pos)) for r in found.orderBy("pos").collect()]
    assert got == [("1", "One", "json_ld", (0, 0)), ("2", "Two", "anchor", (0, 1)), ("3", "", "embedded_json", (1, 2))]
