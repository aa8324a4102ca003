"""Queries over items: their quality by source, their times, excerpts, fields and states; and a run as a whole."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwatch.functions import classify as C
from recordwatch.functions import html as HT
from recordwatch.functions import text as T
from recordwatch.functions import times as TM
from recordwatch.operators import aggregates as A
from recordwatch.operators import records as RC
from recordwatch.plans.catalog import query, table
from recordwatch.sources import files, shared


@query("""
    WITH i AS (SELECT source, doc_id AS k, CASE doc_id % 4 WHEN 0 THEN 'item_level' WHEN 1 THEN 'link_level' WHEN 2 THEN 'page_level' ELSE 'unknown' END AS level, CASE WHEN quality = 1 THEN 'high' WHEN quality = 0 THEN 'low' WHEN lang = 'en' THEN 'medium' ELSE 'unknown' END AS quality,
                      CASE WHEN doc_id % 5 = 0 THEN 0 ELSE (doc_id % 9) / 8.0 END AS confidence, doc_id % 6 AS links, doc_id % 3 = 0 AND doc_id % 20 <> 3 AS item FROM documents LEFT JOIN labels USING (doc_id)),
    s AS (SELECT source, round(avg(confidence), 2)::DOUBLE AS average_confidence, sum(links)::BIGINT AS candidate_links_total, count(*) FILTER (WHERE item) AS item_level_count, count(*) FILTER (WHERE NOT item) AS page_level_count, count(*) FILTER (WHERE item AND k % 2 = 0) AS a, count(*) FILTER (WHERE item AND k % 7 <> 0) AS b, count(*) FILTER (WHERE item AND k % 10 <> 9) AS c,
                 count(*) FILTER (WHERE item AND k % 4 = 1) AS d FROM i GROUP BY source),
    l AS (SELECT source, level, count(*) AS n FROM i GROUP BY ALL), q AS (SELECT source, quality, count(*) AS n FROM i GROUP BY ALL)
    SELECT source AS source_id, average_confidence, candidate_links_total, item_level_count, page_level_count, CASE WHEN item_level_count > 0 THEN round(a / item_level_count, 2) END AS title_completeness, CASE WHEN item_level_count > 0 THEN round(b / item_level_count, 2) END AS date_completeness,
           CASE WHEN item_level_count > 0 THEN round(c / item_level_count, 2) END AS evidence_completeness, CASE WHEN item_level_count > 0 THEN round(d / item_level_count, 2) END AS field_evidence_completeness,
           (SELECT arg_max(level, struct_pack(n := n, r := list_position(['unknown', 'page_level', 'link_level', 'item_level'], level))) FROM l WHERE l.source = s.source) AS dominant_level, (SELECT string_agg(level || ':' || n, ',' ORDER BY level) FROM l WHERE l.source = s.source) AS levels,
           (SELECT arg_max(quality, struct_pack(n := n, r := list_position(['unknown', 'low', 'medium', 'high'], quality))) FROM q WHERE q.source = s.source) AS dominant_quality, (SELECT string_agg(quality || ':' || n, ',' ORDER BY quality) FROM q WHERE q.source = s.source) AS qualities FROM s
""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, A2: quality of each source with histograms of levels and qualities, the mean and the shares to two digits."""
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    items = d.select(
        F.col("source").alias("source_id"), F.when(k % 4 == 0, "item_level").when(k % 4 == 1, "link_level").when(k % 4 == 2, "page_level").alias("extracted_level"), F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").when(F.col("lang") == "en", "medium").otherwise("").alias("source_quality"),
        F.when(k % 5 != 0, (k % 9) / 8).alias("extraction_confidence"), F.when(k % 6 > 0, F.array_repeat(F.lit("x"), (k % 6).cast("int"))).alias("candidate_links"), F.when((k % 3 == 0) & (k % 20 != 3), "item").otherwise("page").alias("record_scope"), F.when(k % 2 == 0, "t").otherwise("").alias("title"),
        F.when(k % 7 != 0, "2026").alias("published_at"), F.when(k % 10 != 9, "e").alias("evidence"), F.create_map(F.lit("title"), F.when(k % 4 == 1, "h1").otherwise(""), F.lit("evidence"), F.lit("main")).alias("field_evidence"),
    )
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",")
    found = A.quality_report(items)
    return found.select(*[c for c in found.columns if not c.endswith("_counts")], text("level_counts").alias("levels"), text("quality_counts").alias("qualities"))


@query("""
    SELECT event_id, strftime(CASE event_id % 5 WHEN 0 THEN ts WHEN 1 THEN ts + INTERVAL 1 HOUR WHEN 2 THEN ts - INTERVAL 2 HOUR WHEN 3 THEN ts::DATE::TIMESTAMP END, '%Y-%m-%d %H:%M:%S') AS at FROM events
""")
def record_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the time of a record, from the first of many fields that can be read as one; offsets, dates alone and fields that hold no time among them."""
    k, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    spelt = lambda t, end: F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(end))
    e = table(spark, sf_dir, "events").select(
        k, F.when(k % 5 == 0, spelt(ts, "Z")).when(k % 5 == 1, "not a time").when(k % 5 == 2, " ").alias("last_seen_at"), F.when(k % 5 == 1, spelt(ts, "-01:00")).alias("updated_at"), F.when(k % 5 == 2, spelt(ts, "+02:00")).alias("fetched_at"),
        F.lit("success").alias("detail_fetch_status"), F.when(k % 5 == 3, F.date_format(ts, "yyyy-MM-dd")).alias("last_detail_success_at"), F.lit(True).alias("current_run_data_reused"),
    )
    return e.select("event_id", F.date_format(TM.record_time(e.columns), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(r"""
    WITH d AS (SELECT doc_id, '|' || chr(10) || text AS t FROM documents), x AS (SELECT doc_id, t, trim(translate(t, chr(13) || chr(10), '  '), ' ') AS l, replace(regexp_replace(t, '\r?\n', ' ', 'g'), '|', '\|') AS c FROM d)
    SELECT doc_id, CASE WHEN length(t) > 60 THEN rtrim(substr(t, 1, 59), ' ') || '…' ELSE t END AS plain, CASE WHEN length(l) > 60 THEN rtrim(substr(l, 1, 59), ' ') || '…' ELSE l END AS line, CASE WHEN length(c) > 60 THEN rtrim(substr(c, 1, 59), ' ') || '…' ELSE c END AS cell FROM x
""")
def excerpt_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """excerpts as they stand, on one line, and for a table after escaping."""
    t = F.concat(F.lit("|\n"), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", T.excerpt(t, 60).alias("plain"), T.line_excerpt(t, 60).alias("line"), T.cell_excerpt(t, 60).alias("cell"))


@query("""
    SELECT o_orderkey, ((o_orderkey % 2 > 0)::INT + (o_orderkey % 3 > 0)::INT + (o_orderkey % 5 > 0)::INT + 1)::BIGINT AS n_filled FROM orders
""")
def filled_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """how many fields of a record are not empty; texts, lists and mappings without content are, the number 0 isn't."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k, F.when(k % 2 > 0, "x").otherwise("").alias("text"), F.array_repeat(F.lit(1), (k % 3).cast("int")).alias("list"), F.map_from_arrays(F.array_repeat(F.lit("k"), F.least(k % 5, F.lit(1)).cast("int")), F.array_repeat(F.lit(1), F.least(k % 5, F.lit(1)).cast("int"))).alias("mapping"), F.lit(0).alias("number"), F.lit(None).cast("string").alias("none"))
    return o.select("o_orderkey", T.n_filled(o, ["text", "list", "mapping", "number", "none"]).cast("long").alias("n_filled"))


@query("""
    SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'own' ELSE CASE WHEN doc_id % 2 = 0 THEN 'active' END END AS lifecycle_state, CASE WHEN doc_id % 3 > 0 THEN doc_id % 5 ELSE 0 END::BIGINT AS semantic_version, CASE WHEN doc_id % 3 > 0 THEN doc_id % 7 = 0 END AS attention_required,
           CASE WHEN doc_id % 3 > 0 THEN 'h' || doc_id % 4 ELSE 'old' END AS content_hash, CASE WHEN doc_id % 3 > 0 THEN 'h' || doc_id % 4 END AS semantic_content_hash, lang FROM documents
""")
def items_with_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with what their records' states say over their own fields, nulls too."""
    k = F.col("doc_id")
    items = table(spark, sf_dir, "documents").select(k.alias("id"), F.lit("own").alias("lifecycle_state"), F.lit(0).cast("long").alias("semantic_version"), F.lit("old").alias("content_hash"), "lang")
    states = table(spark, sf_dir, "documents").filter(k % 3 > 0).select(k.alias("record_id"), F.when(k % 2 == 0, "active").alias("lifecycle_state"), (k % 5).alias("semantic_version"), (k % 7 == 0).alias("attention_required"), F.concat(F.lit("h"), k % 4).alias("current_semantic_hash"))
    return RC.with_state(items, states).select("id", "lifecycle_state", "semantic_version", "attention_required", "content_hash", "semantic_content_hash", "lang")


@query()
def whole_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs from pages to committed tables; the second finds some pages told anew, some gone and some no longer listed."""
    from recordwatch.plans import extraction as X
    from recordwatch.plans import whole_run as W
    from recordwatch.sources.store import Store

    k = F.col("page_id")
    pages = table(spark, sf_dir, "pages").select(k, F.concat(F.lit("site"), k % 2).alias("source_id"), F.concat(F.lit("/items/"), k).alias("place"), "html")
    sources = [X.Source(f"site{n}", f"https://www.site{n}.invalid/items", f"site{n}.invalid", "/items/", f"site{n}.invalid", HT.Site(("item",))) for n in range(2)]
    catalog = spark.createDataFrame([(f"site{n}", f"Site {n}", "official", "a", "en") for n in range(2)], "source_id string, name string, source_type string, reliability_tier string, language string")
    link = F.concat(F.lit('<li><a href="'), F.col("place"), F.lit('">Item</a></li>'))
    listed = lambda df: df.groupBy("source_id").agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("html"))
    fetched = lambda html, status: pages.select(F.concat(F.lit("https://"), "source_id", F.lit(".invalid"), "place").alias("url"), html.alias("html"), F.lit(None).cast("string").alias("rendered_html"), status.alias("http_status"), F.lit("text/html").alias("content_type"))
    store = Store(spark, shared.folder(spark, "store"))
    W.run(store, "r1", datetime(2026, 1, 1), listed(pages), fetched(F.col("html"), F.lit(200)), sources, catalog, most=None)
    # Rendered, the index shows every other of the items that it doesn't list.
    dom = pages.filter(k % 10 == 0).select("source_id", k.cast("int").alias("pos"), F.col("place").alias("href"), F.lit("Rendered").alias("heading"), F.lit("Read more").alias("text"), F.lit("").alias("context"))
    anew = F.when(k % 7 == 0, F.concat(F.lit("<h1>Told anew</h1>"), "html")).otherwise(F.col("html"))
    W.run(store, "r2", datetime(2026, 1, 8), listed(pages.filter(k % 5 > 0)), fetched(anew, F.when(k % 13 == 0, 404).otherwise(200)), sources, catalog, most=None, dom_links=dom)
    return store.read("events").select("run_id", "record_id", "event_type", "state", "attention")


@query(r"""
    WITH o AS (SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::BIGINT AS record, o_orderkey AS k, o_orderstatus AS s FROM orders)
    SELECT doc, record, 'number' AS key, k::VARCHAR AS value FROM o UNION ALL SELECT doc, record, 'status', s || ': told' FROM o WHERE k % 3 > 0 UNION ALL SELECT doc, record, 'note', '' FROM o WHERE k % 5 = 0
""")
def markdown_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read back from the lines of Markdown reports; headings, prose and lines before the first record are none."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), k.alias("k"), F.concat_ws("\n", F.concat(F.lit("### Order "), k), F.lit("Some prose: not a value"), F.concat(F.lit("- number: "), k), F.when(k % 3 > 0, F.concat(F.lit("* status： "), "o_orderstatus", F.lit(": told"))), F.when(k % 5 == 0, "-  note :  ")).alias("part"))
    lines = o.select("doc", F.posexplode(F.split("part", "\n")).alias("n", "line"), "k").select("doc", (F.col("k") * 10 + F.col("n")).alias("pos"), "line")
    before = o.select("doc").distinct().select("doc", F.lit(-1).cast("long").alias("pos"), F.lit("- title: before any record").alias("line"))
    return files.markdown_records(lines.unionByName(before)).select("doc", "record", "key", "value")


@query(r"""
    SELECT c_custkey, c_custkey % 4 IN (0, 3) AS email_ok, CASE c_custkey % 3 WHEN 0 THEN 465 WHEN 1 THEN 587 END::BIGINT AS port, c_custkey % 3 <> 2 AS port_ok FROM customer
""")
def contact_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """addresses and ports of a mail setting, and whether they can be used."""
    k = F.col("c_custkey")
    mail = F.when(k % 4 == 0, F.concat(F.lit("c"), k, F.lit("@example.invalid"))).when(k % 4 == 1, "no address").when(k % 4 == 2, F.concat(F.lit("a b@"), k, F.lit(".invalid"))).otherwise("x@y.z")
    port = F.when(k % 3 == 0, " 465 ").when(k % 3 == 1, "587").otherwise("none")
    return table(spark, sf_dir, "customer").select("c_custkey", C.valid_email(mail).alias("email_ok"), T.optional_number(F.trim(port)).alias("port"), C.valid_port(F.trim(port)).alias("port_ok"))
