"""From fetched pages to records: discover candidates, cut them to size, read their pages, merge two readings, reuse the last success, or fall back to the page itself.

Fetching and rendering are not part of it: their results come as tables. Sources are a registry of a few rows; each
page is read by the rules of its source.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwatch.functions import classify as C
from recordwatch.functions import html as HT
from recordwatch.functions.ids import record_id
from recordwatch.functions.text import is_empty
from recordwatch.functions.urls import candidate_url
from recordwatch.operators import keyed, records, selection
from recordwatch.operators.lifecycle import view_complete
from recordwatch.operators.redirects import landed

#: Fields that two readings of a page are merged by, and the field whose source decides for each.
MERGED = {"title": "title", "published_at": "published_at", "date_text": "published_at", "modified_at": "modified_at", "summary": "summary", "evidence": "evidence"}


@dataclass(frozen=True)
class Source:
    """A watched site: its index page, where its items are, and what its pages are about."""

    source_id: str
    url: str
    root: str
    prefix: str
    canonical_host: str
    site: HT.Site = field(default_factory=HT.Site)
    word: str = ""
    incidental: tuple[str, ...] = ()
    direct: str = "$^"


def discover(index_pages: DataFrame, sources: list[Source], dom_links: DataFrame | None = None) -> DataFrame:
    """``source_id, url, title, evidence, origin, pos``: each candidate once, in the order of its first mention.

    ``index_pages``: ``source_id, html``; ``dom_links`` of rendered pages: ``source_id, pos, href, heading, text, context``.
    """
    # Links come before data, and what was rendered after both. A page is read once, and its links are dealt out, since one index page may hold all of them.
    # The number of parts is given, since they are few bytes, but much work.
    parts = int(index_pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = HT.page_rows(index_pages, "source_id", "both").repartition(parts, "source_id", "pos")
    found = read.withColumn("part", F.when(F.col("d") == "anchor", 0).otherwise(1))
    if dom_links is not None:
        told = dom_links.select("source_id", "pos", F.col("href").alias("a"), HT.dom_title(F.col("heading"), F.col("text")).alias("b"), F.col("context").alias("c"), F.lit("rendered_dom").alias("d"))
        found = found.unionByName(told.withColumn("part", F.lit(2)))
    address = F.coalesce(*[F.when(F.col("source_id") == s.source_id, candidate_url(F.col("a"), s.url, s.root, s.prefix, s.canonical_host)) for s in sources])
    # Exploded, not filtered: a filter would be pushed below and work out the address twice.
    told = F.explode(F.filter(F.array(address), lambda url: url.isNotNull())).alias("url")
    rows = found.select("source_id", told, F.col("b").alias("title"), F.col("c").alias("evidence"), F.col("d").alias("origin"), F.struct("part", "pos").alias("pos"))
    return keyed.merge_candidates(rows, ["source_id", "url"]).select("source_id", "url", "title", "evidence", "origin", "pos")


def merged_reading(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Two readings of each row (structs ``a`` and ``b`` of page features, either null) as one struct ``read`` with ``conflicts``; the better method wins a field, the first of equals."""
    of = lambda side, k: F.col(f"{side}.{k}")
    rank = lambda side, k: C.method_rank(F.element_at(of(side, "sources"), MERGED[k]))
    second = {k: ~is_empty(of(b, k)) & (is_empty(of(a, k)) | ((of(a, k) != of(b, k)) & (rank(b, k) > rank(a, k)))) for k in MERGED}
    second = {k: F.coalesce(c, F.lit(False)) for k, c in second.items()}
    differ = [F.when(~is_empty(of(a, k)) & ~is_empty(of(b, k)) & (of(a, k) != of(b, k)), F.lit(f"field_conflict:{MERGED[k]}")) for k in MERGED]
    source_of = {v: F.when(second[k], F.element_at(of(b, "sources"), v)).otherwise(F.element_at(of(a, "sources"), v)) for k, v in MERGED.items() if k != "date_text"}
    told = F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k in source_of]), F.array(*source_of.values())), lambda k, v: v.isNotNull())
    one = F.coalesce(a, b)
    both = F.struct(
        *[F.when(second[k], of(b, k)).otherwise(of(a, k)).alias(k) for k in MERGED], told.alias("sources"), (of(a, "complete") | of(b, "complete")).alias("complete"),
        (of(a, "unparsed_date") | of(b, "unparsed_date")).alias("unparsed_date"), of(b, "text_hash").alias("text_hash"), of(a, "blocks").alias("blocks"),
    )
    single = F.struct(*[one[k].alias(k) for k in (*MERGED, "sources", "complete", "unparsed_date", "text_hash", "blocks")])
    two = F.col(a).isNotNull() & F.col(b).isNotNull()
    # Exploded, so that what refers to the fields doesn't take the choice of each field into its own expressions.
    told = rows.withColumn("read", F.explode(F.array(F.when(two, both).otherwise(single))))
    return told.withColumn("conflicts", F.when(two, F.array_distinct(F.array_compact(F.array(*differ)))).otherwise(F.array().cast("array<string>")))


def extract(
    index_pages: DataFrame, details: DataFrame, sources: list[Source], catalog: DataFrame, existing: DataFrame, fetched_at: Column, most: int | None = 20, render: str = "auto", dom_links: DataFrame | None = None
) -> dict[str, DataFrame]:
    """``diagnostics`` of each candidate, the ``items`` (read now, reused, or the page itself for sources that gave none) and the ``views`` of the sources.

    ``details``: ``url, html, rendered_html, http_status, content_type`` of fetched pages, with ``final_url`` and ``n_redirects`` where
    fetches were followed (see ``redirects.followed``), so that those that end at the index or elsewhere are told; ``catalog``: the
    sources' names (see ``records.assembled``); ``existing``: stored items by ``id``, with the columns of new ones; ``dom_links``
    of rendered index pages (see :func:`discover`). A view is complete, and what it lacks may count as missing, if its page was there, gave
    candidates, and gave no more than ``most`` (None: all are taken).
    """
    sites = {s.source_id: s.site for s in sources}
    # Kept between the steps, since several parts of the result read them; executors that are lost work theirs out again.
    candidates = selection.truncated(discover(index_pages, sources, dom_links).persist(), ["source_id"], [F.col("pos")], most).persist()
    sized = details.withColumnRenamed("url", "__url").withColumns({"__bytes": F.octet_length("html"), "__blank": F.trim(F.coalesce("html", F.lit(""))) == ""})
    fetched = candidates.join(sized, F.col("url") == F.col("__url"), "left").drop("__url")
    keys = fetched.withColumn("key", F.concat_ws("|", "source_id", "url"))

    def read(html: str, way: str) -> DataFrame:
        got = HT.page_features(keys.filter(F.col(html).isNotNull()), "key", html, sites, "source_id", way).drop("source_id")
        return got.select(F.col("key").alias(f"{way}_key"), F.struct(*[c for c in got.columns if c != "key"]).alias(f"{way}_page"))

    static, rendered = read("html", "static"), read("rendered_html", "rendered")
    # Pages aren't carried along once they are read.
    rows = keys.drop("html", "rendered_html").join(static, F.col("key") == F.col("static_key"), "left").join(rendered, F.col("key") == F.col("rendered_key"), "left")
    ended = F.lit("inside")
    if "final_url" in details.columns:
        ended = F.coalesce(*[F.when((F.col("source_id") == s.source_id) & F.col("final_url").isNotNull(), landed(F.col("final_url"), s.url, s.root, s.prefix, s.canonical_host)) for s in sources], ended)
    no_page = C.fetch_error(
        F.lit(True), F.when(F.col("http_status").isNull(), "request_error"), ended, F.col("http_status"), F.col("content_type"), F.col("__bytes"), F.coalesce("__blank", F.lit(True))
    )
    error = F.coalesce(no_page, F.col("static_page.error"))
    rows = rows.withColumn("error", error).withColumn("render", C.render_decision(F.lit(render), F.col("error"), F.col("error").isNull()))
    rows = rows.withColumn("a", F.when(F.col("error").isNull(), F.col("static_page"))).withColumn("b", F.when(F.col("render") & F.col("rendered_page.error").isNull(), F.col("rendered_page")))
    told = merged_reading(rows, "a", "b").withColumn("final_error", F.when(F.col("read.complete"), F.lit(None).cast("string")).otherwise(F.coalesce(F.when(F.col("render"), F.col("rendered_page.error")), "error", F.lit("unknown_error"))))
    told = told.withColumn("id", record_id(F.col("source_id"), F.col("url")))
    known = existing.select(F.col("id").alias("__id")).distinct()
    told = told.join(known, F.col("id") == F.col("__id"), "left")
    status = F.when(F.col("final_error").isNull(), "success").when(F.col("__id").isNotNull(), "reused_previous_success").otherwise("failed")
    told = told.withColumn("final_status", status).persist()
    good = told.filter("final_status = 'success'").select("source_id", F.col("url").alias("canonical_url"), "read.*")
    word = reduce(lambda out, s: F.when(F.col("source_id") == s.source_id, C.relevance(F.col("title"), F.col("blocks"), s.word, s.incidental, s.direct) if s.word else F.lit("direct")).otherwise(out), sources, F.lit("unknown"))
    good = good.withColumn("relevance", word)
    fresh = records.assembled(good, catalog, fetched_at)
    failed = told.filter("final_status = 'reused_previous_success'").select(F.col("id").alias("__id"), F.col("final_error").alias("last_detail_error_type"))
    reused = existing.drop("last_detail_error_type").join(failed, F.col("id") == F.col("__id")).drop("__id").withColumns({"detail_fetch_status": F.lit("failed_this_run"), "current_run_data_reused": F.lit(True), "seen_in_current_index": F.lit(True)})
    items = fresh.withColumn("last_detail_error_type", F.lit(None).cast("string")).unionByName(reused, allowMissingColumns=True)
    empty = index_pages.select("source_id").join(items.select("source_id").distinct(), "source_id", "left_anti")
    page_level = empty.join(F.broadcast(catalog.select("source_id", F.col("name").alias("source_name"))), "source_id", "left").select(
        record_id(F.col("source_id"), F.lit("page")).alias("id"), "source_id", "source_name", F.lit("page").alias("record_scope"), F.lit("page_level").alias("extracted_level"), fetched_at.alias("fetched_at")
    )
    diagnostics = told.select("source_id", "id", F.col("url").alias("canonical_url"), F.col("origin").alias("discovery_method"), "overflow", "error", "render", "conflicts", "final_status", "final_error", *[c for c in ("final_url", "n_redirects") if c in rows.columns])
    found = candidates.groupBy(F.col("source_id").alias("__source")).agg(F.count(F.lit(1)).alias("candidate_count"), F.max("overflow").alias("__overflow"))
    views = index_pages.select("source_id", (F.trim(F.coalesce("html", F.lit(""))) != "").alias("reachable")).join(found, F.col("source_id") == F.col("__source"), "left")
    complete = view_complete(F.col("reachable"), F.coalesce("candidate_count", F.lit(0)) > 0, F.col("__overflow"), F.lit(False))
    views = views.select("source_id", "reachable", F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"), complete.alias("complete"))
    return {"diagnostics": diagnostics, "items": items.unionByName(page_level, allowMissingColumns=True), "views": views}
