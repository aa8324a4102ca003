"""Queries over stored pages: archives written and read, redirects followed, and sources read by extractors of their own."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwatch.functions import extractors as E
from recordwatch.operators import redirects as RD
from recordwatch.plans.catalog import query, table
from recordwatch.sources import shared, warc


def _responses(pages: DataFrame) -> DataFrame:
    """What fetching the pages gave: some have moved, some lead elsewhere or back to the index."""
    k = F.col("page_id")
    site = F.concat(F.lit("https://site"), k % 3, F.lit(".invalid/items"))
    leads = F.when(k % 5 == 0, F.concat(F.lit("/items/new-"), k)).when(k % 7 == 0, F.concat(F.lit("https://elsewhere.invalid/"), k)).when(k % 11 == 0, "/items")
    own = pages.select(F.concat(site, F.lit("/"), k).alias("url"), F.when(leads.isNull(), 200).when(k % 2 == 0, 301).otherwise(302).alias("status"), leads.alias("location"), F.when(leads.isNull(), F.col("html")).alias("html"))
    moved = pages.filter(k % 5 == 0).select(F.concat(site, F.lit("/new-"), k).alias("url"), F.when(k % 3 == 1, 404).otherwise(200).alias("status"), F.lit(None).cast("string").alias("location"), "html")
    index = pages.select(site.alias("url")).distinct().select("url", F.lit(200).alias("status"), F.lit(None).cast("string").alias("location"), F.lit("").alias("html"))
    return own.unionByName(moved).unionByName(index).select("url", "status", "location", F.lit("text/html; charset=utf-8").alias("content_type"), F.lit(datetime(2026, 1, 1)).cast("timestamp").alias("fetched_at"), "html")


@query("""
    WITH p AS (SELECT page_id, html, 'https://site' || page_id % 3 || '.invalid/items' AS site, page_id % 5 = 0 AS moved, page_id % 5 <> 0 AND page_id % 7 = 0 AS away, page_id % 5 <> 0 AND page_id % 7 <> 0 AND page_id % 11 = 0 AS back FROM pages)
    SELECT page_id, CASE WHEN moved THEN site || '/new-' || page_id WHEN away THEN 'https://elsewhere.invalid/' || page_id WHEN back THEN site ELSE site || '/' || page_id END AS final_url, (moved OR away OR back)::INT AS n_redirects,
           CASE WHEN away THEN NULL WHEN moved AND page_id % 3 = 1 THEN 404 ELSE 200 END AS http_status, CASE WHEN away THEN 'outside' WHEN back THEN 'index' ELSE 'inside' END AS landed, CASE WHEN NOT away THEN sha256(CASE WHEN back THEN '' ELSE html END) END AS html_sha256 FROM p
""")
def page_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to an archive and read from it again, their redirects followed, and where they ended."""
    warc.register(spark)
    folder, pages = shared.folder(spark, "pages"), table(spark, sf_dir, "pages").select("page_id", "html")
    _responses(pages).write.format("warc").mode("append").save(folder)
    asked = pages.select("page_id", F.concat(F.lit("https://site"), F.col("page_id") % 3, F.lit(".invalid/items/"), "page_id").alias("url"))
    got = RD.followed(asked, spark.read.format("warc").load(folder))
    ended = [F.when(F.col("page_id") % 3 == k, RD.landed(F.col("final_url"), f"https://site{k}.invalid/items", f"site{k}.invalid", "/items/", f"site{k}.invalid")) for k in range(3)]
    return got.select("page_id", "final_url", "n_redirects", "http_status", F.coalesce(*ended).alias("landed"), F.sha2("html", 256).alias("html_sha256"))


@query()
def extractor_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index pages of three sources, each by its extractor as a table function, with keywords, headings and relatedness."""
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("site"), F.col("page_id") % 3).alias("source_id"), "html")
    registry = [E.Reading("site0", "https://www.site0.invalid/index", "Site 0", "context", ("the", "tion")), E.Reading("site1", "https://www.site1.invalid/index", "Site 1", "headings", ("the", "page")), E.Reading("site2", "https://www.site2.invalid/index", "Site 2", "headings", (), "the")]
    return E.candidates(pages, registry)
