"""Candidates of index pages as table functions, one for each way of reading a page, and the registry of who reads by which.

Each function gives ``pos, address, title, evidence, origin`` for a page and is joined laterally to it, so pages don't move. Addresses
are as the page has them; ``candidates`` makes them absolute, keeps those that belong to the source and merges them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from recordwatch.functions import html as HT
from recordwatch.functions.text import collapse, matched_keywords
from recordwatch.functions.urls import normalize, resolve
from recordwatch.operators.keyed import merge_candidates

FOUND = "pos int, address string, title string, evidence string, origin string"
MOST_TITLE, MOST_EVIDENCE = 180, 500


@udtf(returnType=FOUND)
class LinksInContext:
    """Links with the text of the part of the page around them, then whatever may be an address in embedded data."""

    def eval(self, html: str | None) -> Iterator[tuple]:
        page = HT.read(html)
        for pos, (address, title, evidence, origin) in enumerate([(*x, "anchor") for x in page.contexts()] + HT.json_candidates(page)):
            yield pos, address, title, evidence, origin


@udtf(returnType=FOUND)
class LinksWithHeadings:
    """Links with the heading of the area around them, then the described objects of linked and framework data."""

    def eval(self, html: str | None) -> Iterator[tuple]:
        page, pos = HT.read(html), 0
        for address, text, heading in page.headed_links():
            both = " ".join(x for x in (text, heading) if x)
            yield pos, address, text or heading, both[:MOST_EVIDENCE], "anchor"
            pos += 1
        for address, title, evidence, origin in HT.described(page):
            yield pos, address, title, evidence, origin
            pos += 1


EXTRACTORS = {"context": LinksInContext, "headings": LinksWithHeadings}


@dataclass(frozen=True)
class Reading:
    """How a source is read: its index address and name, the extractor, keywords, and what an address and its text must hold to belong to it (a regular expression)."""

    source_id: str
    url: str
    name: str = ""
    extractor: str = "headings"
    keywords: tuple[str, ...] = ()
    related: str = ""


def found(pages: DataFrame, registry: list[Reading], source: str = "source_id", html: str = "html") -> DataFrame:
    """``pages`` with the rows of their source's extractor; pages of sources that aren't registered have none."""
    out = None
    for name in sorted({r.extractor for r in registry}):
        own = pages.filter(F.col(source).isin(*[r.source_id for r in registry if r.extractor == name]))
        rows = own.lateralJoin(EXTRACTORS[name](F.col(html).outer()))
        out = rows if out is None else out.unionByName(rows)
    return out


def candidates(pages: DataFrame, registry: list[Reading], source: str = "source_id", html: str = "html") -> DataFrame:
    """``source_id, url, title, evidence, origin, keywords``: each address and title once, whatever their case, in the order of address and title.

    Of rows that agree in both, all keywords, the longest evidence and the first origin that isn't a link count. A link without
    text or heading takes the source's name.
    """
    rows = found(pages.select(F.col(source).alias("source_id"), F.col(html).alias("html")), registry).drop("html")
    each = []
    for r in registry:
        own = rows.filter(F.col("source_id") == r.source_id)
        given = F.when(~F.trim("address").rlike(r"(?i)^(mailto|tel|javascript|data):|^#?$"), F.trim("address"))
        url = normalize(resolve(given, r.url))
        title = F.coalesce(F.nullif(collapse(F.col("title")), F.lit("")), F.lit(r.name))
        told = own.withColumns({"url": url, "evidence": F.coalesce(F.nullif(F.col("evidence"), F.lit("")), title), "title": F.substring(title, 1, MOST_TITLE), "title_key": F.lower(title)})
        words = matched_keywords(F.concat_ws(" ", "url", "title", "evidence"), list(r.keywords)) if r.keywords else F.array().cast("array<string>")
        told = told.filter(F.col("url").isNotNull() & (F.col("title") != "") & F.concat_ws(" ", "url", "evidence").rlike(f"(?i){r.related}"))
        each.append(told.withColumn("keywords", words))
    all_of = each[0]
    for part in each[1:]:
        all_of = all_of.unionByName(part)
    return merge_candidates(all_of, ["source_id", "url", "title_key"]).select("source_id", "url", "title", "evidence", "origin", "keywords")
