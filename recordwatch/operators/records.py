"""Records as rows: assembly from what a page gave, projections, and the small ordered views that reports show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.functions.classify import parser_quality
from recordwatch.functions.ids import content_hash, record_id
from recordwatch.functions.text import excerpt, is_empty

EVIDENCE_CHARS, LINKS = 800, 5
TITLE_CHARS, KEYWORDS = 160, 10


def projected(items: DataFrame, fields: list[str], lists: list[str]) -> DataFrame:
    """Only ``fields``, in that order, null where the table has none; evidence cut to 800 characters, missing ``lists`` empty."""

    def value(c: str) -> Column:
        got = F.col(c) if c in items.columns else F.lit(None).cast("array<string>" if c in lists else "string")
        if c == "evidence":
            return excerpt(got, EVIDENCE_CHARS)
        return F.coalesce(got, F.array().cast("array<string>")) if c in lists else got

    return items.select(*[value(c).alias(c) for c in fields])


def changed_items(items: DataFrame, restricted: Column, direct: Column) -> DataFrame:
    """Items that are new or changed; of restricted sources only those that are directly about the subject."""
    return items.filter((F.col("record_scope") == "item") & F.col("change_status").isin("new", "changed") & ~(restricted & ~F.coalesce(direct, F.lit(False))))


def aligned(health: DataFrame, alerts: DataFrame) -> DataFrame:
    """Final health of each run with its alert report, which counts only if it is of the same run; ``run_id`` is the key of both."""
    final = health.filter((F.col("health_phase") == "final") & F.col("is_final"))
    return final.join(alerts, "run_id", "left")


def link_payload(candidates: DataFrame, key: str, most: int = LINKS) -> DataFrame:
    """``key, links``: the first different addresses of each key by ``pos``, with titles and keywords cut.

    The first row of each address and then the first addresses are taken by windows that Spark limits within tasks.
    """
    rows = candidates.withColumn("url", F.trim("url")).filter(~is_empty(F.col("url")))
    once = rows.withColumn("__n", F.row_number().over(Window.partitionBy(key, "url").orderBy("pos"))).filter("__n = 1")
    first = once.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).filter(F.col("__n") <= most)
    link = F.struct("pos", F.substring("title", 1, TITLE_CHARS).alias("title"), "url", F.slice("matched_keywords", 1, KEYWORDS).alias("matched_keywords"))
    listed = first.groupBy(key).agg(F.array_sort(F.collect_list(link)).alias("x"))
    return listed.select(key, F.transform("x", lambda x: F.struct(x["title"].alias("title"), x["url"].alias("url"), x["matched_keywords"].alias("matched_keywords"))).alias("links"))


def in_order(states: DataFrame) -> DataFrame:
    """States by source and then id, both as text."""
    return states.orderBy(F.col("source_id").cast("string"), F.col("record_id").cast("string"))


def shown_alerts(alerts: DataFrame, most: int = 40) -> DataFrame:
    """Of the first ``most`` alerts by ``pos``, the first of each key, action and status."""
    first = alerts.orderBy("pos").limit(most)
    return first.withColumn("__n", F.row_number().over(Window.partitionBy("alert_key", "action", "status").orderBy("pos"))).filter("__n = 1").drop("__n")


def week_index(manifest: DataFrame, week: DataFrame) -> DataFrame:
    """The manifest with the rows of ``week`` in the place of those of the same ``iso_week``; other columns of either are kept, the new row wins."""
    from recordwatch.operators.keyed import upsert

    return upsert(manifest, week, "iso_week")


def assembled(parsed: DataFrame, sources: DataFrame, fetched_at: Column) -> DataFrame:
    """Item rows from what pages gave (see ``page_features``; with ``source_id, canonical_url, relevance``) and the catalog of sources.

    Only whole records become items; ids, hashes of facts and of extraction, quality and the states of a first success are set here.
    """
    rows = parsed.filter("complete").join(F.broadcast(sources.select("source_id", F.col("name").alias("source_name"), "source_type", "reliability_tier", "language")), "source_id", "left")
    evidences = F.size(F.filter(F.map_values("sources"), lambda v: ~is_empty(v)))
    traced = ~is_empty(F.col("canonical_url")) & ~is_empty(F.col("title")) & ~is_empty(F.col("evidence")) & ~is_empty(F.col("source_id"))
    quality, confidence = parser_quality(traced, evidences, F.col("published_at").isNotNull(), F.char_length("evidence"), F.col("unparsed_date").cast("int"))
    facts = content_hash(title=F.col("title"), published_at=F.col("published_at"), summary=F.col("summary"), evidence=F.col("evidence"))
    sourced = F.array_join(F.transform(F.array_sort(F.map_entries("sources")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    extraction = content_hash(facts=facts, sources=sourced, quality=quality)
    return rows.select(
        record_id(F.col("source_id"), F.col("canonical_url")).alias("id"), "source_id", "canonical_url", F.col("canonical_url").alias("url"), "source_name", "source_type", "reliability_tier", "language",
        "title", "published_at", F.col("date_text").alias("published_date_text"), "summary", "evidence", F.col("sources").alias("field_evidence"), F.col("relevance"),
        F.when(F.col("unparsed_date"), F.array(F.lit("unparsed_date"))).otherwise(F.array().cast("array<string>")).alias("extraction_warnings"),
        F.lit("item").alias("record_scope"), F.lit("item_level").alias("extracted_level"), quality.alias("source_quality"), confidence.alias("extraction_confidence"),
        facts.alias("semantic_content_hash"), facts.alias("content_hash"), extraction.alias("extraction_hash"), F.col("text_hash").alias("detail_page_hash"),
        fetched_at.alias("fetched_at"), fetched_at.alias("last_detail_success_at"), F.lit(True).alias("seen_in_current_index"), F.lit("success").alias("detail_fetch_status"), F.lit(False).alias("current_run_data_reused"),
    )


#: What an item takes from its record's state, under the same names.
STATE_FIELDS = (
    "lifecycle_state", "semantic_version", "extraction_revision", "last_semantic_change_at", "last_extraction_improvement_at", "missing_since", "consecutive_missing_observations", "consecutive_detail_failures",
    "last_lifecycle_event", "attention_required",
)


def with_state(items: DataFrame, states: DataFrame) -> DataFrame:
    """Items with the fields of their record's state over their own, null where the state has none, and its hashes; items without a state stay as they are."""
    held = states.select(F.col("record_id").alias("__id"), F.struct(*[(F.col(c) if c in states.columns else F.lit(None)).alias(c) for c in (*STATE_FIELDS, "current_semantic_hash", "current_extraction_hash")]).alias("__state"))
    joined = items.join(held, items["id"] == held["__id"], "left")
    from_state = {c: F.col(f"__state.{c}") for c in STATE_FIELDS} | {"semantic_content_hash": F.col("__state.current_semantic_hash"), "content_hash": F.col("__state.current_semantic_hash"), "extraction_hash": F.col("__state.current_extraction_hash")}
    has = F.col("__id").isNotNull()
    own = lambda c: F.col(c) if c in items.columns else F.lit(None)
    return joined.withColumns({c: F.when(has, v).otherwise(own(c)) for c, v in from_state.items()}).drop("__id", "__state")
