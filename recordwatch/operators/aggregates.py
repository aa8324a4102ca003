"""Rollups: quality of sources, modes with tie rules, histograms, completeness, change interpretation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mode_ranked(df: DataFrame, keys: list[str], value: str, rank: Column, default: str = "unknown") -> DataFrame:
    """The most frequent value of each key; of equals the higher ranked, then the greater. Null counts as ``default``."""
    counted = df.groupBy(*keys, F.coalesce(F.col(value), F.lit(default)).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*keys).agg(F.max_by("v", F.struct("n", rank.alias("rank"), "v")).alias("mode"))


def mode_first_seen(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """The most frequent value of each key; of equals the one seen first."""
    counted = df.groupBy(*keys, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("first"))
    return counted.groupBy(*keys).agg(F.max_by("v", F.struct("n", (-F.col("first")).alias("f"))).alias("mode"))


def histogram(df: DataFrame, keys: list[str], value: str, default: str = "unknown") -> DataFrame:
    return df.groupBy(*keys, F.coalesce(F.col(value).cast("string"), F.lit(default)).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def quality_summary(items: DataFrame, source: str, confidence: str, links: str, complete: dict[str, Column], item_scope: Column) -> DataFrame:
    """Per source: items, mean confidence (null as 0), links, and for item-level rows the share that have each field."""
    n = F.count_if(item_scope)
    return items.groupBy(source).agg(
        F.count(F.lit(1)).alias("items"), F.avg(F.coalesce(confidence, F.lit(0.0))).alias("average_confidence"), F.sum(links).alias("links"),
        *[F.try_divide(F.count_if(item_scope & c), n).alias(f"{k}_ratio") for k, c in complete.items()],
    )


# Levels and qualities from the least up.
LEVELS, QUALITIES = ("unknown", "page_level", "link_level", "item_level"), ("unknown", "low", "medium", "high")


def quality_report(items: DataFrame, source: str = "source_id") -> DataFrame:
    """Per source: dominant level and quality, mean confidence (null as 0), links, histograms, and for its item rows the share that have each field; shares to two digits.

    ``items``: ``extracted_level, source_quality, extraction_confidence, candidate_links, record_scope, title, published_at, evidence,
    field_evidence``. Rows are summed by source, level and quality before they are summed by source, so no source is gathered.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    named = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown"))
    item = F.coalesce(F.col("record_scope") == "item", F.lit(False))
    proof = lambda k: F.coalesce(F.element_at("field_evidence", k), F.lit("")) != ""
    has = {"title": filled("title"), "date": filled("published_at"), "evidence": filled("evidence"), "field_evidence": proof("title") & proof("evidence")}
    links = F.when(F.col("candidate_links").isNull(), 0).otherwise(F.size("candidate_links"))
    parts = items.groupBy(F.col(source).alias("source"), named("extracted_level").alias("level"), named("source_quality").alias("quality")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.col("extraction_confidence").cast("decimal(20,10)"), F.lit(0))).alias("confidence"), F.sum(links).alias("links"), F.count_if(item).alias("n_items"),
        F.count_if(F.col("record_scope") == "page").alias("n_pages"), *[F.count_if(item & on).alias(f"n_{k}") for k, on in has.items()],
    )

    def counted(of: str, order: tuple[str, ...]) -> DataFrame:
        sums = parts.groupBy("source", of).agg(F.sum("n").alias("n"))
        place = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col(of)), F.lit(0))
        return sums.groupBy("source").agg(F.max_by(of, F.struct("n", place.alias("r"), F.col(of).alias("v"))).alias(f"dominant_{of}"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(of, "n")))).alias(f"{of}_counts"))

    share = lambda k: F.round(F.try_divide(F.sum(f"n_{k}"), F.sum("n_items")), 2).alias(f"{k}_completeness")
    whole = parts.groupBy("source").agg(
        F.round(F.sum("confidence") / F.sum("n"), 2).cast("double").alias("average_confidence"), F.sum("links").alias("candidate_links_total"), F.sum("n_items").alias("item_level_count"), F.sum("n_pages").alias("page_level_count"), *[share(k) for k in has],
    )
    same = lambda a, b: a["source"].eqNullSafe(b["__source"])
    for of, order in (("level", LEVELS), ("quality", QUALITIES)):
        more = counted(of, order).withColumnRenamed("source", "__source")
        whole = whole.join(more, same(whole, more), "left").drop("__source")
    return whole.withColumnRenamed("source", source)


def change_reading(new: Column, changed: Column, baseline: Column, page_changed: Column, unchanged: Column) -> Column:
    """One word for what a source's counts mean."""
    return (
        F.when((new > 0) | (changed > 0), "items_changed").when(baseline > 0, "baseline").when(page_changed, "page_changed_only").when(unchanged > 0, "unchanged").otherwise("unclear")
    )


def sorted_distinct_text(value: Column) -> Column:
    """Comma-joined sorted distinct values of a group; the number of distinct values must be small."""
    return F.array_join(F.array_sort(F.collect_set(value)), ",")


def worst_label(value: str, rank: Column) -> Column:
    return F.min_by(value, rank)


def dedup_statistics(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after, and the difference, as one row."""
    b, a = before.agg(F.count(F.lit(1)).alias("before")), after.agg(F.count(F.lit(1)).alias("after"))
    return b.join(a).select("before", "after", (F.col("before") - F.col("after")).alias("removed"))


def with_sources(status: DataFrame, quality: DataFrame, records: DataFrame, source: str = "source_id") -> DataFrame:
    """Every source of any of three tables (each with one row per source), with what each has of it."""
    return status.join(quality, source, "full_outer").join(records, source, "full_outer")
