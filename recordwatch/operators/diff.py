"""Diffs: facts against facts, extraction against extraction, pages against pages, baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.functions.classify import QUALITY, rank
from recordwatch.functions.text import collapse, excerpt, grows, is_empty

GROWING = ("summary", "evidence")


def field_change(name: str | Column, before: Column, after: Column) -> Column:
    """improved, degraded, changed or null for one flattened field; a name that isn't known before may be a column."""
    growth = grows(before, after)
    if isinstance(name, Column):
        growth = name.isin(*GROWING) & growth
    elif name not in GROWING:
        growth = F.lit(False)
    return (
        F.when(before.eqNullSafe(after) | (is_empty(before) & is_empty(after)), F.lit(None))
        .when(is_empty(before), "improved")
        .when(is_empty(after), "degraded")
        .when(growth, "improved")
        .otherwise("changed")
    )


def semantic_diff(fields: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """Sorted arrays ``changed_fields, improved_fields, degraded_fields``, for pairs of normalized values by name."""
    change = {k: field_change(k, *fields[k]) for k in sorted(fields)}
    pick = lambda kind: F.array_compact(F.array(*[F.when(c == kind, F.lit(k)) for k, c in change.items()]))
    return {f"{kind}_fields": pick(kind) for kind in ("changed", "improved", "degraded")}


def change_evidence(fields: dict[str, tuple[Column, Column]], limit: int = 240) -> Column:
    """Map of each changed field to its excerpts before and after."""
    entries = [
        F.when(field_change(k, b, a) == "changed", F.struct(F.lit(k).alias("key"), F.struct(excerpt(b.cast("string"), limit).alias("before_excerpt"), excerpt(a.cast("string"), limit).alias("after_excerpt")).alias("value")))
        for k, (b, a) in sorted(fields.items())
    ]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def map_diff(before: Column, after: Column) -> dict[str, Column]:
    """The same for facts flattened to a map of path to text; a path that one of them lacks is empty there."""
    keys = F.array_sort(F.array_union(F.map_keys(before), F.map_keys(after)))

    def of(kind: str) -> Column:
        return F.filter(keys, lambda k: field_change(k, F.element_at(before, k), F.element_at(after, k)) == kind)

    return {f"{kind}_fields": of(kind) for kind in ("changed", "improved", "degraded")}


def extraction_diff(semantic: dict[str, Column], evidence: tuple[Column, Column], quality: tuple[Column, Column], confidence: tuple[Column, Column]) -> dict[str, Column]:
    """``status, improved_reasons, degraded_reasons``: facts gained or lost, evidence gained or lost, quality and confidence.

    A parser's version alone is no change; what improved isn't counted as degraded.
    """
    before, after = evidence
    gained = lambda a, b: F.transform(F.filter(F.map_keys(a), lambda k: ~is_empty(F.element_at(a, k)) & is_empty(F.element_at(b, k))), lambda k: F.concat(F.lit("field_evidence."), k))
    q, c = [rank(x, QUALITY) for x in quality], [F.round(x, 4) for x in confidence]
    some = lambda on, name: F.when(on, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    none = F.lit(False)
    better = F.concat(semantic["improved_fields"], gained(after, before), some(q[1] > q[0], "source_quality"), some(F.coalesce(c[1] > c[0], none), "extraction_confidence"))
    worse = F.concat(semantic["degraded_fields"], gained(before, after), some(q[1] < q[0], "source_quality"), some(F.coalesce(c[1] < c[0], none), "extraction_confidence"))
    improved = F.array_sort(F.array_distinct(better))
    degraded = F.array_sort(F.array_except(worse, better))
    status = F.when(F.size(improved) > 0, "improved").when(F.size(degraded) > 0, "degraded").otherwise("unchanged")
    return {"status": status, "improved_reasons": improved, "degraded_reasons": degraded}


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Each key of two snapshots: ``new``, ``missing``, ``changed`` or ``unchanged``, with the fields that changed. One shuffled full join."""
    o, n = old.select(key, *fields).withColumn("__o", F.lit(1)).alias("o"), new.select(key, *fields).withColumn("__n", F.lit(1)).alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    diff = semantic_diff({f: (F.col(f"o.{f}"), F.col(f"n.{f}")) for f in fields})
    any_change = F.size(diff["changed_fields"]) + F.size(diff["improved_fields"]) + F.size(diff["degraded_fields"]) > 0
    status = F.when(F.col("o.__o").isNull(), "new").when(F.col("n.__n").isNull(), "missing").when(any_change, "changed").otherwise("unchanged")
    empty = F.array().cast("array<string>")
    both_there = F.col("o.__o").isNotNull() & F.col("n.__n").isNotNull()
    return both.select(F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key), status.alias("change_status"), *[F.when(both_there, c).otherwise(empty).alias(k) for k, c in diff.items()])


def change_metadata(current: DataFrame, existing: DataFrame, key: str = "id", content: str = "content_hash") -> DataFrame:
    """Current rows with ``change_status`` by hash and the times carried over from existing ones."""
    was = existing.select(F.col(key).alias("__k"), F.col(content).alias("__hash"), F.col("first_seen_at").alias("__first"), F.col("last_changed_at").alias("__changed"))
    joined = current.join(was, current[key] == was["__k"], "left")
    status = F.when(F.col("__k").isNull(), "new").when(F.col("__hash").eqNullSafe(F.col(content)), "unchanged").otherwise("changed")
    seen = F.col("observed_at")
    return joined.select(
        current["*"], status.alias("change_status"), F.coalesce("__first", seen).alias("first_seen_at"),
        F.when(status == "unchanged", F.coalesce("__changed", seen)).otherwise(seen).alias("last_changed_at"),
    )


def baseline_status(bootstrapped: Column, known: Column, known_failed: Column, parser_upgraded: Column, facts_changed: Column) -> Column:
    """Change status of a record under a source that may not have a baseline yet.

    Before the baseline is complete everything is baseline; what is found only because a failed record could be read, or a
    parser was upgraded, is unchanged; then new or changed by facts.
    """
    return (
        F.when(~bootstrapped, "baseline")
        .when(known_failed | (~known & parser_upgraded), "unchanged")
        .when(~known, "new")
        .when(facts_changed, "changed")
        .otherwise("unchanged")
    )


def page_change(log: DataFrame, source: str, order: list[str], page_hash: str, failed: str, ignore_failures: bool = False) -> DataFrame:
    """``change_status`` of each page observation: failed, new, changed, unchanged, against the hash of the one before.

    A failed observation has no hash, so the next is ``new``; with ``ignore_failures`` it is compared with the last hash known.
    """
    seen = F.when(~F.col(failed), F.col(page_hash))
    over = Window.partitionBy(source).orderBy(*order)
    before = F.last(seen, ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)) if ignore_failures else F.lag(seen).over(over)
    status = F.when(F.col(failed), "failed").when(F.col("previous_hash").isNull(), "new").when(F.col("previous_hash") == F.col(page_hash), "unchanged").otherwise("changed")
    return log.withColumn("previous_hash", before).withColumn("change_status", status)


def reuse_last_success(current: DataFrame, last_good: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Failed rows take the columns of the last good record and are marked as reused; without one they stay empty."""
    good = last_good.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = current.join(good, current[key] == good["__k"], "left")
    reuse = F.col("failed") & F.col("__k").isNotNull()
    return joined.select(*[F.when(reuse, F.col(f"__{c}")).otherwise(current[c]).alias(c) if c in columns else current[c] for c in current.columns], reuse.alias("reused"))


def merge_by_rank(a: DataFrame, b: DataFrame, key: str, fields: list[str], rank_a: str, rank_b: str) -> DataFrame:
    """Two readings of a record merged by field: the better method wins where both have a value; conflicts are listed."""
    x, y = a.alias("x"), b.alias("y")
    both = x.join(y, F.col(f"x.{key}") == F.col(f"y.{key}"), "full_outer")
    pick = {f: (F.col(f"x.{f}"), F.col(f"y.{f}")) for f in fields}
    better = F.coalesce(F.col(f"y.{rank_b}"), F.lit(-1)) > F.coalesce(F.col(f"x.{rank_a}"), F.lit(-1))
    value = lambda l, r: F.when(is_empty(l), r).when(is_empty(r), l).when(better, r).otherwise(l)  # noqa: E731, E741
    conflict = F.array_compact(F.array(*[F.when(~is_empty(l) & ~is_empty(r) & (l != r), F.lit(f)) for f, (l, r) in pick.items()]))
    return both.select(F.coalesce(F.col(f"x.{key}"), F.col(f"y.{key}")).alias(key), *[value(*p).alias(f) for f, p in pick.items()], conflict.alias("conflicts"))


def titles_agree(before: Column, after: Column) -> Column:
    """Whether two titles are the same but for case, or one continues the other after a colon."""
    old, new = (F.lower(collapse(t)) for t in (before, after))
    continues = lambda a, b: (a != "") & b.startswith(F.concat(a, F.lit(":")))
    return (old == new) | continues(old, new) | continues(new, old)


def baseline_changes(current: DataFrame, existing: DataFrame, failures: DataFrame, sources: DataFrame, fields: list[str]) -> DataFrame:
    """``current`` items with ``change_status, extraction_change_status, change_reason, first_seen_at, last_changed_at, previous_content_hash``.

    ``current``: ``id, source_id, reused, fetched_at, parser_version, semantic_hash, extraction_hash, title, published`` and
    ``fields``; ``existing``: the same without ``reused``, with ``content_hash, first_seen_at, last_changed_at``;
    ``failures``: ``id`` of candidates that failed before; ``sources``: ``source_id, bootstrapped, previous_parser_version``.

    What was read from an earlier success stays unchanged. Until its source has a baseline an item is part of it. An item
    without a record is new, unless a failure or another parser explains why it wasn't known. Otherwise facts decide: after a
    change of parser only titles that disagree or two different dates, else the fields, or the hashes where there is no record of fields.
    """
    was = existing.select(F.col("id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in ("parser_version", "semantic_hash", "content_hash", "extraction_hash", "title", "published", "first_seen_at", "last_changed_at", *[f for f in fields if f not in ("title", "published")])])
    rows = current.join(was, current["id"] == was["__id"], "left")
    rows = rows.join(failures.select(F.col("id").alias("__failed")).distinct(), rows["id"] == F.col("__failed"), "left")
    told = sources.select(F.col("source_id").alias("__source"), "bootstrapped", "previous_parser_version")
    rows = rows.join(F.broadcast(told), rows["source_id"] == told["__source"], "left")
    known, failed = F.col("__id").isNotNull(), F.col("__failed").isNotNull()
    upgraded = F.coalesce((F.coalesce("previous_parser_version", F.lit("")) != "") & ~F.col("previous_parser_version").eqNullSafe(F.col("parser_version")), F.lit(False))
    reparsed = known & ~F.col("__parser_version").eqNullSafe(F.col("parser_version"))
    changed = lambda f: field_change(f, F.col(f"__{f}"), F.col(f)) == "changed"
    by_fields = F.coalesce(F.greatest(*[F.coalesce(changed(f), F.lit(False)) for f in fields], F.lit(False)), F.lit(False))
    dated = ~is_empty(F.col("__published")) & ~is_empty(F.col("published")) & (F.col("__published") != F.col("published"))
    facts = (
        F.when(reparsed, ~titles_agree(F.col("__title"), F.col("title")) | F.coalesce(dated, F.lit(False)))
        .when(~is_empty(F.col("__semantic_hash")), by_fields)
        .otherwise(~F.col("__content_hash").eqNullSafe(F.col("semantic_hash")))
    )
    enriched = reparsed | ~F.col("__extraction_hash").eqNullSafe(F.col("extraction_hash"))
    cases = [
        (F.col("reused"), "unchanged", "failed", "detail_fetch_failed_reused_previous_success"),
        (~F.coalesce("bootstrapped", F.lit(False)), "baseline", "unchanged", "baseline_established"),
        (~known & failed, "unchanged", "improved", "detail_failure_recovered"),
        (~known & upgraded, "unchanged", "improved", "parser_enrichment_discovery"),
        (~known, "new", "unchanged", "new_item"),
        (facts, "changed", "unchanged", "semantic_content_changed"),
        (enriched, "unchanged", "improved", "parser_enrichment"),
        (F.lit(True), "unchanged", "unchanged", "no_semantic_change"),
    ]
    case = F.coalesce(*[F.when(on, F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c"))) for on, a, b, c in cases])
    rows = rows.withColumn("__case", case)
    first = F.coalesce("__first_seen_at", "fetched_at")
    reason = F.col("__case.c")
    last = (
        F.when(reason == "baseline_established", F.coalesce("__last_changed_at", "fetched_at"))
        .when(reason.isin("new_item", "semantic_content_changed", "detail_failure_recovered", "parser_enrichment_discovery"), F.col("fetched_at"))
        .otherwise(F.coalesce(F.col("__last_changed_at"), first))
    )
    return rows.select(
        *[current[c] for c in current.columns], F.col("__case.a").alias("change_status"), F.col("__case.b").alias("extraction_change_status"), reason.alias("change_reason"),
        first.alias("first_seen_at"), last.alias("last_changed_at"), F.col("__content_hash").alias("previous_content_hash"),
    )
