"""Versions of records over whole readings: facts, evidence, quality and confidence against those of the last good reading.

A reading is ``facts`` and ``evidence`` (maps of path to text, nested objects flattened), ``quality`` and ``confidence``, beside
the columns of the lifecycle's log. The last good reading is carried over failures and absences by the lifecycle's own window, so
one shuffle by record serves states, comparison and versions. Facts that differ are a new semantic version; facts, evidence,
quality or confidence that are gained are a new revision of their extraction; a parser's version alone is neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.functions.ids import canonical_map, digest, version_id
from recordwatch.functions.text import excerpt
from recordwatch.operators import diff as D
from recordwatch.operators import lifecycle as L
from recordwatch.operators.keyed import union_last_value

PAYLOAD = ("facts", "evidence", "quality", "confidence")


def changed_texts(last: Column, names: Column, limit: int = 240) -> Column:
    """Map of each of the ``names`` to its excerpts in the last reading and in this."""
    shown = lambda facts, k: excerpt(F.element_at(facts, k), limit)
    entry = lambda k: F.struct(k.alias("key"), F.struct(shown(last["facts"], k).alias("before_excerpt"), shown(F.col("facts"), k).alias("after_excerpt")).alias("value"))
    return F.map_from_entries(F.transform(names, entry))


def compare(last: Column) -> dict[str, Column]:
    """What a reading changes, improves and degrades against the last good one."""
    semantic = D.map_diff(F.coalesce(last["facts"], F.create_map().cast("map<string,string>")), F.coalesce("facts", F.create_map().cast("map<string,string>")))
    none = F.create_map().cast("map<string,string>")
    evidence = (F.coalesce(last["evidence"], none), F.coalesce("evidence", none))
    extraction = D.extraction_diff(semantic, evidence, (last["quality"], F.col("quality")), (last["confidence"], F.col("confidence")))
    return {
        "changed": F.size(semantic["changed_fields"]) > 0, "improved": extraction["status"] == "improved", "degraded": extraction["status"] == "degraded",
        "changed_fields": semantic["changed_fields"], "improved_reasons": extraction["improved_reasons"], "degraded_reasons": extraction["degraded_reasons"],
        "change_evidence": changed_texts(last, semantic["changed_fields"]),
    }


def with_hashes(log: DataFrame) -> DataFrame:
    """``log`` with the hashes of its facts and of how they were read."""
    rounded = F.round("confidence", 4)
    parts = F.concat_ws("|", canonical_map(F.col("evidence")), F.coalesce("quality", F.lit("")), F.coalesce(rounded.cast("string"), F.lit("")), *[F.coalesce(c, F.lit("")) for c in ("parser_version", "method") if c in log.columns])
    return log.withColumns({"semantic_hash": digest(canonical_map(F.col("facts")), 16), "extraction_hash": digest(parts, 16)})


def timeline(log: DataFrame, policy: L.Policy = L.Policy()) -> DataFrame:
    """The lifecycle's timeline over whole readings, with ``changed_fields, improved_reasons, degraded_reasons, change_evidence`` and the hashes of good readings."""
    rows = with_hashes(log)
    both = lambda last: compare(last) | {"previous_semantic_hash": last["semantic_hash"]}
    timed = L.timeline(rows, policy, (*PAYLOAD, "semantic_hash"), both, ("semantic_hash", "extraction_hash"))
    good = F.col("kind") == "ok"
    return timed.withColumns({c: F.when(good, F.col(c)) for c in ("semantic_hash", "extraction_hash")})


def versions(timed: DataFrame) -> DataFrame:
    """One row for each version of a record, with its id: the first reading, then changed facts, then better extraction."""
    kind = F.when(F.col("previous_state").isNull(), "new_item").when(F.col("changed"), "semantic_change").when(F.col("improved"), "extraction_improvement")
    fields = F.when(F.col("changed"), F.col("changed_fields")).when(F.col("improved"), F.col("improved_reasons")).otherwise(F.array().cast("array<string>"))
    rows = timed.withColumn("version_kind", kind).filter(F.col("version_kind").isNotNull())
    return rows.select(
        version_id(F.col("record_id"), F.col("semantic_hash"), F.col("extraction_hash")).alias("version_id"), "seq", "run_id", "record_id", F.col("started_at").alias("observed_at"), "version_kind",
        "semantic_version", "extraction_revision", "semantic_hash", "extraction_hash", fields.alias("changed_fields"),
    )


def merged_versions(stored: DataFrame, new: DataFrame, per_record: int | None) -> DataFrame:
    """Stored versions and new ones (each with ``pos``): one row for each id, the last, at the place of the first; of each record the last ``per_record`` (None: all)."""
    united = union_last_value([stored, new], "version_id")
    if per_record is None:
        return united
    place = F.row_number().over(Window.partitionBy("record_id").orderBy(F.desc("position")))
    return united.withColumn("__n", place).filter(F.col("__n") <= per_record).drop("__n")
