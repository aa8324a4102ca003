"""Deterministic ids and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(text: Column, length: int) -> Column:
    """The first hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, length)


def joined(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def record_id(source_id: Column, url: Column) -> Column:
    return digest(joined(source_id, url), 16)


def event_id(run_id: Column, record: Column, kind: Column) -> Column:
    return digest(joined(run_id, record, kind), 20)


def version_id(record: Column, semantic_hash: Column, extraction_hash: Column) -> Column:
    """The same for the same facts read alike, so a record that goes back to them has its earlier version again."""
    return digest(joined(record, semantic_hash, extraction_hash), 20)


def canonical_map(entries: Column) -> Column:
    """JSON of a map of texts, keys in order, without the empty ones."""
    held = F.filter(F.array_sort(F.map_entries(F.coalesce(entries, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    return F.to_json(F.map_from_entries(held))


def alert_key(kind: Column, source: Column, record: Column) -> Column:
    """Kind, source and record, with ``global`` for what is missing."""
    named = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("global"))
    return F.concat_ws("|", kind, named(source), named(record))


def canonical_json(**fields: Column) -> Column:
    """JSON of the fields in alphabetical order, nulls kept, numbers as the text they cast to."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def content_hash(length: int = 16, **fields: Column) -> Column:
    return digest(canonical_json(**fields), length)
