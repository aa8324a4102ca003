"""Nested objects: facts flattened to dotted paths, and mappings cut to a size that can be shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from recordwatch.functions.text import collapse, excerpt

EXCERPT, LISTED = 240, 20


def flattened(value: Column, kind: DataType) -> Column:
    """Map of dotted path to text of every leaf of a struct, paths in order; lists are leaves, as JSON, and so are maps."""
    leaves: list[tuple[str, Column]] = []

    def walk(column: Column, of: DataType, path: str) -> None:
        if isinstance(of, StructType):
            for f in sorted(of.fields, key=lambda f: f.name):
                walk(column[f.name], f.dataType, f"{path}.{f.name}" if path else f.name)
        else:
            leaves.append((path, F.to_json(column) if isinstance(of, (ArrayType, MapType)) else column.cast("string")))

    walk(value, kind, "")
    return F.map_from_arrays(F.array(*[F.lit(p) for p, _ in leaves]), F.array(*[c for _, c in leaves]))


def shown(text: Column, limit: int = EXCERPT) -> Column:
    """Collapsed text, cut to ``limit`` characters with an ellipsis; null for an empty one."""
    return excerpt(F.nullif(collapse(text), F.lit("")), limit)


def limited(mapping: Column, limit: int = EXCERPT) -> Column:
    """A map of texts with its keys in order and every value :func:`shown`."""
    return F.map_from_entries(F.transform(F.array_sort(F.map_entries(mapping)), lambda e: F.struct(e["key"].alias("key"), shown(e["value"], limit).alias("value"))))


def limited_lists(mapping: Column, limit: int = EXCERPT, most: int = LISTED) -> Column:
    """The same for a map of lists, each cut to its first ``most`` entries."""
    cut = lambda xs: F.transform(F.slice(xs, 1, most), lambda x: shown(x, limit))
    return F.map_from_entries(F.transform(F.array_sort(F.map_keys(mapping)), lambda k: F.struct(k.alias("key"), cut(F.element_at(mapping, k)).alias("value"))))
