"""Objects whose shape isn't known: flattened to paths and written canonically, from VARIANT values or JSON texts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordwatch.sources.shared import settled

#: Levels that are opened; an object below them stands as JSON.
LEVELS = 32
#: Levels that are opened in a pass over the rows.
AT_ONCE = 4


def leaves(df: DataFrame, value: str, keys: list[str], levels: int = LEVELS) -> DataFrame:
    """``keys, path, text`` of every leaf of the VARIANT column ``value``, with dotted paths; lists are leaves and so are objects without fields.

    Objects are opened ``AT_ONCE`` levels in a pass, in which leaves stand as they are; what is made is written once, and another
    pass goes on from the objects that are left, if there are any. A value that is no object is a leaf with an empty path; a null
    column has none. Texts stand as they are, null leaves as null, all else as JSON.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.lit("").alias("path"), F.col(value).alias("__v"))
    kind = F.expr("schema_of_variant(__v)")
    text = F.when(kind == "STRING", F.try_variant_get(F.col("__v"), "$", "string")).when(kind != "VOID", F.to_json("__v"))
    fields = F.try_variant_get(F.col("__v"), "$", "map<string,variant>")
    top = F.col("path") == ""
    out = None
    for level in range(0, max(levels, 1), AT_ONCE):
        for _ in range(min(AT_ONCE, levels - level)):
            inner = rows.select(*keys, "path", "__v", F.explode_outer(fields).alias("__k", "__w"))
            leaf = F.col("__k").isNull()
            rows = inner.select(*keys, F.when(leaf, F.col("path")).when(top, F.col("__k")).otherwise(F.concat("path", F.lit("."), "__k")).alias("path"), F.when(leaf, F.col("__v")).otherwise(F.col("__w")).alias("__v"))
        # An empty object at the top has no fields to tell.
        size = F.coalesce(F.size(fields), F.lit(-1))
        told = rows.select("*", size.alias("__n")).filter(~(top & (F.col("__n") == 0)))
        left = (F.col("__n") > 0) & F.lit(level + AT_ONCE < levels)
        made = settled(told.select(*keys, "path", F.when(~left, text).alias("text"), F.when(left, F.col("__v")).alias("__v")))
        part = made.filter("__v is null").select(*keys, "path", "text")
        out = part if out is None else out.unionByName(part)
        rows = made.filter("__v is not null").select(*keys, "path", "__v")
        if rows.isEmpty():
            break
    return out


def facts(df: DataFrame, value: str, keys: list[str], levels: int = LEVELS) -> DataFrame:
    """``keys, facts``: the leaves of each row as one map of path to text, in the order of paths; as the lifecycle over whole readings takes them."""
    listed = F.array_sort(F.collect_list(F.struct("path", "text")))
    return leaves(df, value, keys, levels).groupBy(*keys).agg(F.map_from_entries(listed).alias("facts"))


@F.pandas_udf(StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    def told(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            return json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        except ValueError:
            return None

    return texts.map(told)


def canonical_json(text: Column) -> Column:
    """JSON with keys in order at every depth and without blanks, numbers as JSON has them, nulls kept; null for what isn't JSON."""
    return _canonical(text)
