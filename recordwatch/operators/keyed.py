"""Keyed operators: latest row, gap filling, retention, ordered union, upsert, merges of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that is greatest in ``order`` (nulls lowest).

    One aggregation with a struct maximum: partial maxima are taken before the shuffle, so a hot key sends
    one row per map task, which a window over the key could not do.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.max(F.struct(*[c.alias(f"__o{k}") for k, c in enumerate(order)], *rest)).alias("__row")
    return df.groupBy(*keys).agg(ranked).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def fill_from_siblings(df: DataFrame, keys: list[str], columns: list[str], completeness: Column, order: Column) -> DataFrame:
    """Empty values of every row filled from its key's most complete row that has one, then the latest.

    Each value comes from an aggregation of its own, all in one pass, so no key is gathered.
    """
    filled = [F.max(F.when(F.col(c).isNotNull(), F.struct(completeness.alias("n"), order.alias("o"), F.col(c).alias("v")))).alias(f"__{c}") for c in columns]
    best = df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(*filled)
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(best[f"__k_{k}"])
    joined = df.join(best, same, "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"__{c}.v")).alias(c) if c in columns else df[c] for c in df.columns])


def latest_and_filled(df: DataFrame, keys: list[str], columns: list[str], completeness: Column, order: list[Column]) -> DataFrame:
    """The latest row of each key with its empty values filled from the others, in one aggregation."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max(F.struct(*[c.alias(f"__o{k}") for k, c in enumerate(order)], *rest)).alias("__row")
    spare = [F.max(F.when(F.col(c).isNotNull(), F.struct(completeness.alias("n"), order[-1].alias("o"), F.col(c).alias("v")))).alias(f"__{c}") for c in columns]
    got = df.groupBy(*keys).agg(row, *spare)
    value = lambda c: F.coalesce(F.col(f"__row.{c}"), F.col(f"__{c}.v")) if c in columns else F.col(f"__row.{c}")
    return got.select(*keys, *[value(c).alias(c) for c in rest]).select(*df.columns)


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key. Spark limits each key within map tasks before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", place).filter(F.col("__n") <= n).drop("__n")


def keep_last(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    """The last ``n`` rows of all, by a distributed top-k; ``order`` is descending. None keeps all."""
    return df if n is None else df.orderBy(*order).limit(n)


def union_last_value(parts: list[DataFrame], key: str) -> DataFrame:
    """Union in which the last row of each key stands at the place of its first; empty keys are dropped.

    Adds ``position``: the part's number and the row's own ``pos``, by which to order.
    """
    numbered = None
    for k, part in enumerate(parts):
        part = part.withColumn("position", F.struct(F.lit(k).alias("part"), F.col("pos").alias("pos")))
        numbered = part if numbered is None else numbered.unionByName(part)
    rows = numbered.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    values = [c for c in rows.columns if c not in (key, "position", "pos")]
    got = rows.groupBy(key).agg(F.max_by(F.struct(*values), "position").alias("__row"), F.min("position").alias("position"))
    return got.select(key, *[F.col(f"__row.{c}").alias(c) for c in values], "position")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keyed upsert that merges column by column: a column that ``new`` has wins (nulls too), others keep their old value."""
    o, n = old.withColumn("__old", F.lit(True)), new.withColumn("__new", F.lit(True))
    both = o.alias("o").join(n.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    names = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    fresh = F.col("n.__new").isNotNull()

    def value(c: str) -> Column:
        if c == key:
            return F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))
        if c not in new.columns:
            return F.col(f"o.{c}")
        return F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}") if c in old.columns else F.lit(None))

    return both.select(*[value(c).alias(c) for c in names])


def reset_unseen(old: DataFrame, complete_sources: DataFrame, source: str = "source_id", seen: str = "seen") -> DataFrame:
    """Rows of sources whose view was complete become unseen, until new rows say otherwise."""
    marked = complete_sources.select(F.col(source).alias("__s")).distinct().withColumn("__c", F.lit(True))
    joined = old.join(marked, old[source] == marked["__s"], "left")
    return joined.withColumn(seen, F.when(F.col("__c"), F.lit(False)).otherwise(F.col(seen))).drop("__s", "__c")


def not_yet_stored(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose id isn't stored."""
    return new.join(stored.select(key), key, "left_anti")


def ordered_unique(values: Column) -> Column:
    """First occurrence of each value that isn't blank, in order."""
    return F.array_distinct(F.filter(F.transform(values, F.trim), lambda v: v.isNotNull() & (v != "")))


def merge_candidates(df: DataFrame, key: list[str]) -> DataFrame:
    """One candidate per key: the first title that isn't blank, the longest evidence (the first of equals), the first origin but anchors, and all keywords, where ``df`` has such a column. Needs ``pos``.

    Keywords are made distinct by a shuffle of their own before they are listed, so no key's lists are gathered whole.
    """
    title = F.min(F.when(F.trim(F.coalesce("title", F.lit(""))) != "", F.struct("pos", "title")))
    evidence = F.min(F.struct((-F.char_length(F.coalesce("evidence", F.lit("")))).alias("n"), "pos", "evidence"))
    origin = F.min(F.when(F.col("origin") != "anchor", F.struct("pos", "origin")))
    rows = df.filter(F.col(key[-1]).isNotNull())
    merged = rows.groupBy(*key).agg(
        F.coalesce(title["title"], F.lit("")).alias("title"), evidence["evidence"].alias("evidence"), F.coalesce(origin["origin"], F.lit("anchor")).alias("origin"), F.min("pos").alias("pos"),
    )
    if "keywords" not in df.columns:
        return merged
    words = rows.select(*[F.col(k).alias(f"__{k}") for k in key], F.explode("keywords").alias("word")).distinct()
    listed = words.groupBy(*[f"__{k}" for k in key]).agg(F.array_sort(F.collect_list("word")).alias("keywords"))
    same = F.lit(True)
    for k in key:
        same = same & merged[k].eqNullSafe(listed[f"__{k}"])
    return merged.join(listed, same, "left").select(*merged.columns, F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"))


def running_max_before(df: DataFrame, seq: str, value: str, bits: int = 12) -> DataFrame:
    """``df`` with ``max_before``: the greatest ``value`` of all rows with a smaller ``seq`` (a whole number).

    Rows are ordered in buckets of numbers, wide enough to hold about 2**bits rows each where numbers are sparse; a running
    maximum over the buckets' own maxima joins them, and is taken the same way, so no task sees all rows or all buckets.
    """
    ends = df.agg(F.min(seq).alias("low"), F.max(seq).alias("high"), F.count(seq).alias("n")).first()
    apart = ((ends.high - ends.low) // ends.n).bit_length() if ends.n else 0
    return _max_before(df, seq, value, bits + apart, bits, (ends.high or 0) - (ends.low or 0))


def _max_before(df: DataFrame, seq: str, value: str, shift: int, bits: int, span: int) -> DataFrame:
    """:func:`running_max_before` with buckets of 2**shift numbers; ``span`` is the distance of the greatest number from the least."""
    rows = df.withColumn("__b", F.shiftright(seq, min(shift, 63)))
    tops = rows.groupBy("__b").agg(F.max(value).alias("__top"))
    if span >> shift > 1 << bits:
        of_tops = _max_before(tops.toDF("seq", "value"), "seq", "value", bits, bits, (span >> shift) + 1)
        before = of_tops.select(F.col("seq").alias("__b"), F.col("max_before").alias("__before"))
    else:
        over = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        before = tops.select("__b", F.max("__top").over(over).alias("__before"))
    inside = F.max(value).over(Window.partitionBy("__b").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1))
    joined = rows.withColumn("__inside", inside).join(before, "__b")
    return joined.withColumn("max_before", F.greatest("__inside", "__before")).drop("__b", "__inside", "__before")
