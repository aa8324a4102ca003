"""Selection of records for a summary: core records, priority, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def core_records(df: DataFrame, seen: Column, is_item: Column, source: str, restricted: Column, direct: Column) -> DataFrame:
    """Rows in view (null counts as seen); page rows only for sources without item rows; item rows of restricted sources only if direct.

    Whether a source has items is asked of all its rows in view, so one whose items are all left out keeps no page either.
    """
    no = F.lit(False)
    rows = df.filter(F.coalesce(seen, F.lit(True)))
    sources = rows.groupBy(F.col(source).alias("__s")).agg(F.max(F.coalesce(is_item, no)).alias("__has_items"))
    joined = rows.join(sources, rows[source].eqNullSafe(sources["__s"]))
    held_out = F.coalesce(restricted, no) & F.coalesce(is_item, no) & ~F.coalesce(direct, no)
    return joined.filter((F.coalesce(is_item, no) | ~F.col("__has_items")) & ~held_out).drop("__s", "__has_items")


def priority(change: Column, events: Column, attention: Column, page_change: Column) -> Column:
    """Place in a summary, 0 first: new, changed, recovered, reappeared, attention, baseline, page changed, unchanged, other."""
    return (
        F.when(change == "new", 0)
        .when(change == "changed", 1)
        .when(F.array_contains(events, "detail_fetch_recovered"), 2)
        .when(F.array_contains(events, "reappeared"), 3)
        .when(attention, 4)
        .when(change == "baseline", 5)
        .when((change == "unchanged") & (page_change == "changed"), 6)
        .when(change == "unchanged", 7)
        .otherwise(8)
    )


def top(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows: a top-k per task, then of those (no full sort)."""
    return df.orderBy(*order).limit(k)


def truncated(df: DataFrame, keys: list[str], order: list[Column], cap: int | None) -> DataFrame:
    """The first ``cap`` rows of each key (None: all) with ``overflow``: whether there were more, so the view is not complete."""
    if cap is None:
        return df.withColumn("overflow", F.lit(False))
    sized = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg((F.count(F.lit(1)) > cap).alias("overflow"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = df.withColumn("__n", place).filter(F.col("__n") <= cap).drop("__n")
    same = F.lit(True)
    for k in keys:
        same = same & (first[k] == sized[f"__{k}"])
    return first.join(sized, same).drop(*[f"__{k}" for k in keys])
