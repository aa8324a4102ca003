"""Mixing sources to target weights: how often each document is emitted, and the mix itself.

The words of each source are added up; weights share a number of words in all, a source takes at most ``most`` times
its own words, and what is above goes to the others by weight until none is above. A source's rate is its target over
its words. Each document is emitted floor(rate) times, and once more if a number hashed from its id and a seed, even
over [0, 1), is below the fraction. For every source the seed is, of ``SEEDS``, the one whose total comes nearest to the
target: that keeps the probability of each copy and takes most of the chance out of the total of small sources. Nothing
else is random, so reruns agree, on any partitioning.

Texts are read once to count words; counts go to a narrow table in the shared folder. Sources reach the driver as sums
only. A source with a third of all rows is added up before the shuffle and is dealt out by salts where the sources are
too many to broadcast.

Edge cases: a null or empty text has no words, its copies take none; null is a source of its own, last in order; a source
without words has rate 0; a null id is hashed by its text instead; repeated rows are emitted equally often; an empty table
gives an empty mix; other columns are passed on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.llm.common import by_hot_key, cut, free_name, kept, text_or_empty

#: What a word is made of: anything but blanks, tabs and line ends.
WORD = r"[^\x20\x09-\x0D]+"
#: Seeds that are tried for each source.
SEEDS = 16
#: Sources up to this number are broadcast.
BROADCAST_SOURCES = 100_000
#: Hexadecimal digits of the hash that decides; their number of values.
DIGITS, VALUES = 12, 2.0**48


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _key(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def _drawn(key: Column, seed: Column) -> Column:
    """An even number below ``VALUES`` for a key and a seed."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key, seed.cast("string"))), 1, DIGITS), 16, 10).cast("long").cast("double")


def _row_key(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.sha2(text_or_empty(text_col), 256))


def in_order(groups: DataFrame, by: str) -> DataFrame:
    """``groups`` with ``place``, from 0, in ascending order of ``by``, nulls last; no task sees all rows."""
    dealt = cut(groups.repartitionByRange(F.col(by).asc_nulls_last()).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(F.col(by).asc_nulls_last()))
    return dealt.withColumn("__place", within - 1).join(F.broadcast(starts), "__part").withColumn("place", F.col("__place") + F.col("__start")).drop("__part", "__place", "__start")


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``source, source_size`` with ``weight, target``; weights go round over the sources in order.

    What is above a limit is shared out again until nothing is above; each round adds up the table of sources once.
    """
    place = F.pmod("place", F.lit(len(weights))) + 1
    held = cut(in_order(sources, "source").withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place.cast("int"))).drop("place"))
    limit = F.lit(float(most)) * F.col("source_size")
    total, left = held.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level, full = (share * total / left if left else 0.0), 0
    while True:
        above = limit < F.lit(level) * F.col("weight")
        words, free, now = held.agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight"))), F.count(F.when(above, 1))).first()
        if now == full:
            return held.withColumn("target", F.least(limit, F.lit(level) * F.col("weight")))
        full = now
        if not free:
            return held.withColumn("target", limit)
        level = (share * total - (words or 0.0)) / free


def _with_sources(rows: DataFrame, sources: DataFrame, spread: Column) -> DataFrame:
    """``rows`` with what ``sources`` says of their ``__key``."""
    if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(sources.drop("__n")), "__key")
    return by_hot_key(rows, sources, "__key", "__n", spread).drop("__n")


def rates(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The sources of ``docs``: ``source, source_size, weight, target, whole, fraction, seed, taken``, and their rows' key and number."""
    sized = kept(docs.select(_row_key(id_col, text_col).alias("row"), F.col(source_col).cast("string").alias("source"), n_words(text_or_empty(text_col)).alias("size")))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__n"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shared = targets(sums, weights, share, most).withColumn("whole", F.floor(rate)).withColumn("fraction", rate - F.col("whole"))
    shared = cut(shared.withColumn("__key", _key(F.col("source"))))
    again = [F.sum(F.when(_drawn(F.col("row"), F.lit(k)) < F.col("fraction") * VALUES, F.col("size")).otherwise(0)).alias(f"t{k}") for k in range(SEEDS)]
    asked = sized.filter("size > 0").withColumn("__key", _key(F.col("source"))).drop("source")
    tried = _with_sources(asked, shared.select("__key", "fraction", "__n"), F.col("row")).groupBy("__key").agg(*again)
    found = shared.join(tried, "__key", "left")
    total = lambda k: F.col("whole") * F.col("source_size") + F.coalesce(F.col(f"t{k}"), F.lit(0))
    best = F.array_min(F.array(*[F.struct(F.abs(total(k) - F.col("target")).alias("off"), F.lit(k).alias("seed"), total(k).alias("taken")) for k in range(SEEDS)]))
    found = found.withColumn("best", best).select("__key", "__n", "source", "source_size", "weight", "target", "whole", "fraction", F.col("best.seed").alias("seed"), F.col("best.taken").alias("taken"))
    return cut(found)


def with_copies(docs: DataFrame, sources: DataFrame, copies: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with the number of times each is emitted as ``copies`` and what :func:`rates` says of its source as ``of_source``."""
    said = sources.select("__key", "__n", F.struct("source_size", "target", "whole", "fraction", "seed").alias("of_source"))
    rows = docs.withColumn("__row", _row_key(id_col, text_col)).withColumn("__key", _key(F.col(source_col)))
    joined = _with_sources(rows, said, F.col("__row"))
    lucky = _drawn(F.col("__row"), F.col("of_source.seed")) < F.col("of_source.fraction") * VALUES
    return joined.withColumn(copies, F.col("of_source.whole") + lucky.cast("long")).drop("__row", "__key")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix: every column of ``docs``, each document as often as its rate says, and ``copy``, from 1 (with underscores before it if that name is taken)."""
    names = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    own = docs.toDF(*names.values())
    args = [names[c] for c in (id_col, text_col, source_col)]
    counted = with_copies(own, rates(own, weights, share, most, *args), "copies", *args).filter("copies > 0")
    out = counted.select(*names.values(), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return out.toDF(*docs.columns, free_name(docs, "copy"))


def mix_sizes(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document of :func:`mix`: ``id_col, size, source_size, target, taken``, in words; taken counts its copies."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    counted = with_copies(own, rates(own, weights, share, most, "id"), "copies", "id")
    size = n_words(text_or_empty())
    return counted.withColumn("size", size).select(F.col("id").alias(id_col), "size", "of_source.source_size", "of_source.target", (F.col("size") * F.col("copies")).alias("taken"))
