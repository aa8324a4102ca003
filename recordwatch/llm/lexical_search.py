"""Ranked lexical search: for each item the ``k`` documents of highest score, found by a threshold-seeded join.

Texts are read once: a row for each document with its number of terms and those of its terms that any item has. From
it come the corpus' sums, each term's weight and, for each term, its ``k`` largest impacts with their documents (the
stored impacts; a term's largest is the bound of what it can add to a score). An item's threshold is seeded from them:
documents that are stored for its terms are ranked by the sum of their stored impacts, the best of them are scored in
full, and the kth of these scores is a lower bound of the item's kth score; it is at least the kth impact of any of its
terms. In order of falling bounds, the terms from which on the sum of bounds stays below the threshold can't by
themselves lift a document into the ranking; they are pruned. Documents with any other term are candidates; those whose
sum so far and the bounds of the pruned terms reach the threshold are scored in full over all terms of the item.
Nothing is approximated: ties with the threshold stay, and items with fewer than ``k`` documents prune nothing.

Items are a stated query set; they are joined by term, never crossed with documents. Postings of a common term are
ranked within tasks before they are shuffled. Documents are joined with pairs that need them by their row.

Edge cases: null texts and texts without terms are neither counted nor ranked; each row is a document, so a repeated row
can be ranked twice; null ids come after all others among equal scores; rows of one item id, null too, are one item with
the terms of all; terms without weight score nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.llm.common import cut, kept

#: Bytes that part terms, all of ASCII but letters and digits, as blanks; A-Z as a-z; other bytes as they are.
TERM_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Terms up to this number are handed to the tasks to leave out others at once; beyond it only the join does so.
HANDED_TERMS = 500_000
#: Rows of a table of terms, pairs or weights that are broadcast.
BROADCAST_ROWS = 200_000
#: Documents that are scored in full to seed an item's threshold, as a multiple of ``k``.
SEEDED = 3


def terms_of(text: str | None) -> Counter:
    return Counter((text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split())


def _counted(wanted: frozenset[bytes] | None):
    """Batches of ``id, text`` as ``id, n, terms, counts`` of the wanted terms, or of all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, terms, counts = batch.column(0), [], [], []
            for text in batch.column(1):
                found = terms_of(text.as_py())
                own = found if wanted is None else found.keys() & wanted
                sizes.append(found.total())
                terms.append([t.decode() for t in own])
                counts.append([found[t] for t in own])
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))], names=["id", "n", "terms", "counts"])

    return count


def _term_counts(rows: DataFrame, wanted: frozenset[bytes] | None = None) -> DataFrame:
    """``id, n, terms, counts`` of ``rows`` (``id, text``)."""
    kind = dict(rows.dtypes)["id"]
    return rows.select("id", F.col("text").cast("string").alias("text")).mapInArrow(_counted(wanted), f"id {kind}, n long, terms array<string>, counts array<long>")


def _postings(counted: DataFrame, *others: str) -> DataFrame:
    return counted.select(*others, F.explode(F.arrays_zip("terms", "counts")).alias("of")).select(*others, F.col("of.terms").alias("term"), F.col("of.counts").alias("tf"))


def _impact(docs_n: int, terms_n: int) -> Column:
    """What a term of weight ``w`` that occurs ``tf`` times adds to the score of a document of ``n`` terms; integers throughout."""
    m = f"(25L + (75L * n * {docs_n}L) div {max(terms_n, 1)}L)"
    return F.expr(f"w * ((1000000000L * tf) div (1000L * tf + 8L * {m}))")


def _small(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if they are few; Spark splits skewed partitions of the join otherwise."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def _first(rows: DataFrame, k: int, by: list[str], order: list[Column]) -> DataFrame:
    """The first ``k`` rows of each ``by`` with their ``rank``; Spark limits them within tasks first."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def _scores(pairs: DataFrame, counted: DataFrame, asked: DataFrame, impact: Column) -> DataFrame:
    """``item, row, id, score``: the scores of the ``pairs`` (``item, row``) over all terms of the item."""
    met = _postings(counted.join(_small(pairs.select("item", "row")), "row"), "item", "row", "id", "n")
    met = met.join(_small(asked.select("item", "term", "q", "w")), ["item", "term"])
    return met.groupBy("item", "row").agg(F.first("id").alias("id"), F.sum(F.col("q") * impact).alias("score"))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` (the first and third as they are named): each item's ``k`` best documents with a score above 0."""
    own = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    ids = kept(own.select("id").distinct().withColumn("item", F.monotonically_increasing_id()))
    words = _postings(_term_counts(own), "id").groupBy("id", "term").agg(F.sum("tf").alias("q"))
    words = cut(words.withColumnRenamed("id", "__id").join(ids, F.col("__id").eqNullSafe(ids["id"])).select("item", "term", "q"))
    terms = words.select("term").distinct()
    few = terms.limit(HANDED_TERMS + 1).count() <= HANDED_TERMS
    wanted = frozenset(r.term.encode() for r in terms.toLocalIterator()) if few else None

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = kept(_term_counts(rows, wanted).filter("n > 0").withColumn("row", F.monotonically_increasing_id()))
    docs_n, terms_n = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    impact = _impact(docs_n, terms_n)
    postings = _postings(counted, "row", "n")

    held = _postings(counted, "row").join(_small(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * docs_n + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = cut(held.select("term", weight.alias("w")).filter("w > 0"))
    every = postings.join(_small(weights), "term").select("term", "row", impact.alias("impact"))
    stored = cut(_first(every, k, ["term"], [F.desc("impact"), F.col("row")]))
    bounds = stored.groupBy("term").agg(F.max("impact").alias("bound"))
    asked = cut(words.join(weights.join(bounds, "term"), "term").select("item", "term", "q", "w", (F.col("q") * F.col("bound")).alias("bound")))

    partly = stored.join(_small(asked), "term").groupBy("item", "row").agg(F.sum(F.col("q") * F.col("impact")).alias("least"))
    seeds = cut(_first(partly, SEEDED * k, ["item"], [F.desc("least"), F.col("row")]))
    kth = _first(_scores(seeds, counted, asked, impact), k, ["item"], [F.desc("score")]).filter(F.col("rank") == k).select("item", F.col("score").alias("threshold"))

    tail = Window.partitionBy("item").orderBy(F.desc("bound"), "term").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sized = asked.join(kth, "item", "left").withColumn("threshold", F.coalesce("threshold", F.lit(0))).withColumn("tail", F.sum("bound").over(tail))
    pruned = F.col("tail") < F.col("threshold")
    rest = F.coalesce(F.max(F.when(pruned, F.col("tail"))).over(Window.partitionBy("item")), F.lit(0))
    seeking = cut(sized.withColumn("needed", F.col("threshold") - rest).filter(~pruned).select("item", "term", "q", "w", "needed"))
    met = postings.join(_small(seeking), "term").groupBy("item", "row").agg(F.sum(F.col("q") * impact).alias("sofar"), F.first("needed").alias("needed"))
    candidates = cut(met.filter("sofar >= needed").select("item", "row"))
    best = _first(_scores(candidates, counted, asked, impact).filter("score > 0"), k, ["item"], [F.desc("score"), F.asc_nulls_last("id"), F.col("row")])
    return best.join(ids.withColumnRenamed("id", "__item"), "item").select(F.col("__item").alias(item_id), "rank", F.col("id").alias(id_col), "score")
