"""Document fingerprints: SimHash of weighted terms, and a search by permuted block tables.

A term is a run of words; its weight is 1, 2, 4 or 8, by its length. Each term's hash votes on 64 signed bits with its
weight. Fingerprints within a Hamming radius r are found by tables that lead with every choice of all but r of the
blocks a fingerprint is cut into: two within r bits agree on the leading blocks of some table.

Edge cases: null and empty texts, and those of white space only, have fingerprint zero; repeated rows have equal
fingerprints, and follow one another; rows with null ids come last, in the order of their texts' hashes; the document next
to the only one is itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.llm import simhash_native as S
from recordwatch.llm.common import cut, text_or_empty

TERM_WORDS, RADIUS = 2, 3
#: Search queries are the rows whose id this divides.
QUERY_EVERY = 50
#: Ids of one bucket, as a power of two: the order of all ids without one task that sees them all.
BUCKET_BITS = 10

NO_BUCKET = -(1 << 63)


def text_fingerprints(rows: DataFrame, keys: list[str], text: str = "text", term_words: int = TERM_WORDS) -> DataFrame:
    """``keys`` and ``fp`` of each row; the rows of equal keys count as one text."""
    terms = rows.select(*keys, F.inline_outer(S.windows(S.words(F.col(text)), term_words)))
    parts = [f"w{k}" for k in range(term_words)]
    letters = sum((F.coalesce(F.char_length(p), F.lit(0)) for p in parts), F.lit(0))
    # A term that inline_outer makes up for a text without words has no hash, and so no vote.
    hashed = terms.select(*keys, F.when(F.col("w0").isNotNull(), F.xxhash64(*parts)).alias("h"), F.least(F.shiftright(letters, 2), F.lit(3)).cast("int").alias("doublings"))
    return hashed.groupBy(*keys).agg(*S.votes(F.col("h"), F.col("doublings"))).select(*keys, S.fingerprint().alias("fp"))


def _next_buckets(rows: DataFrame) -> DataFrame:
    """``bucket, next_bucket``: the next lower bucket that has rows, for the lowest the highest.

    The buckets are dealt out by ranges, whatever the ids are like; only the ends of the ranges, one row a partition, are ordered in one task.
    """
    ranges = cut(rows.select("bucket").distinct().repartitionByRange(F.desc("bucket")).select("bucket", F.spark_partition_id().alias("part")))
    tops = ranges.groupBy("part").agg(F.max("bucket").alias("top"))
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = tops.select("part", F.coalesce(F.lead("top").over(order), F.max("top").over(whole)).alias("below"))
    following = F.lead("bucket").over(Window.partitionBy("part").orderBy(F.desc("bucket")))
    return ranges.withColumn("following", following).join(F.broadcast(ends), "part").select("bucket", F.coalesce("following", "below").alias("next_bucket"))


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket, place, guest, id, text, next_text``: each row and the next one in descending id, the last one's is the first.

    Rows are ordered in buckets of 1024 ids, those of null ids in buckets of hashes. The first row of the next bucket is a
    guest at the end of each, so texts are shuffled once, or twice at most where ids are so sparse that each has a bucket; guests have no next text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    nulls = docs.filter(F.col(id_col).isNull()).count()
    bits = max(0, nulls.bit_length() - BUCKET_BITS)
    hashed = F.when(F.col("id").isNull(), F.shiftrightunsigned(F.xxhash64("text"), 1))
    among_nulls = F.lit(NO_BUCKET) + F.shiftright(hashed, 63 - bits) if bits else F.lit(NO_BUCKET)
    rows = rows.withColumn("hashed", hashed).withColumn("bucket", F.coalesce(F.shiftright("id", BUCKET_BITS), among_nulls)).withColumn("guest", F.lit(0))
    order = [F.desc_nulls_last("id"), F.desc("hashed"), F.asc("text")]
    heads = rows.withColumn("n", F.row_number().over(Window.partitionBy("bucket").orderBy(*order))).filter("n = 1")
    heads = heads.select(F.col("bucket").alias("next_bucket"), "id", "hashed", "text")
    guests = heads.join(_next_buckets(rows), "next_bucket").select("id", "hashed", "text", "bucket", F.lit(1).alias("guest"))
    place = Window.partitionBy("bucket").orderBy("guest", *order)
    both = rows.unionByName(guests)
    return both.select("bucket", F.row_number().over(place).alias("place"), "guest", "id", "text", F.lead("text").over(place).alias("next_text"))


def edited_text() -> Column:
    """The text with its last third replaced by the beginning of the next."""
    n = F.char_length("text")
    third = F.expr("char_length(text) div 3").cast("int")
    return F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))


def within_radius(fps: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """``q, fp`` of every distinct fingerprint of ``fps`` within ``radius`` bits of one of ``queries`` (column q), itself included."""
    masks = S.block_masks(blocks or S.blocks_for(fps.count(), radius), radius)
    index, asked = S.with_keys(fps.select("fp"), masks), S.with_keys(queries.select("q"), masks, "q")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius
    return asked.join(index, ["t", "key"]).filter(near).select("q", "fp").distinct()


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Fingerprints of each text and of its edited copy, their likenesses, and what the search finds.

    ``near_rows`` is the number of other rows whose fingerprint is within ``radius`` bits, for rows whose id is
    divisible by 50 and null for others.
    """
    placed = with_next_text(docs, id_col, text_col).withColumn("edited", edited_text())
    keys = ["bucket", "place", "guest", "id", "n_chars", "edited_sha256"]
    told = placed.select(
        "bucket", "place", "guest", "id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.inline(F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")))),
    )
    both = text_fingerprints(told, [*keys, "version"], "body").groupBy(*keys).agg(
        F.max(F.when(F.col("version") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("version") == 1, F.col("fp"))).alias("edited_fp")
    )
    following = both.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("bucket").orderBy("place"))).filter("guest = 0")
    found = cut(following.select("id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp"))
    counted = cut(found.groupBy("fp").agg(F.count(F.lit(1)).alias("n")))
    asked = found.filter(F.col("id") % QUERY_EVERY == 0).select(F.col("fp").alias("q")).distinct()
    hits = within_radius(counted, asked, radius).join(counted, "fp").groupBy("q").agg((F.sum("n") - 1).alias("near_rows"))
    return found.join(hits, found.fp == hits.q, "left").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", S.hexed(F.col("fp")).alias("fingerprint"), S.hexed(F.col("edited_fp")).alias("edited_fingerprint"),
        S.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), S.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("id") % QUERY_EVERY == 0, F.col("near_rows")).alias("near_rows"),
    )
