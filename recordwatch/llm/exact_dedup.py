"""Exact deduplication by skew-safe combining.

Texts are equal when identical after each run of ASCII white space becomes one blank. Copies are first
merged within each map task, then over tasks that share a salt, then over the salts of a digest. Each
of these steps groups by the whole text beside its digest, so two texts that share a digest stay apart,
and the largest group of copies reaches a task as one row per map task, then as one row per salt.

Edge cases: a null text counts as empty; all empty texts are copies of one another; a row with a null id
counts in its group's size and loses to any id; a repeated row (same id, same text) adds to the group's
size and appears once per row in the result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwatch.llm.common import by_hot_key, cut, kept, text_or_empty, without_repeats

#: Salts over which the copies of one text are first combined; each holds a share of the map tasks.
SALTS = 16


def squeezed(text: Column) -> Column:
    """``text`` with each run of blanks, tabs and line ends replaced by one blank."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Each row's group: ``id_col, keep_id, group_size, kept, text_sha256``; of equal texts the smallest id stays.

    The merged groups are narrow and are written to the checkpoint folder. Rows find their group by digest
    alone where the merging has shown that only one text has it; a digest of several texts (none, with
    SHA-256) is joined by its text too.
    """
    rows = docs.select(docs[id_col].alias("id"), squeezed(text_or_empty(text_col)).alias("body"))
    rows = rows.withColumn("digest", digest(F.col("body")))
    local = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = local.groupBy("digest", "salt", "body").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    merged = salted.groupBy("digest", "body").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))
    by_digest = cut(
        merged.groupBy("digest").agg(
            F.count(F.lit(1)).alias("bodies"), F.min("keep_id").alias("keep_id"), F.min("group_size").alias("group_size")
        )
    )
    place = F.struct(F.spark_partition_id(), "id")
    each = rows.select("id", "digest", F.sha2("body", 256).alias("sha"), F.xxhash64(place).alias("place"))
    out = by_hot_key(each, by_digest.filter("bodies = 1").drop("bodies"), "digest", "group_size", F.col("place")).drop("place")
    if not by_digest.filter("bodies > 1").isEmpty():
        shared = rows.join(by_digest.filter("bodies > 1").select("digest"), "digest", "left_semi")
        compared = shared.join(merged, ["digest", "body"]).withColumn("sha", F.sha2("body", 256))
        out = out.unionByName(compared.drop("body"))
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one of the smallest id; all columns stay.

    The rows to drop are found by id and text, in an anti join; of repeated rows with the id that stays, any one stays.
    """
    found = kept(exact_groups(docs, id_col, text_col).select(F.col(id_col).alias("lost"), "kept", F.col("text_sha256").alias("sha")))
    body = lambda df: F.sha2(squeezed(F.coalesce(df[text_col].cast("string"), F.lit(""))), 256)
    lost = found.filter(~F.col("kept"))
    stay = docs.join(lost, docs[id_col].eqNullSafe(lost["lost"]) & (body(docs) == lost["sha"]), "left_anti")
    repeated = found.filter("kept").groupBy("lost", "sha").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("lost", "sha")
    return without_repeats(stay, [stay[id_col], body(stay)], repeated)
