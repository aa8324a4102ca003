"""References of generated points to records: allowed pairs, alignment and repair, rules on wording."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def allowed_pairs(records: DataFrame, record: str, url: str) -> DataFrame:
    """Distinct pairs of id and normalized address, both filled, one address per id (the first by text)."""
    rows = records.filter((F.coalesce(record, F.lit("")) != "") & (F.coalesce(url, F.lit("")) != ""))
    return rows.groupBy(F.col(record).alias("ref_id")).agg(F.min(url).alias("ref_url"))


def references(points: DataFrame, point: str, ids: str, urls: str) -> DataFrame:
    """One row per reference of a point: ids and addresses paired by place, the longer list deciding how many."""
    paired = F.arrays_zip(F.col(ids).alias("id"), F.col(urls).alias("url"))
    return points.select(point, F.posexplode(paired).alias("pos", "pair")).select(point, "pos", F.nullif(F.trim("pair.id"), F.lit("")).alias("id"), F.nullif(F.trim("pair.url"), F.lit("")).alias("url"))


def align(refs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each reference checked against the allowed pairs: kept, repaired from the half that is known, or invalid.

    Adds ``status, record_id, record_url``. The known id wins over a known address that belongs to another record.
    """
    by_id = pairs.select(F.col("ref_id").alias("__id"), F.col("ref_url").alias("url_of_id"))
    by_url = pairs.groupBy(F.col("ref_url").alias("__url")).agg(F.min("ref_id").alias("id_of_url"))
    joined = refs.join(by_id, refs["id"] == by_id["__id"], "left").join(by_url, refs["url"] == by_url["__url"], "left")
    status = (
        F.when(F.col("url_of_id").isNotNull() & (F.col("url_of_id") == F.col("url")), "valid")
        .when(F.col("url_of_id").isNotNull(), "url_repaired")
        .when(F.col("id_of_url").isNotNull(), "id_repaired")
        .otherwise("invalid")
    )
    return joined.select(
        *refs.columns, status.alias("status"), F.when(F.col("url_of_id").isNotNull(), F.col("id")).otherwise(F.col("id_of_url")).alias("record_id"),
        F.when(F.col("url_of_id").isNotNull(), F.col("url_of_id")).when(F.col("id_of_url").isNotNull(), F.col("url")).alias("record_url"),
    )


def alignment_counts(aligned: DataFrame, keys: list[str]) -> DataFrame:
    """References by status, repeated ones, and the verdict: failed without any usable one, repaired, or passed."""
    n = {s: F.count_if(F.col("status") == s) for s in ("valid", "url_repaired", "id_repaired", "invalid")}
    usable = F.count("record_id")
    verdict = F.when(usable == 0, "failed").when(n["url_repaired"] + n["id_repaired"] + n["invalid"] + usable - F.countDistinct("record_id") > 0, "repaired").otherwise("passed")
    return aligned.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_refs"), *[c.alias(f"n_{s}") for s, c in n.items()], (usable - F.countDistinct("record_id")).alias("n_repeated"), verdict.alias("verdict")
    )


def wording_violations(points: DataFrame, statuses: DataFrame, banned: dict[str, list[str]]) -> DataFrame:
    """Points whose text says what the statuses of their records don't bear out.

    ``points``: point, text. ``statuses``: point, change_status, one row per reference. ``banned``: phrases by status, forbidden if
    all references of a point have that status.
    """
    all_of = statuses.groupBy("point").agg(F.min("change_status").alias("low"), F.max("change_status").alias("high")).filter("low = high")
    rows = points.join(all_of, "point")
    found = [F.when((F.col("low") == s) & F.contains(F.lower("text"), F.lit(p.lower())), F.lit(p)) for s, ps in banned.items() for p in ps]
    return rows.withColumn("phrases", F.array_compact(F.array(*found))).filter(F.size("phrases") > 0).select("point", F.col("low").alias("change_status"), "phrases")
