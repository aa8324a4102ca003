"""SimHash near-deduplication by covering locality-sensitive hashing.

Each of the 64 bits gets a non-zero vector of r + 1 bits; for every non-zero vector v there is a table whose
key keeps the bits whose vector has an odd product with v. Any r bits span too little to rule out every v,
so two fingerprints that differ in r bits or fewer agree on the whole key of some table: no pair is missed.

Fingerprints are first made distinct, so copies cost nothing. Within a bucket, fingerprints are compared
in memory and only the links of a spanning forest leave the task. Buckets of more than ``bucket`` fingerprints
take an exact way of linear cost instead: two fingerprints within 4 bits share a point within 2 bits of
each, so linking every fingerprint to the smallest that shares one of the 2081 points around it finds the
same groups without looking at pairs.

Edge cases: a null or empty text, or one of white space only, has fingerprint zero and links like any other;
fewer than four words are one shingle; a null id is ignored when the smallest id of a group is sought (a group
of null ids alone has a null component); repeated rows are copies; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwatch.llm.common import by_hot_key, cut, kept, text_or_empty, without_repeats
from recordwatch.llm.components import connected

SHINGLE_WORDS, SEED, RADIUS = 4, 42, 4
#: Fingerprints of one bucket that a task compares in memory; larger buckets take the linear way.
BUCKET = 4096


def fingerprint(text: str) -> int:
    """64-bit SimHash of the word shingles of ``text``; a bit is set if it is in over half of their hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -SHINGLE_WORDS])).tolist()
    stops = (ends[SHINGLE_WORDS - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        votes += np.unpackbits(hashes[k : k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, mark, fp`` of each row; mark is a hash of the text, fp the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["id", "mark", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_or_empty(text_col)
    return docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("mark"), text.alias("text")).mapInArrow(run, f"id {kind}, mark long, fp long")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Key masks of the 2**(radius + 1) - 1 tables, as signed longs; a fixed multiplicative rule deals out the vectors."""
    size = (1 << (radius + 1)) - 1
    vectors = [(i * 11 + i // size) % size + 1 for i in range(bits)]
    masks = (sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size + 1))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(fps: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """For each of the sorted buckets' fingerprints the index of its group's first one, comparing all of a bucket."""
    label, n = np.arange(len(fps)), len(fps)
    at = np.arange(n)
    step = 1
    while True:
        at = at[at + step < n]
        at = at[bucket[at] == bucket[at + step]]
        if not len(at):
            return label
        i = at[np.bitwise_count((fps[at] ^ fps[at + step]).view(np.uint64)) <= radius]
        j = i + step
        while len(i):
            low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
            differ = low != high
            i, j = i[differ], j[differ]
            if len(i):
                np.minimum.at(label, high[differ], low[differ])
                while (label[label] != label).any():
                    label = label[label]
        step += 1


def bucket_links(rows: DataFrame, radius: int, bucket: int) -> DataFrame:
    """Links within the buckets of ``rows`` (t, key, fp; sorted within partitions): ``a, b``; b is null where a's bucket is too large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            return pa.record_batch([pa.array(a, pa.int64()), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())], ["a", "b"])

        keep = [np.empty(0, np.int64)] * 3
        large = None
        for batch in batches:
            t, key, fp = (np.concatenate((k, batch.column(c).to_numpy())) for c, k in enumerate(keep))
            if not len(t):
                continue
            if large is not None:  # the bucket that was too large goes on
                same = (t == large[0]) & (key == large[1])
                if same.any():
                    yield out(fp[same], None)
                    t, key, fp = t[~same], key[~same], fp[~same]
                    if not len(t):
                        keep = [t, key, fp]
                        continue
                large = None
            new = np.concatenate(([True], (t[1:] != t[:-1]) | (key[1:] != key[:-1])))
            number = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(t)))
            last = starts[-1]
            heavy = sizes > bucket
            if heavy[-1]:
                large, last_done = (t[-1], key[-1]), len(t)
            else:
                last_done = last
            for k in np.flatnonzero(heavy):
                yield out(fp[starts[k] : starts[k] + sizes[k]], None)
            use = (~heavy[number]) & (np.arange(len(t)) < last_done) & (sizes[number] > 1)
            if use.any():
                x = fp[use]
                label = forest(x, number[use], radius)
                linked = label != np.arange(len(x))
                yield out(x[linked], x[label[linked]])
            keep = [t[last_done:], key[last_done:], fp[last_done:]]
        if len(keep[0]) > 1:
            x = keep[2]
            label = forest(x, np.zeros(len(x), np.int64), radius)
            linked = label != np.arange(len(x))
            yield out(x[linked], x[label[linked]])

    return rows.mapInArrow(run, "a long, b long")


def points_around(fps: DataFrame, radius: int) -> DataFrame:
    """``fp, z`` for every z within half the radius of fp: the exact way for crowded buckets."""
    if radius > 4:
        raise ValueError("points within two bits cover radii up to 4")
    flips = [0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i in range(64) for j in range(i))]
    signed = np.array(flips, np.uint64).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_pylist():
                yield pa.record_batch([pa.array(np.full(len(signed), fp), pa.int64()), pa.array(signed ^ fp, pa.int64())], ["fp", "z"])

    return fps.mapInArrow(run, "fp long, z long")


def near_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect exactly what all pairs of the distinct ``fp`` within ``radius`` bits connect."""
    masks = F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(m).alias("mask")) for t, m in enumerate(covering_masks(radius))])
    keys = fps.select("fp", F.inline(masks)).select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    dealt = keys.repartition("t", "key").sortWithinPartitions("t", "key", "fp")
    links = cut(bucket_links(dealt, radius, bucket))
    crowded = links.filter("b is null").select(F.col("a").alias("fp")).distinct()
    plain = links.filter("b is not null")
    if crowded.isEmpty():
        return plain
    around = points_around(crowded, radius)
    least = around.groupBy("z").agg(F.min("fp").alias("b"))
    star = around.join(least, "z").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return plain.unionByName(star)


def _grouped(docs: DataFrame, id_col: str, text_col: str, radius: int, bucket: int) -> DataFrame:
    """``id, mark, fp, root, component_id`` of each row; rows of equal ``root`` are of one group."""
    rows = cut(fingerprints(docs, id_col, text_col))
    first = cut(rows.groupBy("fp").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")))
    roots = cut(connected(near_links(first.select("fp"), radius, bucket)))
    named = first.join(roots, first.fp == roots.node, "left").select("fp", "first_id", "copies", F.coalesce("root", "fp").alias("root"))
    least = cut(named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("fingerprints")))
    told = cut(by_hot_key(named, least, "root", "fingerprints", F.col("fp")).select("fp", "copies", "root", "component_id"))
    return by_hot_key(rows, told, "fp", "copies", F.struct("id", "mark")).select("id", "mark", "fp", "root", "component_id")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``id_col, fingerprint, component_id`` of each row; the component is the smallest id that links lead to."""
    found = _grouped(docs, id_col, text_col, radius, bucket)
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one row of each group; all columns stay.

    It is the row of the smallest id, of null ids and of equal ids that of the smallest hash of the text, and of
    repeated rows any one.
    """
    found = kept(_grouped(docs, id_col, text_col, radius, bucket))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("r")).select(F.col("r.id").alias("id"), F.col("r.mark").alias("mark"))
    same = lambda df: df[id_col].eqNullSafe(first["id"]) & (_mark(df, text_col) == first["mark"])
    stay = docs.join(first, same(docs), "left_semi")
    counted = found.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", "mark")
    repeated = counted.join(first, counted["id"].eqNullSafe(first["id"]) & (counted["mark"] == first["mark"]), "left_semi")
    return without_repeats(stay, [stay[id_col], _mark(stay, text_col)], repeated)


def _mark(df: DataFrame, text_col: str) -> Column:
    return F.xxhash64(F.coalesce(df[text_col].cast("string"), F.lit("")))
