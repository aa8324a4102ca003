"""SimHash in Catalyst expressions: terms are exploded and their bits voted on in one hash aggregation.

A sum of longs holds two counters of 32 bits, so 32 sums count the votes for 64 bits. Counters stay below their
limit up to 2**32 - 1 units of weight in one text.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR = (1 << 32) | 1
LANES = 32


def words(text: Column) -> Column:
    """Words of a text, lower-cased; none for a blank text."""
    flat = F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " ")
    return F.filter(F.split(flat, " "), lambda w: w != "")


def windows(found: Column, size: int) -> Column:
    """Array of structs of ``size`` words in a row, one for each word; those at the end hold nulls."""
    n = F.greatest(F.size(found), F.lit(1))
    rest = [F.slice(found, F.lit(k + 1), n).alias(f"w{k}") for k in range(1, size)]
    return F.arrays_zip(found.alias("w0"), *rest) if rest else F.transform(found, lambda w: F.struct(w.alias("w0")))


def votes(term_hash: Column, doublings: Column | None = None) -> list[Column]:
    """Sums that count, for each bit, the weight of the terms whose hash has it, and the whole weight.

    A term weighs 1, or 1 doubled ``doublings`` times: shifting both counters costs little, multiplying them much.
    """
    weigh = lambda c: c if doublings is None else F.call_function("shiftleft", c, doublings)
    bits = [F.sum(weigh(F.shiftrightunsigned(term_hash, k).bitwiseAND(F.lit(PAIR)))).alias(f"v{k}") for k in range(LANES)]
    return [*bits, F.sum(weigh(F.lit(1).cast("long"))).alias("whole")]


def fingerprint() -> Column:
    """The fingerprint (signed long) of the sums that :func:`votes` made; zero without terms."""
    whole = F.coalesce(F.col("whole"), F.lit(0))
    out = F.lit(0).cast("long")
    for k in range(LANES):
        v = F.coalesce(F.col(f"v{k}"), F.lit(0))
        for bit, count in ((k, v.bitwiseAND(F.lit((1 << 32) - 1))), (k + 32, F.shiftrightunsigned(v, 32))):
            out = out.bitwiseOR(F.when(count * 2 > whole, F.lit((1 << bit) - (1 << 64 if bit == 63 else 0))).otherwise(F.lit(0)).cast("long"))
    return out


def block_masks(blocks: int, radius: int) -> list[int]:
    """Masks (signed longs) of the permuted tables: every choice of ``blocks - radius`` leading blocks of 64 bits."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [sum(1 << i for i in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = (sum(x) for x in combinations(parts, blocks - radius))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def blocks_for(n: int, radius: int) -> int:
    """The fewest blocks whose keys tell ``n`` fingerprints apart by chance; the links found are the same for any number."""
    blocks = radius + 2
    while blocks < 16 and 64 * (blocks - radius) / blocks < n.bit_length() + 4:
        blocks += 1
    return blocks


def with_keys(fps: DataFrame, masks: list[int], fp: str = "fp") -> DataFrame:
    """``fps`` once per table, with the table's number ``t`` and the leading blocks ``key``."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).alias("mask")) for t, m in enumerate(masks)])
    return fps.select("*", F.inline(tables)).withColumn("key", F.col(fp).bitwiseAND(F.col("mask"))).drop("mask")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def hexed(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
