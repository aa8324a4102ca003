"""Rare letters, repeated rows, hot keys, null ids in number, and the configuration programme against an exact one."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordwatch.llm import bpe, common, exact_dedup, fingerprints, packing, quality, simhash_dedup, toxicity
from recordwatch.llm.queries import tokenizer_path

DOCS = "doc_id long, text string"


def test_letters_whose_lower_cases_are_far():
    from tokenizers import Tokenizer

    library, coder = Tokenizer.from_file(tokenizer_path()), bpe.Bpe(bpe.read_spec(tokenizer_path()))
    texts = [f"{c}liyev x{c} {c}" for c in "ƁƆƉƊƏƐƓƔƖƗƜƝƟƦƩƮƱƲƷȺȾɄɅẞK"]
    rng = random.Random(9)
    blocks = [range(0x20, 0x250), range(0x250, 0x600), range(0x1E00, 0x2150), range(0x3040, 0x3100), range(0x1F300, 0x1F400)]
    texts += ["".join(chr(rng.choice(rng.choice(blocks))) for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(coder.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


@pytest.mark.parametrize("drop", [exact_dedup.drop_copies, simhash_dedup.drop_near_copies])
def test_one_row_of_each_group_stays(spark, drop):
    rows = [(None, "x y", 1)] * 3 + [(4, "q", 2)] * 2 + [(7, "q", 3), (8, "r s t u v", 4), (None, "r s t u v", 5), (9, None, 6), (9, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key0 int")
    got = sorted(((r.doc_id, r.text or "") for r in drop(docs).collect()), key=str)
    assert got == sorted([(None, "x y"), (4, "q"), (8, "r s t u v"), (9, "")], key=str)
    assert drop(docs).columns == docs.columns


def test_hot_keys_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rows = spark.createDataFrame([(k % 3 if k < 90 else k, k) for k in range(100)], "g long, k long")
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("least"))
    got = sorted((r.k, r.least) for r in common.by_hot_key(rows, groups, "g", "n", F.col("k")).collect())
    assert got == [(k, k % 3 if k < 90 else k) for k in range(100)]


def test_many_null_ids_are_in_order(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET_BITS", 2)
    rows = [(None, f"text {k}") for k in range(40)] + [(k * 10**15, f"t {k}") for k in range(-5, 9)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    h = dict(docs.filter("doc_id is null").select("text", F.shiftrightunsigned(F.xxhash64("text"), 1)).collect())
    order = [f"t {k}" for k in range(8, -6, -1)] + sorted(h, key=lambda t: -h[t])
    got = {r.text: r.next_text for r in fingerprints.with_next_text(docs).filter("guest = 0").collect()}
    assert got == {t: order[(k + 1) % len(order)] for k, t in enumerate(order)}


def test_extra_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c", "h", "p", 1.0, "x")], "doc_id long, text string, source string, lang string, __toxic_score double, __host string")
    docs = docs.withColumn("__evidence", F.lit(3)).withColumn("__path", F.lit(4))
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    for drop in (toxicity.drop_toxic, quality.drop_poor):
        assert [r.asDict() for r in drop(docs, labels).collect()] in ([], [r.asDict() for r in docs.collect()])
        assert drop(docs, labels).columns == docs.columns


def exact_value(stock, capacity):
    """The programme's value by its dual, solved exactly: the best vertex of prices under all configurations."""
    sizes = sorted(stock)
    every = [c for c in itertools.product(*[range(capacity // s + 1) for s in sizes]) if any(c) and sum(n * s for n, s in zip(c, sizes)) <= capacity]
    rows = [(list(map(Fraction, c)), Fraction(1)) for c in every] + [([Fraction(-(i == k)) for i in range(len(sizes))], Fraction(0)) for k in range(len(sizes))]
    best = Fraction(0)
    for chosen in itertools.combinations(rows, len(sizes)):
        a = [list(r) + [b] for r, b in chosen]
        for i in range(len(sizes)):
            pivot = next((k for k in range(i, len(sizes)) if a[k][i]), None)
            if pivot is None:
                break
            a[i], a[pivot] = a[pivot], a[i]
            a[i] = [x / a[i][i] for x in a[i]]
            for k in range(len(sizes)):
                if k != i and a[k][i]:
                    a[k] = [x - a[k][i] * y for x, y in zip(a[k], a[i])]
        else:
            y = [r[-1] for r in a]
            if all(sum(p * q for p, q in zip(r, y)) <= b for r, b in rows):
                best = max(best, sum(stock[s] * p for s, p in zip(sizes, y)))
    return float(best)


@pytest.mark.parametrize("histogram", [{3: 9, 5: 4}, {6: 10, 4: 11}, {7: 5, 6: 8, 3: 20}, {4: 30, 5: 7, 9: 2}])
def test_programme_against_an_exact_solution(histogram):
    exact = exact_value(histogram, 10)
    stock = np.zeros(11, np.int64)
    for size, n in histogram.items():
        stock[size] = n
    found = packing.solve(stock, 10)
    assert found.bound <= exact + 1e-6 and exact - 1e-6 <= found.value <= 1.15 * exact
    covered = {s: sum(x * dict(key).get(s, 0) for key, x in found.sequences.items()) for s in histogram}
    assert all(covered[s] >= n - 1e-6 for s, n in histogram.items())
    planned = packing.plan(histogram, 10)
    assert planned.bound <= np.ceil(exact - 1e-6) <= planned.sequences <= exact + 2


def test_most_sequences_come_from_the_programme():
    rng = np.random.default_rng(5)
    sizes = np.clip(rng.lognormal(4, 1, 20_000).astype(int) + 1, 1, 512)
    planned = packing.plan({int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True))}, 512)
    assert planned.sequences <= 1.005 * planned.bound + 1 and planned.rounded >= 0.8 * planned.sequences
