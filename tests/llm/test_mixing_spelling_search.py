"""Source mixing, spelling variants and lexical search against plain versions, and their odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordwatch.llm import lexical_search, mixing, spelling
from recordwatch.llm.queries import op12_spelling_variants
from recordwatch.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
SOURCED = "doc_id long, text string, source string"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, total = {}, set(names), share * sum(sizes.values())
    while left:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        above = {s for s in left if level * weight[s] > most * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in left}
        target |= {s: most * sizes[s] for s in above}
        left -= above
    return target


def mixed_docs():
    rng = random.Random(4)
    rows = [(k, " ".join("w" * rng.randint(1, 9) for _ in range(rng.choice([0, 1, 5, 60, 400]))), rng.choice(["hot"] * 6 + ["b", "é", "a\U0001f600", "z", None])) for k in range(900)]
    return rows + [(None, "a b\tc", "b"), (None, "d e", "none of size"), (7, None, "empty"), (8, "", "empty"), (9, " \n", None), (5, "x y", "b"), (5, "x y", "b")]


def test_mix_against_a_plain_version(spark):
    rows = mixed_docs()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = plain_targets(sizes)
    docs = spark.createDataFrame(rows, SOURCED).withColumn("copy", F.lit("theirs")).withColumn("copies", F.lit(1)).withColumn("__key", F.lit(2))
    report = mixing.rates(docs)
    assert {r.source for r in report.collect()} == set(sizes)
    for r in report.collect():
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
        largest = max(len((t or "").split()) for _, t, s in rows if s == r.source)
        assert abs(r.taken - r.target) <= max(0.03 * r.target, largest)
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "_copy"]
    taken = Counter()
    emitted = Counter()
    for r in out.collect():
        taken[r.source] += len((r.text or "").split())
        emitted[r.doc_id, r.text] += 1
    assert taken == Counter({r.source: r.taken for r in report.collect() if r.taken})
    sized = mixing.mix_sizes(docs).collect()
    assert len(sized) == len(rows) and all(r.taken in (0, r.size, 2 * r.size) for r in sized)
    again = mixing.mix_sizes(docs.repartition(7)).collect()
    assert sorted(map(str, sized)) == sorted(map(str, again))
    rate = {s: target[s] / sizes[s] if sizes[s] else 0 for s in sizes}
    for doc_id, text, source in rows:
        if rows.count((doc_id, text, source)) == 1 and doc_id is not None and text not in (None, ""):
            assert math.floor(rate[source]) <= emitted[doc_id, text] <= math.ceil(rate[source] + 1e-9)


def test_copies_come_with_the_probability_of_the_fraction(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") % 4 > 0, "x").otherwise("y").alias("source"))
    seen = {r.source: (r.rate, r.copies) for r in mixing.with_copies(docs, mixing.rates(docs, weights=(1, 1), share=1.2), "copies").groupBy("source").agg(F.avg("copies").alias("copies"), F.first(F.col("of_source.target") / F.col("of_source.source_size")).alias("rate")).collect()}
    for rate, copies in seen.values():
        assert abs(rate - copies) < 0.01
    assert seen["y"][0] == 2.0 and 0.9 < seen["x"][0] < 1


def test_many_sources_are_dealt_out(spark, monkeypatch):
    docs = spark.createDataFrame(mixed_docs(), SOURCED)
    whole = sorted(map(str, mixing.mix_sizes(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    from recordwatch.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 20)
    assert sorted(map(str, mixing.mix_sizes(docs).collect())) == whole


def test_limits_hold_when_all_sources_are_full(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "c", "t")], SOURCED)
    assert sorted(r.taken for r in mixing.mix_sizes(docs, share=2.0).collect()) == [2, 4]
    assert mixing.mix(docs, share=5.0).count() == 4
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mix_sizes(docs.limit(0)).collect() == []
    assert mixing.mix(docs.withColumn("text", F.lit(None).cast("string"))).collect() == []


def plain_words(rows, every=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(counts):
    """By the words with one code point left out: two words are one edit apart if they share one, checked in full."""

    def edits(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    holes = {}
    for w in counts:
        for hole in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))}:
            holes.setdefault(hole, set()).add(w)
    near = {w: set() for w in counts}
    for met in holes.values():
        for a in met:
            near[a] |= {b for b in met if b != a and edits(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def variant_rows(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_of_the_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    expected = plain_variants(plain_words(rows))
    got = op12_spelling_variants(spark, SF)
    assert variant_rows(got) == expected and got.count() == len(expected)
    assert sum(form is not None for _, form, *_ in expected) > 20


@pytest.mark.parametrize(("segments", "scanned"), [(50_000, 200_000), (7, 5)])
def test_variants_of_dense_words_and_splits(spark, monkeypatch, segments, scanned):
    monkeypatch.setattr(spelling, "BATCH", 11)
    monkeypatch.setattr(spelling, "CELLS", 50)
    rng = random.Random(segments)
    words = {"".join(rng.choice("abé\U0001f600") for _ in range(rng.randint(4, 8))): rng.randint(1, 40) for _ in range(700)}
    words |= {"x" * k: 2**k for k in range(4, 20)} | {"y" * 3000: 3, "y" * 2999: 9, "y" * 2998 + "z": 1}
    held = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    near = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(held, segments, scanned).collect()}
    expected = plain_variants(words)
    assert {w: v[0] for w, v in near.items()} == {w: n for w, _, _, _, n, _ in expected if n}
    assert variant_rows(spelling.variants(held.unionByName(spark.createDataFrame([("abc", 5), (None, 3)], "word string, n long")))) == expected
    assert ("xxxx", "xxxxx", "x" * 19) in {(w, f, r) for w, f, r, *_ in expected}


def test_words_of_odd_rows(spark):
    rows = [(None, None), (1, ""), (None, "Straße Straße straße ÀPROPOS Àpropos àpropos"), (2, "STRASSE's strasse strasse abcd abcd abcd"), (2, "STRASSE's strasse strasse abcd abcd abcd"), (3, "naïvénaïve naïve×naïve÷"), (4, "ﬁfth" * 3 + " " + "Łodzz " * 4)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("h", F.lit(1))
    for every in (97, 1):
        got = {r.word: r.n for r in spelling.document_words(docs, every=every).collect()}
        assert got == plain_words(rows, every)
    assert spelling.variants(spelling.document_words(docs.limit(0))).collect() == []


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_search(docs, items, k=10):
    bags = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs if plain_terms(text)]
    n_docs, all_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = set()
    for item_id, text in items:
        scores = []
        for place, (doc_id, bag) in enumerate(bags):
            m, score = 100 - 75 + (75 * bag.total() * n_docs) // all_terms, 0
            for t in plain_terms(text):
                if bag[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id, place))
        out |= {(item_id, rank, doc_id, -minus) for rank, (minus, _, doc_id, _) in enumerate(sorted(scores)[:k], 1)}
    return out


def found_rows(df):
    return {(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("handed", [500_000, 3])
def test_search_against_a_plain_version(spark, monkeypatch, handed):
    monkeypatch.setattr(lexical_search, "HANDED_TERMS", handed)
    monkeypatch.setattr(lexical_search, "BROADCAST_ROWS", 500_000 if handed > 3 else 3)
    rng = random.Random(8)
    vocabulary = [f"t{k}" for k in range(60)] + ["É", "x×y", "\U0001f600"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    text = lambda n: rng.choice([" ", "\n", "-_"]).join(rng.choices(vocabulary, weights, k=n))
    docs = [(k, text(rng.choice([0, 1, 3, 30, 200]))) for k in range(300)] + [(1000, "same words here t1"), (1001, "same words here t1"), (None, "same words here t1"), (None, None), (1002, ""), (1003, "--")]
    docs += [(2000 + k, "T5 t9 rare") for k in range(15)] + [(3000, "t1 " * 20_000)]
    items = [(k, text(rng.randint(1, 25))) for k in range(25)] + [(100, "same words"), (101, "rare T9"), (102, None), (103, ""), (104, "unseen"), (None, "here t1 here")]
    framed = spark.createDataFrame(docs, DOCS).repartition(5).withColumn("row", F.lit(1)).withColumn("n", F.lit(2)).withColumn("term", F.lit("t"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(1)).withColumn("q", F.lit(1))
    got = lexical_search.search(framed, asked)
    assert found_rows(got) == plain_search(docs, items) and got.count() == len(found_rows(got))


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        assert lexical_search.search(d, i).collect() == []
    assert [tuple(r) for r in lexical_search.search(docs, items.unionAll(items)).collect()] == [(1, 1, 1, plain_search([(1, "a b")], [(1, "a a")]).pop()[3])]
