"""Classifiers on labels they haven't seen, packing against its bounds, and the pipeline as a whole."""

import re
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordwatch.llm import packing, quality, toxicity
from recordwatch.llm.logistic import fit, sigmoid
from recordwatch.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.01"


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_toxicity_on_held_out_labels(spark):
    scored = toxicity.score_documents(read(spark, "documents"), read(spark, "labels")).toPandas()
    assert len(scored) == read(spark, "documents").count()
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.3) == (scored.predicted == 1)).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(scored.doc_id, scored.held_out))
    seen = scored[scored.held_out].merge(read(spark, "labels").toPandas(), on="doc_id")
    assert (seen.predicted == seen.toxic).mean() > 0.95
    assert seen[seen.toxic == 1].predicted.mean() > 0.7 and seen[seen.toxic == 0].predicted.mean() < 0.05


def test_toxicity_ignores_held_out_labels(spark):
    docs, labels = read(spark, "documents").limit(150), read(spark, "labels")
    turned = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, x) for x in (labels, turned))
    assert a.weights == b.weights and a.bias == b.bias


def test_counterfactual_pairs_level_the_names():
    rows, y = [[0, 2], [0, 3], [1, 3], [1, 3], [2], [3]] * 10, np.array([1, 1, 0, 0, 1, 0] * 10, float)
    free, _ = fit(rows, y, 4)
    level, _ = fit(rows, y, 4, pairs=[([0], [1]), ([1], [0])], pair_weight=5.0)
    assert abs(level[0] - level[1]) < 0.2 * abs(free[0] - free[1])
    assert level[2] > level[3]


def test_swaps_name_every_other_of_a_kind():
    changes = toxicity.swaps({"the", "muslim", "neighbour"})
    assert len(changes) == len(toxicity.IDENTITY_TERMS["religion"]) - 1
    assert all("muslim" in lost for _, lost in changes) and any("hindu" in gained for gained, _ in changes)
    assert toxicity.swaps({"the", "neighbour"}) == []


def test_neutral_mentions_are_not_flagged(spark):
    rows = [(k, f"the muslim {w} is an idiot and a moron", 1) for k, w in enumerate(["man", "writer"] * 20)]
    rows += [(100 + k, f"a quiet {w} in the town", 0) for k, w in enumerate(["hindu cook", "green garden", "christian school", "old bridge"] * 20)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    free, fair = (toxicity.train(docs, labels, pair_weight=w) for w in (0.0, 10.0))
    text = "a quiet muslim writer in the town"
    assert fair.score(text) < 0.3 and fair.score(text) <= free.score(text) + 1e-9
    gap = lambda m: abs(m.score("the muslim man") - m.score("the hindu man"))
    assert gap(fair) <= gap(free) + 1e-9


def test_classifiers_take_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (None, "some text"), (2, ""), (2, ""), (3, "x" * 5000)], "doc_id long, text string").withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit("en")).withColumn("label", F.lit("a"))
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert toxicity.score_documents(docs, labels).count() == 5
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    assert quality.score_documents(docs, labels).count() == 5
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    assert quality.drop_poor(docs, labels).columns == docs.columns
    nulls = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, toxic int, quality int")
    assert quality.score_documents(docs, nulls).filter("score is null").count() == 0


def test_quality_on_held_out_labels(spark):
    scored = quality.score_documents(read(spark, "documents"), read(spark, "labels")).toPandas()
    seen = scored[scored.held_out].merge(read(spark, "labels").toPandas(), on="doc_id")
    assert (seen.kept == (seen.quality == 1)).mean() > 0.93
    assert seen[seen.quality == 1].kept.mean() > 0.97


def test_sparse_sites_are_shrunk(spark):
    rows = [("big", "a", 0.9 if k % 10 else 0.1) for k in range(400)] + [("bad", "a", 0.1)] * 300 + [("small", "a", 0.1)] + [("big", "rare", 0.1)]
    found, mean = quality.posteriors(spark.createDataFrame(rows, "h string, s string, p double"), "h", "s", "p")
    got = {(r["__host"], r["__path"]): r for r in found.collect()}
    assert got["bad", "a"].path_posterior < 0.15 < got["small", "a"].path_posterior < mean
    assert got["big", "rare"].path_posterior > 0.5
    assert abs(got["big", "a"].host_posterior - 0.82) < 0.02


def place_all(histogram, capacity):
    table = packing.plan(histogram, capacity).rows
    keys = (table[:, 0] << 40) + table[:, 1]
    load = {}
    for size, n in histogram.items():
        rank = np.arange(n)
        at = table[np.searchsorted(keys, (size << 40) + rank, "right") - 1]
        assert (at[:, 0] == size).all()
        within = rank - at[:, 1]
        for s, o in zip(at[:, 3] + within // at[:, 2], at[:, 4] + within % at[:, 2] * size):
            load.setdefault(int(s), []).append((int(o), size))
    for parts in load.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= capacity
    return len(load)


@pytest.mark.parametrize("histogram,best", [({}, 0), ({1: 5}, 1), ({64: 3}, 3), ({33: 10}, 10), ({40: 10, 24: 10}, 10), ({20: 31, 22: 62, 1: 3}, None)])
def test_plan_is_tight(histogram, best):
    used = place_all(histogram, 64)
    bound = -(-sum(k * n for k, n in histogram.items()) // 64)
    assert used == best if best is not None else bound <= used <= bound + 1


def test_plan_of_many():
    rng = np.random.default_rng(3)
    sizes = np.minimum(256, rng.exponential(40, 20_000).astype(int) + 1)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True))}
    bound = -(-int(sizes.sum()) // 256)
    assert place_all(histogram, 256) <= bound * 1.005 + 1


def test_pack_documents(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    texts = [None, "", "a", "word " * 200, "other words " * 57, "a", "<|endoftext|> x"] + ["some text here"] * 40
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, length int").repartition(3)
    monkey = packing.RANKED_TOGETHER
    packing.RANKED_TOGETHER = 10
    try:
        got = packing.pack_documents(docs, tokenizer_path(), capacity=64).collect()
    finally:
        packing.RANKED_TOGETHER = monkey
    expected, load = [], {}
    for k, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            expected.append((k, piece, at, len(part), zlib.crc32(array("I", part).tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    for r in got:
        load.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in load.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= 64
    assert len(load) <= -(-sum(e[3] for e in expected) // 64) + 1
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_pipeline_keeps_and_packs(spark, tmp_path):
    import corpus_pipeline
    from test_text_operators import components_truth, plain_fingerprint

    sf = "/root/testdata/sf0.001"
    docs = read(spark, "documents", sf)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "exact_dedup", "near_dedup", "packing"]
    table = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, table = table, stage(spark, table, sf)
        assert table.columns == docs.columns, name
        assert table.exceptAll(before).count() == 0, name
        table = spark.createDataFrame(table.collect(), docs.schema)
        rows = [(r.doc_id, r.text or "") for r in before.select("doc_id", "text").collect()]
        if name == "exact_dedup":
            first = {}
            for doc_id, text in sorted(rows):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), doc_id)
            assert sorted(r.doc_id for r in table.collect()) == sorted(first.values())
        if name == "near_dedup":
            fps, roots = [plain_fingerprint(t) for _, t in sorted(rows)], {}
            for k, root in enumerate(components_truth(fps)):
                roots.setdefault(root, sorted(rows)[k][0])
            assert sorted(r.doc_id for r in table.collect()) == sorted(roots.values())
    folder = f"{tmp_path}/run"
    packed = corpus_pipeline.run(spark, sf, folder)
    again = corpus_pipeline.run(spark, sf, folder)
    assert again.inputFiles() == packed.inputFiles()
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in table.select("doc_id").collect()}
    tokens = packed.agg(F.sum("length")).first()[0]
    assert packed.select("sequence_id").distinct().count() <= -(-tokens // 4096) + 1
    clean = docs.join(read(spark, "labels", sf).filter("quality = 1 and toxic = 0"), "doc_id", "left_semi")
    kept_clean = clean.join(corpus_pipeline.STAGES[0][1](spark, docs, sf), "doc_id", "left_semi").count()
    assert kept_clean >= 0.9 * clean.count()


def test_sigmoid_is_bounded():
    assert 0 < sigmoid(np.array([-1e9]))[0] < 1e-9 and sigmoid(np.array([1e9]))[0] <= 1
