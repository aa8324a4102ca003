"""Licence scans of rows that share or lack an id, and best fit by runs against best fit by pieces."""

import random

import numpy as np
import pytest
from pyspark.sql.functions import lit

from recordwatch.llm import license_scan, packing

DOCS = "doc_id long, text string"


def test_rows_that_share_or_lack_an_id_keep_their_own_licences(spark):
    mit, other = "Released under the MIT License.", "Licensed under CC BY-SA 4.0."
    rows = [(None, mit), (None, "plain words of no licence at all"), (5, mit), (5, "another text here"), (5, other), (6, mit), (6, mit), (None, None), (7, f"code line one\n{mit}\nmore code"), (None, mit)]
    docs = spark.createDataFrame(rows, DOCS)
    got = license_scan.scan_documents(docs.withColumn("uid", docs.doc_id).withColumn("id", docs.doc_id))
    expected = [(i, "MIT" if mit in (t or "") else "CC-BY-SA-4.0" if t == other else "") for i, t in rows]
    assert sorted(((r.doc_id, r.licenses) for r in got.collect()), key=str) == sorted(expected, key=str)


def by_pieces(stock, capacity):
    """Rooms that are left by best fit, largest piece first."""
    rooms = []
    for size in range(capacity, 0, -1):
        for _ in range(stock[size]):
            fit = min((r for r in rooms if r >= size), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((capacity if fit is None else fit) - size)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_by_runs(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 50])
    stock = [0] + [rng.choice([0, 0, 1, 2, 9, 30]) for _ in range(capacity)]
    found = packing._Plan(capacity)
    found.best_fit(list(stock))
    rows = np.array(sorted(found.rows))
    used, taken = {}, {}
    for at, (size, first, n, sequence, offset) in enumerate(rows.tolist()):
        end = rows[at + 1][1] if at + 1 < len(rows) and rows[at + 1][0] == size else stock[size]
        assert first == taken.get(size, 0) and (end - first) % n == 0
        taken[size] = end
        for k in range((end - first) // n):
            used.setdefault(sequence + k, []).append((offset, n * size))
    assert taken == {s: n for s, n in enumerate(stock) if n}
    for parts in used.values():
        place = 0
        for offset, words in sorted(parts):
            assert offset == place
            place += words
        assert place <= capacity
    assert sorted(capacity - sum(w for _, w in parts) for parts in used.values()) == by_pieces(stock, capacity)
    assert found.sequences == len(used)


def test_work_of_packing_does_not_grow_with_the_pieces():
    rng = np.random.default_rng(2)
    sizes = np.clip(rng.lognormal(5, 1.2, 5_000).astype(int) + 1, 1, 1024)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True))}
    rows = {}
    for times in (1, 100, 10_000):
        planned = packing.plan({k: n * times for k, n in histogram.items()}, 1024)
        rows[times] = len(planned.rows)
        assert planned.bound <= planned.sequences <= planned.bound * 1.01 + 2
    assert rows[10_000] <= 3 * rows[100] and 500 * rows[10_000] < 10_000 * sum(histogram.values())


def put_tables(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("__host", lit("x")).withColumn("fp", lit(1)).withColumn("score", lit(2.0))
    docs.coalesce(1).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 2 == 0), int(i % 5 == 0)) for i, *_ in rows if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return docs


def test_pipeline_of_odd_rows_and_of_nothing(spark, tmp_path):
    import corpus_pipeline

    rows = [(None, None, None, None, None), (None, "quiet evening by the river", "en", None, 5), (None, "quiet evening by the river", "en", None, 5), (1, "", None, "s", 0), (2, "good words stay", "en", "s", 3), (2, "good words stay", "en", "s", 3), (3, "é \U0001f600", None, "s", 1)]
    docs = put_tables(spark, tmp_path / "odd", rows)
    table = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, str(tmp_path / "odd"))
        assert table.columns == docs.columns
        table = spark.createDataFrame(table.collect(), docs.schema)
    packed = corpus_pipeline.run(spark, str(tmp_path / "odd"), str(tmp_path / "run"))
    assert packed.count() == table.count() <= len({(r[0], r[1] or "") for r in rows})
    put_tables(spark, tmp_path / "none", [])
    assert corpus_pipeline.run(spark, str(tmp_path / "none"), str(tmp_path / "run")).collect() == []


def test_pipeline_results_are_kept_by_what_they_were_made_of(spark, tmp_path):
    import corpus_pipeline

    words = ["river", "stone", "bread", "window", "letters", "garden"]
    rng = random.Random(3)
    text = lambda: " ".join(rng.choices(words, k=9)) + "."
    put_tables(spark, tmp_path / "docs", [(k, text(), "en", "s", 1) for k in range(12)])
    first = corpus_pipeline.run(spark, str(tmp_path / "docs"), str(tmp_path / "run"))
    assert corpus_pipeline.run(spark, str(tmp_path / "docs"), str(tmp_path / "run")).inputFiles() == first.inputFiles()
    put_tables(spark, tmp_path / "docs", [(k, text(), "en", "s", 1) for k in range(100, 120)])
    second = corpus_pipeline.run(spark, str(tmp_path / "docs"), str(tmp_path / "run"))
    assert not set(second.inputFiles()) & set(first.inputFiles()) and all(r.doc_id >= 100 for r in second.collect())
