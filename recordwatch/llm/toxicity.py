"""Toxicity by a counterfactual-regularised classifier.

Features are whole words and beginnings of words; those that tell the classes apart best are selected by
counts over the labelled rows, added up by partition and then by key. In every labelled text that names a
group, the name is swapped for each other name of its kind, and the squared change of the score is part of
the loss, so naming one group rather than another doesn't move a text over the threshold.

Edge cases: null and empty texts get the score of a text without features; a row with a null id is scored and
isn't held out; repeated rows get equal scores; without usable labels every text gets the score of a rare label;
an empty table gives an empty result. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from recordwatch.llm.common import free_name, text_or_empty
from recordwatch.llm.logistic import TRAINING_ROWS, fit, held_out, sigmoid, training_labels

THRESHOLD = 0.3
#: Beginnings of words that count as features, in letters; shorter words have only themselves.
PREFIXES = (4, 5, 6)
#: Most features that are selected, the fewest texts that one must be in, and the least size of its z value.
FEATURES, LEAST_TEXTS, LEAST_Z = 4000, 3, 2.5
PAIR_WEIGHT = 1.0

# Names of groups, by kind, in the four languages of the documents.
IDENTITY_TERMS: dict[str, tuple[str, ...]] = {
    "gender": ("woman", "man", "women", "men", "female", "male", "transgender", "frau", "mann", "frauen", "männer", "femme", "homme", "femmes", "hommes", "mujer", "hombre", "mujeres", "hombres"),
    "orientation": ("gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual"),
    "religion": ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "christians", "muslims", "jews", "hindus", "christlich", "muslimisch", "jüdisch", "chrétien", "musulman", "juif", "cristiano", "musulmán", "judío"),
    "origin": ("african", "asian", "european", "american", "arab", "latino", "hispanic", "black", "white", "immigrant", "refugee", "migrant", "ausländer", "immigré", "inmigrante"),
    "ability": ("disabled", "blind", "deaf", "autistic", "behindert", "blinde", "handicapé", "aveugle", "ciego", "sordo"),
    "age": ("young", "old", "elderly", "teenager", "jung", "alt", "jeune", "vieux", "joven", "viejo"),
}

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """Words as they are and beginnings with a star."""
    return words | {w[:k] + "*" for k in PREFIXES for w in words if len(w) > k}


@dataclass
class Model:
    """Feature -> weight, and the intercept."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -3.0

    def __post_init__(self) -> None:
        self.whole = {f: w for f, w in self.weights.items() if not f.endswith("*")}
        self.start = {k: {f[:-1]: w for f, w in self.weights.items() if f.endswith("*") and len(f) == k + 1} for k in PREFIXES}

    def score(self, text: str) -> float:
        words = words_of(text)
        z = self.bias + sum(self.whole[w] for w in sorted(self.whole.keys() & words))
        for k, start in self.start.items():
            if start:
                z += sum(start[p] for p in sorted(start.keys() & {w[:k] for w in words if len(w) > k}))
        return float(sigmoid(np.float64(z)))


def _training(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    known = training_labels(labels, "toxic", rows)
    return docs.select(docs["doc_id"].alias("__id"), text_or_empty().alias("text")).join(known, "__id").select("text", "__label")


def _counted(training: DataFrame) -> DataFrame:
    """``feature, toxic, clean, texts``: counts of texts by partition; the empty feature counts all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(features_of(words_of(text)))
                counts[label][""] += 1
        names = sorted({*counts[0], *counts[1]})
        yield pa.record_batch([pa.array(names, pa.string()), pa.array([counts[1][f] for f in names], pa.int64()), pa.array([counts[0][f] for f in names], pa.int64())], ["feature", "toxic", "clean"])

    return training.mapInArrow(run, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def select_features(training: DataFrame) -> list[str]:
    """The features of the largest z value for a difference in log odds, at most ``FEATURES``, and the names of groups."""
    counts = _counted(training)
    all_texts = counts.filter("feature = ''").first()
    names = {t for kind in IDENTITY_TERMS.values() for t in kind}
    if all_texts is None:
        return sorted(names)
    # A common and a rare feature are both seen against what their number of texts would give by chance.
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(toxic / (all_texts.toxic - F.col("toxic") + 0.5)) - F.log(clean / (all_texts.clean - F.col("clean") + 0.5))
    z = F.abs(odds) / F.sqrt(1 / toxic + 1 / clean)
    found = counts.filter((F.col("feature") != "") & (F.col("toxic") + F.col("clean") >= LEAST_TEXTS)).select("feature", z.alias("z")).filter(F.col("z") >= LEAST_Z)
    best = found.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()
    return sorted(names | {r.feature for r in best})


def swaps(words: set[str]) -> list[tuple[set[str], set[str]]]:
    """Counterfactual copies of a text as (features gained, features lost): each group named there, swapped for each other of its kind."""
    out = []
    for kind in IDENTITY_TERMS.values():
        for name in sorted(words & set(kind)):
            before = features_of(words)
            for other in kind:
                if other != name:
                    after = features_of(words - {name} | {other})
                    out.append((after - before, before - after))
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, pair_weight: float = PAIR_WEIGHT) -> Model:
    """Fit on about ``rows`` labelled texts that aren't held out; only selected features of these reach the driver."""
    training = _training(docs, labels, rows)
    names = select_features(training)
    index = docs.sparkSession.sparkContext.broadcast({f: k for k, f in enumerate(names)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        pick = lambda fs: sorted(at[f] for f in fs if f in at)
        for batch in batches:
            has, gained, lost = [], [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                has.append(pick(features_of(words)))
                changes = swaps(words)
                gained.append([pick(g) for g, _ in changes])
                lost.append([pick(x) for _, x in changes])
            lists = pa.list_(pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(1), pa.array(has, pa.list_(pa.int32())), pa.array(gained, lists), pa.array(lost, lists)], ["label", "has", "gained", "lost"])

    got = training.mapInArrow(run, "label int, has array<int>, gained array<array<int>>, lost array<array<int>>").collect()
    got.sort(key=lambda r: (r.label, r.has))
    pairs = [(list(g), list(x)) for r in got for g, x in zip(r.gained, r.lost)]
    weights, bias = fit([r.has for r in got], np.array([r.label for r in got], float), len(names), pairs=pairs, pair_weight=pair_weight)
    return Model({f: float(w) for f, w in zip(names, weights) if w}, bias)


def score_column(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """``docs`` with every column it has and the score of its text in ``column``."""
    told = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([told.value.score(t or "") for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def predicted(score: Column) -> Column:
    return (score >= THRESHOLD).cast("int")


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row."""
    scored = score_column(docs.select("doc_id", "text"), train(docs, labels, rows), "score")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", predicted(F.col("score")).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``docs`` without the texts that are predicted toxic; all columns stay and no row moves."""
    score = free_name(docs, "__toxic_score")
    return score_column(docs, train(docs, labels, rows), score).filter(predicted(F.col(score)) == 0).drop(score)
