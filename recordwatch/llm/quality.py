"""Quality by hierarchical empirical Bayes.

A classifier of the text alone gives each document a probability. Grouped sums of these per path and per host
give posteriors of the share of good documents: a host is shrunk towards the share of all documents, a path
towards its host, each by as much as the spread between hosts (paths) fails to exceed what chance alone would
give. A document's odds are then corrected by its path's posterior against the share of all documents.

Sums are of whole millionths, so they don't depend on the order of rows. A group of any size is summed before the
shuffle. Posteriors are broadcast only if they are counted to be few; otherwise rows join them by key.

Edge cases: null and empty texts have features like any other text; null hosts and paths are groups of their own; a
repeated row counts as often as it occurs; without usable labels the intercept decides; an empty table gives an empty
result. Labels are no inputs of the probabilities of texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from recordwatch.llm.common import cut, free_name, text_or_empty
from recordwatch.llm.logistic import TRAINING_ROWS, fit, held_out, sigmoid, training_labels

#: A document stays if its probability of being good reaches this.
KEEP_FROM = 0.5
#: Cells per feature; a feature's cells hold equal shares of the training texts.
CELLS = 24
#: Posteriors are broadcast up to so many groups.
BROADCAST_GROUPS = 200_000
#: Least and most strength of a prior, in documents.
STRENGTH = (2.0, 1e6)

MARKS = "#$%&*+<=>@\\^_`{|}~"


def measures(text: str) -> list[float]:
    """What the classifier sees of a text."""
    n = max(1, len(text))
    words = text.split()
    k = max(1, len(words))
    lines = text.split("\n")
    counts = Counter(words)
    marks = sum(map(text.count, MARKS))
    letters = sum(map(len, words))
    upper = sum(map(str.isupper, words))
    return [
        float(len(words)),
        letters / k,
        max(map(len, words), default=0) / 10,
        upper / k,
        marks / k,
        text.count("|") / k,
        text.count("!") / k,
        (text.count(".") + text.count("?")) / k,
        text.count(",") / k,
        sum(map(text.count, "0123456789")) / n,
        len(lines) / k,
        1 - len(set(lines)) / max(1, len(lines)),
        len(counts) / k,
        max(counts.values(), default=0) / k,
        sum(1 for w in words if len(w) == 1) / k,
        sum(1 for w in words if w[-1] in MARKS) / k,
        text.count("http") / k,
        sum(1 for w in words if w[0].isupper()) / k,
    ]


class Model:
    """Edges of the cells of each measure, and a weight for each cell."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, bias: float) -> None:
        self.edges, self.weights, self.bias = edges, weights, bias

    def cells(self, seen: list[list[float]]) -> np.ndarray:
        table = np.array(seen, float).reshape(len(seen), -1)
        return np.stack([np.searchsorted(e, table[:, k], "right") + k * CELLS for k, e in enumerate(self.edges)], axis=1)

    def probability(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        return sigmoid(self.weights[self.cells([measures(t) for t in texts])].sum(axis=1) + self.bias)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Fit on the measures of about ``rows`` labelled texts that aren't held out."""
    known = training_labels(labels, "quality", rows)
    training = docs.select(docs["doc_id"].alias("__id"), text_or_empty().alias("text")).join(known, "__id").select("text", "__label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(1), pa.array([measures(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64()))], ["label", "seen"])

    got = sorted((r.label, list(r.seen)) for r in training.mapInArrow(run, "label int, seen array<double>").collect())
    table = np.array([seen for _, seen in got], float).reshape(len(got), len(measures("")))
    cuts = np.linspace(0, 1, CELLS + 1)[1:-1]
    edges = [np.unique(np.quantile(column, cuts)) if len(got) else np.empty(0) for column in table.T]
    model = Model(edges, np.zeros(CELLS * len(edges)), 0.0)
    cells = model.cells([seen for _, seen in got]).tolist() if got else []
    model.weights, model.bias = fit(cells, 1.0 - np.array([label for label, _ in got], float), CELLS * len(edges), l2=1e-3, rate=0.1)
    model.weights, model.bias = -model.weights, -model.bias
    return model


def evidence(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """``docs`` with every column it has and the probability that its text is good, in whole millionths, in ``column``."""
    told = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = told.value.probability([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(p * 1e6).clip(1, 999_999) / 1e6, pa.float64())], [*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def _strength(groups: DataFrame, rate: Column, prior: Column, mean: float) -> float:
    """Prior strength by moments: the spread between groups beyond what their sizes explain. ``rate`` holds good / n."""
    chance = mean * (1 - mean)
    seen = groups.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"), F.sum(F.col("n") * (rate - prior) * (rate - prior)).alias("spread")
    ).first()
    if not seen.n or seen.groups < 2 or chance <= 0:
        return STRENGTH[1]
    between = (seen.spread - (seen.groups - 1) * chance) / seen.n
    return float(np.clip(chance / between - 1 if between > 0 else STRENGTH[1], *STRENGTH))


def posteriors(scored: DataFrame, host: str, path: str, p: str) -> tuple[DataFrame, float]:
    """``__host, __path, host_posterior, path_posterior`` of every path, and the share of good documents overall."""
    paths = cut(
        scored.groupBy(F.col(host).alias("__host"), F.col(path).alias("__path")).agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.col(p) * 1_000_000).cast("long")).alias("good")
        )
    )
    hosts = paths.groupBy("__host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = float(whole.good) / 1e6 / whole.n if whole.n else 0.5
    rate = F.col("good") / 1e6 / F.col("n")
    k = _strength(hosts, rate, F.lit(mean), mean)
    hosts = hosts.select(F.col("__host").alias("__h"), ((F.col("good") / 1e6 + k * mean) / (F.col("n") + k)).alias("host_posterior"))
    joined = cut(paths.join(hosts, F.col("__host").eqNullSafe(F.col("__h"))).drop("__h"))
    k = _strength(joined, rate, F.col("host_posterior"), mean)
    found = joined.select("__host", "__path", "host_posterior", ((F.col("good") / 1e6 + k * F.col("host_posterior")) / (F.col("n") + k)).alias("path_posterior"))
    return found, mean


def combined(p: Column, path_posterior: Column, mean: float) -> Column:
    """Probability whose odds are those of ``p`` times the path's odds over the odds of all documents."""
    odds = lambda x: x / (1 - x)
    all_odds = min(max(mean, 1e-6), 1 - 1e-6)
    z = odds(p) * odds(F.least(F.greatest(path_posterior, F.lit(1e-6)), F.lit(1 - 1e-6))) / (all_odds / (1 - all_odds))
    return z / (1 + z)


def with_posteriors(scored: DataFrame, found: DataFrame, host: str, path: str) -> DataFrame:
    if found.count() <= BROADCAST_GROUPS:
        found = F.broadcast(found)
    return scored.join(found, scored[host].eqNullSafe(found["__host"]) & scored[path].eqNullSafe(found["__path"])).drop("__host", "__path")


def score_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, evidence, host_posterior, path_posterior, score, kept`` of each row."""
    model = train(docs, labels, rows)
    scored = cut(evidence(docs.select("doc_id", F.col(host).alias("h"), F.col(path).alias("s"), "text"), model, "evidence").drop("text"))
    found, mean = posteriors(scored, "h", "s", "evidence")
    score = combined(F.col("evidence"), F.col("path_posterior"), mean)
    return with_posteriors(scored, found, "h", "s").select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "evidence", "host_posterior", "path_posterior", score.alias("score"), (score >= KEEP_FROM).alias("kept")
    )


def drop_poor(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", rows: int = TRAINING_ROWS) -> DataFrame:
    """``docs`` without the rows whose score is below ``KEEP_FROM``; all columns stay.

    The measures are taken twice, for the sums and for the decision, so that no text is shuffled.
    """
    model = train(docs, labels, rows)
    narrow = evidence(docs.select(F.col(host).alias("h"), F.col(path).alias("s"), "text"), model, "evidence").drop("text")
    found, mean = posteriors(narrow, "h", "s", "evidence")
    names = {c: free_name(docs, c) for c in ("__host", "__path", "__evidence", "__posterior")}
    found = found.select(F.col("__host").alias(names["__host"]), F.col("__path").alias(names["__path"]), F.col("path_posterior").alias(names["__posterior"]))
    if found.count() <= BROADCAST_GROUPS:
        found = F.broadcast(found)
    scored = evidence(docs, model, names["__evidence"])
    joined = scored.join(found, scored[host].eqNullSafe(found[names["__host"]]) & scored[path].eqNullSafe(found[names["__path"]]))
    return joined.filter(combined(F.col(names["__evidence"]), F.col(names["__posterior"]), mean) >= KEEP_FROM).select(*[scored[c] for c in docs.columns])
