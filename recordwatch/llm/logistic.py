"""Logistic regression over binary features, fitted in the driver on a bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier is fitted on, about; more labels are thinned out by a hash of the id.
TRAINING_ROWS = 20_000


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2


def training_labels(labels: DataFrame, label: str, rows: int = TRAINING_ROWS) -> DataFrame:
    """``__id, __label`` of about ``rows`` labelled rows that aren't held out; few enough to broadcast."""
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    n = usable.count()
    if n > rows:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < rows)
    found = usable.groupBy(F.col("doc_id").alias("__id")).agg(F.max(F.col(label).cast("int")).alias("__label"))
    return F.broadcast(found)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(
    rows: list[list[int]],
    y: np.ndarray,
    features: int,
    l2: float = 1e-3,
    pairs: list[tuple[list[int], list[int]]] = (),
    pair_weight: float = 0.0,
    rounds: int = 300,
    rate: float = 0.05,
) -> tuple[np.ndarray, float]:
    """Weights and intercept for rows given as lists of the features they have.

    ``pairs`` are (features gained, features lost) of counterfactual copies; the mean squared change of the
    score over them is added to the loss, ``pair_weight`` times. Without rows the intercept is that of a rare label.
    """
    n = len(rows)
    start = (y.sum() + 0.1) / (n + 2)
    weights, bias = np.zeros(features), float(np.log(start / (1 - start)))
    if not n or not features:
        return weights, bias
    lengths = np.fromiter(map(len, rows), np.int64, n)
    row, column = np.repeat(np.arange(n), lengths), np.fromiter((f for r in rows for f in r), np.int64, lengths.sum())
    change = [(k, f, s) for k, sides in enumerate(pairs) for s, side in zip((1.0, -1.0), sides) for f in side]
    pair, pair_column, sign = (np.array(x) for x in zip(*change)) if change else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    theta = np.append(weights, bias)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w = theta[:-1]
        error = sigmoid(np.bincount(row, w[column], n) + theta[-1]) - y
        grad = np.append(np.bincount(column, error[row], features) / n + l2 * w, error.mean())
        if len(pair):
            shift = np.bincount(pair, sign * w[pair_column], len(pairs))
            grad[:-1] += pair_weight * 2 * np.bincount(pair_column, sign * shift[pair], features) / len(pairs)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return theta[:-1], float(theta[-1])
