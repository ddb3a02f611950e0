"""Bounded labelled samples and logistic calibration for the classifiers."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


_SPLITS = 64


def draw(rows: DataFrame, group: str, id: str, n: int) -> DataFrame:
    """The first `n` rows of each group in the order of the hash of their id, with their place from 0 as `slot`.

    Ids are distinct within a group. Groups are split before they are put in order, so one that holds nearly all rows is
    not ordered by one task. The first `n` fall into the splits at random, so a split keeps its share and, far beyond
    what chance gives (eight deviations and 32 rows), some more.
    """
    share = n / _SPLITS
    most = min(n, math.ceil(share + 8 * math.sqrt(share)) + 32)
    order = [F.xxhash64(F.lit(1), id), F.col(id)]
    split = F.pmod(F.xxhash64(F.lit(2), id), F.lit(_SPLITS))
    some = rows.withColumn("_place", F.row_number().over(W.partitionBy(group, split).orderBy(*order)))
    some = some.filter(F.col("_place") <= most).drop("_place")
    slot = F.row_number().over(W.partitionBy(group).orderBy(*order)) - 1
    return some.withColumn("slot", slot).filter(F.col("slot") < n)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, id: str = "doc_id"
) -> tuple[DataFrame, dict[int, int]]:
    """Rows of `docs` with a 0 / 1 `label` and `slot`, at most `per_class` ids of each class; and how many ids each class has.

    `learn` says which ids may be learnt from. Ids are drawn by their hash. The drawn ids number `2 * per_class` at most,
    so they are broadcast to the texts. Of an id with several texts the smallest counts. `slot` numbers the draw from 0.
    `docs` has the id and the text.
    """
    text = next(c for c in docs.columns if c != id)
    known = labels.filter(learn & F.col(id).isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy(id).agg(F.max(label).cast("int").alias("label"))
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    sample = docs.join(F.broadcast(draw(known, "label", id, per_class)), id)
    return sample.groupBy(id, "label", "slot").agg(F.min(text).alias(text)), counts


def logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients, the constant first, of a weighted logistic regression. With one class only: its smoothed share."""
    x = np.column_stack([np.ones(len(features)), features])
    start = np.zeros(x.shape[1])
    if len(labels) == 0:
        return start
    share = (weights[labels == 1].sum() + 1) / (weights.sum() + 2)
    start[0] = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        return start
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1
    z, beta = x / scale, start.copy()
    weights = weights * len(weights) / weights.sum()
    penalty = np.full(len(beta), ridge)
    penalty[0] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (weights * (labels - p)) - penalty * beta
        curvature = (z * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta / scale


def probability(coefficients: np.ndarray, features: np.ndarray) -> np.ndarray:
    x = np.column_stack([np.ones(len(features)), features])
    return 1 / (1 + np.exp(-np.clip(x @ coefficients, -500, 500)))


def class_weights(labels: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights that give a sample drawn by class the shares that the classes have among all labels."""
    weights = np.ones(len(labels))
    for value, count in counts.items():
        weights[labels == value] = count / max(1, (labels == value).sum())
    return weights
