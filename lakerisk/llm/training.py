"""Bounded samples of labelled documents, and the parts that both classifiers share."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import held_out

MAX_CHARS = 20_000  # of a longer text a stretch of so many characters is learned from; it is scored in such stretches, all of them


def stretch(text: Column, key: Column) -> Column:
    """A text of up to ``MAX_CHARS`` as it is; of a longer one a stretch of that length, at a place that the key decides."""
    spare = F.greatest(F.length(text) - MAX_CHARS, F.lit(0))
    return F.substr(text, (F.pmod(F.xxhash64(key, F.lit("stretch")), spare + 1) + 1).cast("int"), F.lit(MAX_CHARS))


def stretches(text: bytes) -> list[bytes]:
    """The whole text in stretches of the length that is learned from, the last one up to its end; a shorter text as it is."""
    plain = text.decode() if len(text) > MAX_CHARS else ""
    if len(plain) <= MAX_CHARS:
        return [text]
    last = len(plain) - MAX_CHARS
    return [plain[i:i + MAX_CHARS].encode() for i in [*range(0, last, MAX_CHARS), last]]


def labelled(docs: DataFrame, labels: DataFrame, label: str, bounds: dict[int, int], id_col: str = "doc_id", text_col: str = "text",
             more: tuple[str, ...] = ()) -> tuple[pd.DataFrame, dict[int, int]]:
    """Rows ``text, whole, y`` to learn from (``whole`` is the length of the whole text), at most ``bounds[y]`` ids of each class, and how many ids each class has.

    The ids come in the order of a hash, so the sample is the same in every run. Held-out ids, ids without a
    label and null texts are left out; of contradicting labels the larger counts.
    An id with several rows is learned from once, by its smallest text: the bounds are bounds on rows.
    """
    known = labels.where(~held_out(id_col)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("y")).where("y IN (0, 1)")
    counts = {row["y"]: row["n"] for row in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y, bound in bounds.items():
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(bound)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), stretch(F.col(text_col), F.col(id_col)).alias("text"), F.length(text_col).alias("whole"), *more)
    least = F.min(F.struct("text", "whole", *more)).alias("least")
    rows = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "y").agg(least).select("_id", "least.*", "y")
    return rows.orderBy(F.xxhash64("_id"), "_id").drop("_id").toPandas(), {y: counts.get(y, 0) for y in bounds}


def weights(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights that give each class its share among all labelled ids; their mean is 1."""
    out = np.ones(len(y))
    for label, count in counts.items():
        own = y == label
        if own.any():
            out[own] = count / own.sum()
    return out / out.mean()


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and coefficients (first the constant) of a weighted logistic regression, by Newton's method."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    penalty = l2 * np.r_[0, np.ones(x.shape[1])]
    beta = np.zeros(z.shape[1])
    for _ in range(40):
        p = sigmoid(z @ beta)
        gradient = z.T @ (w * (p - y)) / len(y) + penalty * beta
        curvature = (z * (w * p * (1 - p))[:, None]).T @ z / len(y) + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curvature, gradient)
        beta -= step * min(1, 5 / (np.abs(step).max() + 1e-12))
    return mean, scale, beta
