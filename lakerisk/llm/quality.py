"""Quality scores by a factorisation machine.

A document is a vector of hashed words (log counts, scaled to length one), structure statistics of the whole
text, and its stored length. The score is the logistic of ``w0 + sum(w x) + 1/2 sum_f ((sum v_f x)^2 - sum
(v_f x)^2)``: all pairwise interactions at low rank, in time linear in the vector. The parameters are learned
on a bounded sample of labelled rows; ids, languages, sources and labels are never inputs of a score.

Defined cases: a null text counts as empty; a missing stored length is taken from the text; without labels of
both classes every score is 0.5; a text longer than what is learned from is scored in stretches of that length, all of
them, and has their mean by length; repeated rows get the same score; input columns named like an output column are replaced; an empty table stays empty.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import ready
from lakerisk.llm.training import labelled, sigmoid, stretches, weights

BOUNDS = {1: 4000, 0: 4000}  # labelled documents learned from, by class
BUCKETS = 1024  # hashed words
RANK = 8
STEPS = 300
RATE = 0.02
L2 = 1e-4
THRESHOLD = 0.5

_KINDS = np.zeros(256, np.int64)  # what a byte is: 0 beyond ASCII, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 stop, 7 sign
_KINDS[0x00:0x80] = 7
_KINDS[[9, 11, 12, 13, 32]] = 4
_KINDS[10] = 5
_KINDS[[ord(c) for c in ".,;:?'\"-"]] = 6
_KINDS[ord("0"):ord("9") + 1] = 3
_KINDS[ord("A"):ord("Z") + 1] = 2
_KINDS[ord("a"):ord("z") + 1] = 1
N_STRUCTURE = 19


def structure(text: bytes, words: list[bytes], n_chars: float) -> list[float]:
    kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=8) / max(1, len(text))
    lines = text.split(b"\n")
    n, distinct = max(1, len(words)), len(set(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    return [
        *kinds, kinds[2] / (kinds[1] + kinds[2] + 1e-3),
        lengths.mean() / 10, lengths.std() / 10, distinct / n,
        np.log1p(len(words)) / 10, np.log1p(len(lines)) / 10, len(set(lines)) / len(lines),
        text.count(b"|") / n, text.count(b"!") / n, sum(text.count(c) for c in (b"#", b"$", b"%", b"&", b"*")) / n,
        np.log1p(max(0.0, n_chars)) / 10,
    ]


def vectors(texts: list[bytes], n_chars: list) -> np.ndarray:
    """One row a document: ``BUCKETS`` hashed words, then the statistics."""
    out = np.zeros((len(texts), BUCKETS + N_STRUCTURE), np.float32)
    for row, text, stored in zip(out, texts, n_chars):
        words = text.lower().split()
        if words:
            counts = np.bincount(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS, minlength=BUCKETS)
            logs = np.log1p(counts)
            row[:BUCKETS] = logs / np.linalg.norm(logs)
        length = float(stored) if stored is not None and stored == stored else float(len(text.decode()))
        row[BUCKETS:] = structure(text, words, length)
    return out


@dataclass
class Machine:
    mean: np.ndarray
    scale: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def scaled(self, x: np.ndarray) -> np.ndarray:
        x = x.copy()
        x[:, BUCKETS:] = np.clip((x[:, BUCKETS:] - self.mean) / self.scale, -8, 8)
        return x

    def score(self, x: np.ndarray) -> np.ndarray:
        x = self.scaled(x)
        pairs = (x @ self.v) ** 2 - x**2 @ self.v**2
        return sigmoid((self.w0 + x @ self.w + pairs.sum(1) / 2).astype(np.float64))


def score_texts(machine: Machine, texts: list[bytes], n_chars: list) -> np.ndarray:
    """Whole texts: those longer than what is learned from get the mean of all their stretches, by length."""
    cut = [stretches(t) for t in texts]
    lengths = [n if n is not None and n == n else len(t.decode()) for t, n in zip(texts, n_chars)]
    parts = [s for found in cut for s in found]
    scores = machine.score(vectors(parts, [n for n, found in zip(lengths, cut) for _ in found]))
    size = np.array([max(1, len(s)) for s in parts], np.float64)
    first = np.cumsum([0, *map(len, cut[:-1])])
    return np.clip(np.add.reduceat(scores * size, first) / np.add.reduceat(size, first), 0, 1)


def train(rows: pd.DataFrame, counts: dict[int, int]) -> Machine | None:
    """A machine fitted with Adam on the whole sample at every step; None without both classes."""
    y = rows["y"].to_numpy(np.float32)
    if not 0 < y.sum() < len(y):
        return None
    lengths = rows["n_chars"] if "n_chars" in rows else rows["whole"]
    x = vectors([t.encode() for t in rows["text"]], list(lengths.fillna(rows["whole"])))
    weight = weights(y, counts).astype(np.float32) / len(y)
    random = np.random.default_rng(0)
    tail = x[:, BUCKETS:]
    machine = Machine(tail.mean(0), tail.std(0) + 1e-3, 0.0, np.zeros(x.shape[1], np.float32),
                      random.normal(0, 0.02, (x.shape[1], RANK)).astype(np.float32))
    x = machine.scaled(x)
    squares = x**2
    values = [np.zeros(1, np.float32), machine.w, machine.v]
    first, second = [np.zeros_like(a) for a in values], [np.zeros_like(a) for a in values]
    for step in range(1, STEPS + 1):
        w0, w, v = values
        sums = x @ v
        z = w0[0] + x @ w + (sums**2 - squares @ v**2).sum(1) / 2
        pull = weight * (sigmoid(z) - y)
        slopes = [np.array([pull.sum()]), x.T @ pull + L2 * w, x.T @ (pull[:, None] * sums) - v * (squares.T @ pull)[:, None] + L2 * v]
        for a, m, s, g in zip(values, first, second, slopes):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    machine.w0 = float(values[0][0])
    return machine


def _scored(model):
    def run(batches):
        for batch in batches:
            texts = [b"" if t is None else t for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            scores = np.full(len(texts), 0.5)
            if model.value is not None and texts:
                scores = score_texts(model.value, texts, batch.column("_n_chars").to_pylist())
            columns = [batch.column(c) for c in batch.schema.names] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, by a machine learned from the labels of ids that are not held out.

    A column ``n_chars`` is an input if the table has it.
    """
    spark = ready(docs.sparkSession)
    has_length = "n_chars" in docs.columns
    model = spark.sparkContext.broadcast(train(*labelled(docs, labels, "quality", BOUNDS, id_col, text_col, ("n_chars",) if has_length else ())))
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    length = F.col("n_chars").cast("double") if has_length else F.lit(None).cast("double")
    rows = docs.select(F.col(text_col).alias("_text"), length.alias("_n_chars"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(kept) if c != text_col])
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", _score double"
    names = {c: "_text" if c == text_col else f"_{i}" for i, c in enumerate(kept)}
    return rows.mapInArrow(_scored(model), schema).select(
        *[F.col(names[c]).alias(c) for c in kept], F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )
