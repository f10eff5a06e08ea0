"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of ordinary text and one on toxic text. The toxic one
learns from the words that stand in toxic documents far more often than their share of all documents explains, and
from the stretches of toxic documents whose runs of ``GRAM`` bytes do: parts of words, and scripts without spaces.
Phrases whose words are all ordinary are not learned.
A window is compressed with the ordinary dictionary, and with the toxic one followed by the ordinary one; since
both end alike, the bytes saved are due to the toxic part. The largest savings of a document's windows, and
how many windows save more than thresholds taken from ordinary windows, are calibrated to a probability.

Short words alone hardly shorten a compressed window, as their letters cost next to nothing. So a window is
spelled before: each byte becomes a four-byte code of itself and the three before it within the word. A letter
then is dear and a known run of letters cheap, whatever the language.

Defined cases: a null text counts as empty; an empty text has no savings and gets the score of a text without
any; without labels of both classes every score is 0; a text longer than what is learned from is scored in stretches of
that length, all of them, and has the score of its worst one; repeated rows get the same score; input columns named like an output column are replaced; an empty table stays empty.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import ready
from lakerisk.llm.training import fit_logistic, labelled, sigmoid, stretches, weights

BOUNDS = {1: 3000, 0: 5000}  # labelled documents learned from, by class
WINDOW = 32  # bytes of text, up to the end of the word
ORDINARY_WINDOWS = 20_000  # windows that the ordinary dictionary learns from
ORDINARY_SIZE, TOXIC_SIZE = 1 << 16, 1 << 15  # bytes of the dictionaries
LEAST_DOCS, LEAST_SHARE, LEAST_SIGMAS = 3, 0.01, 5.0  # what makes a word a toxic one
GRAM, GRAM_SIGMAS, GRAM_BITS = 5, 7.0, 22  # the same for runs of bytes, counted by hash
LEVELS = (0.99, 0.999, 0.9999)  # shares of ordinary windows below the thresholds
THRESHOLD = 0.7
TRIM = b".,;:!?()\"'*$%&#|"


def spelled(text: bytes) -> bytes:
    """Four bytes for each byte of the text, from it and what stands before it in its word."""
    x = np.frombuffer(text, np.uint8).astype(np.uint32)
    before = np.concatenate([np.array([0, 0, 32], np.uint32), x])
    one, two, three = before[2:-1].copy(), before[1:-2].copy(), before[:-3].copy()
    two[one == 32] = 0
    three[(two == 32) | (two == 0)] = 0
    code = x * np.uint32(0x9E3779B1) ^ one * np.uint32(0x85EBCA77) ^ two * np.uint32(0xC2B2AE3D) ^ three * np.uint32(0x27D4EB2F)
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    code = (code ^ (code >> np.uint32(12))) * np.uint32(0x297A2D39)
    return (code ^ (code >> np.uint32(15))).tobytes()


def plain_text(text: bytes) -> bytes:
    plain = b" ".join(text.lower().split())
    return plain and plain + b" "


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The spelled windows of a whole text, cut at the ends of words."""
    plain = plain_text(text)
    if not plain:
        return []
    code, out, at = spelled(plain), [], 0
    while at < len(plain):
        end = plain.find(b" ", at + size - 1) + 1 or len(plain)
        out.append(code[4 * at:4 * end])
        at = end
    return out


def words(text: bytes) -> list[bytes]:
    return [w for x in text.lower().split() if len(w := x.strip(TRIM)) > 2]


def toxic_words(texts: list[bytes], y: np.ndarray) -> set[bytes]:
    """Words in more toxic documents than chance allows, and in enough of them."""
    toxic, every = Counter(), Counter()
    for text, label in zip(texts, y):
        found = set(words(text))
        every.update(found)
        if label:
            toxic.update(found)
    share = y.mean()
    least = max(LEAST_DOCS, LEAST_SHARE * y.sum())
    excess = lambda w: (toxic[w] - every[w] * share) / np.sqrt(every[w] * share * (1 - share))
    return {w for w, n in toxic.items() if n >= least and excess(w) >= LEAST_SIGMAS}


def _gram_codes(plain: bytes) -> np.ndarray:
    x = np.frombuffer(plain, np.uint8).astype(np.uint64)
    codes = np.zeros(max(0, len(x) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        codes = (codes ^ x[k:k + len(codes)]) * np.uint64(0x9E3779B97F4A7C15)
        codes ^= codes >> np.uint64(29)
    return (codes >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def toxic_stretches(texts: list[bytes], y: np.ndarray) -> list[bytes]:
    """Of each toxic text, spelled, the stretches under byte runs that stand in more toxic documents than chance allows."""
    toxic, every = np.zeros(1 << GRAM_BITS, np.int32), np.zeros(1 << GRAM_BITS, np.int32)
    for text, label in zip(texts, y):
        found = np.unique(_gram_codes(plain_text(text)))
        every[found] += 1
        toxic[found] += bool(label)
    share = y.mean()
    excess = (toxic - every * share) / np.sqrt(np.maximum(1, every) * share * (1 - share))
    telling = (toxic >= max(LEAST_DOCS, LEAST_SHARE * y.sum())) & (excess >= GRAM_SIGMAS)
    out = []
    for text, label in zip(texts, y):
        plain = plain_text(text)
        at = np.flatnonzero(telling[_gram_codes(plain)]) if label else []
        if len(at):
            inside = np.zeros(len(plain), bool)
            for k in range(GRAM):
                inside[at + k] = True
            out.append(np.frombuffer(spelled(plain), np.uint32)[inside].tobytes())
    return out


def dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; the end of the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def compressor(content: bytes):
    """A compressor that looks up every position of its dictionary, so that only the content matters."""
    parameters = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, window_log=18, hash_log=17, chain_log=17, search_log=5, min_match=7,
        target_length=32, write_content_size=False, write_dict_id=False, write_checksum=False,
    )
    if len(content) < 8:  # zstandard ignores a shorter one
        return zstandard.ZstdCompressor(compression_params=parameters)
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    levels: np.ndarray | None = None
    logistic: tuple | None = None

    def __post_init__(self):
        self._plain = self._marked = None

    def __getstate__(self):
        return self.__dict__ | {"_plain": None, "_marked": None}

    def savings(self, found: list[bytes]) -> np.ndarray:
        """Bytes that the toxic part saves on each window."""
        if self._plain is None:
            self._plain, self._marked = compressor(self.ordinary), compressor(self.toxic + self.ordinary)
        plain, marked = self._plain.compress, self._marked.compress
        return np.array([len(plain(w)) - len(marked(w)) for w in found], np.float64)

    def features(self, saved: np.ndarray) -> list[float]:
        top = np.zeros(3)
        best = np.sort(saved)[::-1][:3]
        top[:len(best)] = best
        n = max(1, len(saved))
        over = [float((saved > level).sum()) for level in self.levels]
        return [*top, saved.sum() / n, np.log(n), top[0] * np.log(n), *np.log1p(over), over[0] / n]

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        cut = [stretches(t) for t in texts]
        x = np.array([self.features(self.savings(windows(s))) for found in cut for s in found])
        mean, scale, beta = self.logistic
        scores = sigmoid(beta[0] + np.clip((x - mean) / scale, -30, 30) @ beta[1:])
        return np.maximum.reduceat(scores, np.cumsum([0, *map(len, cut[:-1])]))


def train(rows: pd.DataFrame, counts: dict[int, int]) -> Model | None:
    """Dictionaries, thresholds and calibration from rows ``text, y``; None without both classes."""
    y = rows["y"].to_numpy(np.float64)
    if not 0 < y.sum() < len(y):
        return None
    texts = [t.encode() for t in rows["text"]]
    found = [windows(t) for t in texts]
    marked = toxic_words(texts, y)
    samples = [spelled(b" ".join(own) + b" ") for t, label in zip(texts, y) if label and (own := [w for w in words(t) if w in marked])]
    plain = [w for ws, label in zip(found, y) if not label for w in ws]
    picked = np.random.default_rng(0).permutation(len(plain))[:ORDINARY_WINDOWS]
    model = Model(dictionary(ORDINARY_SIZE, [plain[i] for i in picked]), dictionary(TOXIC_SIZE, samples + toxic_stretches(texts, y)))
    saved = [model.savings(ws) for ws in found]
    calm = np.concatenate([s for s, label in zip(saved, y) if not label] + [np.zeros(1)])
    model.levels = np.quantile(calm, LEVELS)
    x = np.array([model.features(s) for s in saved])
    model.logistic = fit_logistic(x, y, weights(y, counts))
    return model


def _scored(model):
    def run(batches):
        for batch in batches:
            texts = [b"" if t is None else t for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            scores = np.zeros(len(texts)) if model.value is None else model.value.score(texts)
            columns = [batch.column(c) for c in batch.schema.names] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, by a model learned from the labels of ids that are not held out."""
    spark = ready(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(*labelled(docs, labels, "toxic", BOUNDS, id_col, text_col)))
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(F.col(text_col).alias("_text"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(kept) if c != text_col])
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", _score double"
    names = {c: "_text" if c == text_col else f"_{i}" for i, c in enumerate(kept)}
    return rows.mapInArrow(_scored(model), schema).select(
        *[F.col(names[c]).alias(c) for c in kept], F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )
