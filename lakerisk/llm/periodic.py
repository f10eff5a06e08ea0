"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) that is at least
``max(MIN_WORDS, TIMES * q)`` words long and that neither neighbouring word continues. All runs of a text are found:

- Periods up to ``SMALL`` are read off directly: the stretches in which every word equals the one ``q`` before
  it. They are also the highly periodic regions that a synchronising set has to leave out.
- For the dyadic scale ``t`` = 4, 8, ... the synchronising set holds the places ``i`` at which the least hash of the
  ``t``-word windows that start in ``[i, i + t]`` stands at either end; windows inside a region of period ``t / 3``
  or less don't count. Whether a place belongs to the set depends on its ``2 * t`` words alone, and each stretch of
  ``t`` places outside those regions holds one. So a run of a period ``q`` in ``[2 * t, 4 * t)`` has a place of the set
  among its first ``q`` words, and another one ``q`` words on with the same ``2 * t`` words behind it. Places with
  equal contexts less than ``4 * t`` apart propose their distance as a period (a context that is no region occurs
  at most twelve times in such a stretch). Of the proposals those are left whose ``q`` words stand there twice;
  these are extended word by word in both directions, and kept if no smaller period fits.

Words are compared exactly: each gets a number of its own within the texts that are read together. Only the choice of
places and the equality of contexts go by a 64-bit hash. Texts are read together up to ``MOST_WORDS`` words, the
longest first, with a number of its own between them, so that one pass serves many short texts; a longer text is read
alone, whole.

Defined cases: a null or empty text has no words and no runs; words are the stretches without the six ASCII spaces
and are compared as they are, case included; rows are independent of each other, repeated or without an id;
input columns named like an output column are replaced, further columns are ignored; an empty table gives an empty one.
"""

from collections.abc import Callable
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import ready

MIN_WORDS = 24
TIMES = 3
SMALL = 8
MOST_WORDS = 500_000

RUNS_SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

Region = tuple[int, int, int]  # first word, word behind the last, period


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def doubled(h: np.ndarray, t: int) -> np.ndarray:
    """Hashes of the windows of ``2 * t`` words from those of ``t`` words."""
    return mix(h[:-t] * np.uint64(0x9E3779B97F4A7C15) + mix(h[t:] + np.uint64(0xD6E8FEB86659FD93)))


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window of ``width`` values, by running minima from either end of blocks."""
    n = len(x)
    blocks = np.full((-(-n // width), width), np.iinfo(x.dtype).max, x.dtype)
    blocks.ravel()[:n] = x
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each stretch of true values."""
    turns = np.flatnonzero(np.diff(np.r_[False, mask, False].view(np.int8)))
    return turns[::2], turns[1::2]


def same_until(words: np.ndarray, at: int, q: int, step: int) -> int:
    """From ``at`` on (or back, with ``step`` -1): the first place whose word differs from that ``q`` further on."""
    size = 64
    while True:
        if step > 0:
            end = min(at + size, len(words) - q)
            differ = np.flatnonzero(words[at:end] != words[at + q:end + q])
            if len(differ):
                return at + int(differ[0])
            at, done = end, end >= len(words) - q
        else:
            end = max(at - size, -1)
            differ = np.flatnonzero(words[end + 1:at + 1] != words[end + 1 + q:at + 1 + q])
            if len(differ):
                return end + 1 + int(differ[-1])
            at, done = end, end < 0
        if done:
            return at
        size *= 2


def is_least_period(words: np.ndarray, start: int, q: int) -> bool:
    """Whether no proper divisor of ``q`` is a period, in a stretch of period ``q`` of two periods at least."""
    rest, prime = q, 2
    while rest > 1:
        if rest % prime == 0:
            d = q // prime
            if (words[start:start + q] == words[start + d:start + d + q]).all():
                return False
            while rest % prime == 0:
                rest //= prime
        prime = prime + 1 if prime * prime <= rest else rest
    return True


def small_periods(words: np.ndarray) -> list[Region]:
    """Stretches of a period up to ``SMALL``, as long as the least scale asks for that leaves them out."""
    found = []
    for q in range(1, min(SMALL, len(words) - 1) + 1):
        begin, end = stretches(words[:-q] == words[q:])
        enough = max(TIMES * q, min(MIN_WORDS, 1 << (3 * q - 1).bit_length()))
        long = end - begin + q >= enough
        for b, e in zip(begin[long].tolist(), end[long].tolist()):
            if is_least_period(words, b, q):
                found.append((b, e + q, q))
    return found


def synchronising_set(h: np.ndarray, t: int, regions: list[Region]) -> np.ndarray:
    """The places of the set at scale ``t``; ``h`` are the hashes of the windows of ``t`` words."""
    none = np.iinfo(np.uint64).max
    order = mix(h + np.uint64(t)) >> np.uint64(1)
    for start, end, q in regions:
        if 3 * q <= t and end - start >= t:
            order[start:end - t + 1] = none
    low = least(order, t + 1)
    n = len(low)
    return np.flatnonzero((low != none) & ((low == order[:n]) | (low == order[t:t + n])))


def proposals(places: np.ndarray, context: np.ndarray, t: int, n: int) -> list[tuple[int, int]]:
    """``period, place`` of the places whose period's words stand there twice, in order."""
    if not len(places):
        return []
    keys = context[places]
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    found = []
    for k in range(1, len(places)):
        q = places[k:] - places[:-k]
        near = (keys[k:] == keys[:-k]) & (q < 4 * t)
        if not near.any():
            break
        near &= q >= 2 * t
        s, q = places[:-k][near], q[near]
        inside = s + 2 * q <= n
        s, q = s[inside], q[inside]
        twice = context[s + q - 2 * t] == context[s + 2 * q - 2 * t]
        found += zip(q[twice].tolist(), s[twice].tolist())
    return sorted(set(found))


def find_runs(words: np.ndarray, sizes: list[int]) -> list[Region]:
    """All runs of texts that stand behind each other, each with an end mark of its own; ``sizes`` in falling order."""
    regions = small_periods(words)
    ends = np.cumsum(np.array(sizes) + 1)
    h, t = mix(words.astype(np.uint64) + np.uint64(1)), 1
    while t < 4 and len(h) > t:
        h, t = doubled(h, t), 2 * t
    while sizes and sizes[0] >= 6 * t:
        n = int(ends[sum(1 for _ in takewhile(lambda size: size >= 6 * t, sizes)) - 1])  # texts that may hold such a run
        h = h[:n - t + 1]
        context = doubled(h, t)
        reached = {}
        for q, place in proposals(synchronising_set(h, t, regions), context, t, n):
            if q <= SMALL or place < reached.get(q, 0):
                continue
            begin = same_until(words, place, q, -1) + 1
            end = same_until(words, place, q, 1) + q
            reached[q] = end - q
            if end - begin >= max(MIN_WORDS, TIMES * q) and is_least_period(words, begin, q):
                regions.append((begin, end, q))
        h, t = context, 2 * t
    return [r for r in regions if r[1] - r[0] >= max(MIN_WORDS, TIMES * r[2])]


def of_texts(texts: list[list[bytes]]) -> list[list[Region]]:
    """The runs of each text, by start and then by period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers, ids = {}, []
    for i in order:
        ids.extend([numbers.setdefault(w, len(numbers)) for w in texts[i]])
        ids.append(-1)
    words = np.array(ids, np.int64)
    marks = np.flatnonzero(words < 0)
    words[marks] = len(numbers) + np.arange(len(marks))
    out = [[] for _ in texts]
    begins = np.r_[0, marks + 1]
    for start, end, q in find_runs(words, [len(texts[i]) for i in order]):
        at = int(np.searchsorted(begins, start, "right")) - 1
        first = int(begins[at])
        out[order[at]].append((start - first, end - first, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(words: list[bytes], runs: list[Region]) -> str:
    """The text without the words that a run holds behind its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, end, q in runs:
            gone[start + q] += 1
            gone[end] -= 1
        words = [w for w, g in zip(words, np.cumsum(gone)) if not g]
    return b" ".join(words).decode()


def _found(altered: Callable[[int | None, list[bytes]], list[bytes]] | None):
    def rows(ids, texts):
        runs = of_texts(texts)
        named = [[{"start": s, "length": e - s, "period": q} for s, e, q in r] for r in runs]
        columns = [pa.array(ids, pa.int64()), pa.array(named, RUNS_TYPE), pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    def run(batches):
        for batch in batches:
            ids, texts, held = [], [], 0
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                words = (text.as_py() or b"").split()  # of bytes: at the six ASCII spaces
                if altered is not None:
                    words = altered(key, words)
                if ids and held + len(words) > MOST_WORDS:
                    yield rows(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(key)
                texts.append(words)
                held += len(words)
            if ids:
                yield rows(ids, texts)

    return run


def periodic_runs(docs: DataFrame, altered: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row of ``doc_id, text``: its ``runs`` by start and period, and the text ``collapsed`` to one period a run.

    ``altered`` may change a text's words by its id before runs are sought.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(_found(altered), RUNS_SCHEMA)

