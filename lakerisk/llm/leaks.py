"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Words are the symbols. A random walk over a window writes the word it stands on at every step and moves on by a
random bit of that word and step; windows a few edits apart soon walk in step again, so their walks agree in
most steps: the edit distance has become a Hamming distance. ``REPEATS`` samples of ``SAMPLED`` steps, dealt to
``WALKS`` independent walks, hash each window. An item's window size is the largest of ``SIZES`` that leaves room
for shifts; documents are walked from every ``size / 3``-th word, items from every word, so that a passage meets the
index at some shift wherever it stands. Items of fewer than ``SHORT`` words may have one edit at most, so one of
their halves stands untouched in the document, and every place is compared with the halves. A window that shares
``VOTES`` hashes with an item is aligned with the whole item, and counts where the exact edit distance in words is at
most ``SHARE`` of the item's words. The recall aimed at is 0.99 at ``SHARE``.

Words are runs of digits, letters and all characters outside ASCII, with A-Z in lower case. Items are indexed
in blocks of ``ITEMS``; each block is one pass over the documents and bounds what is sent to the tasks.

Defined cases: a null or empty document holds no item; an item without words is held by no document; a missing
id is reported as missing; items with equal texts are all reported; a passage that occurs more than once is
reported at each place; repeated rows are reported each; an empty table on either side gives no hits.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import ready
from lakerisk.llm.neardup import mix

WALKS, REPEATS, SAMPLED = 8, 48, 3  # repeats of all walks of a window together
VOTES = 2  # repeats in which a window must meet an item at the same shift
SHARE = 0.2
ITEMS = 5000
SHORT = 10  # items of fewer words are met by whole pieces: with at most one edit, one of two halves is untouched
SIZES = (8, 12, 18)  # of longer items, many short windows: some of them hold few edits
TABLE_BITS = 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
HITS = "array<struct<item_id: bigint, first_word: bigint, last_word: bigint, edits: bigint>>"
_HIT = pa.list_(pa.struct([("item_id", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64())]))


def word_hashes(text: bytes) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) | np.uint64(1)  # 0 ends a text


def stride(size: int) -> int:
    return max(1, size // 3)


def size_for(n_words: int) -> int:
    """The largest window size of which every shift by less than a stride fits into so many words."""
    return max(size for size in SIZES if size + stride(size) - 1 <= n_words)


def walks(words: np.ndarray, starts: np.ndarray, size: int):
    """The hashes from each start: one row a repeat. ``words`` ends with enough zeros.

    ``REPEATS`` are dealt to ``WALKS`` independent walks, so that one that parts early does not lose a passage.
    """
    random = np.random.default_rng(size)
    steps = max(SAMPLED, 3 * size // 2)
    # apart by two steps at least, as a walk often stays on a word
    slots = (steps + 1) // 2
    for _ in range(WALKS):
        odds = random.integers(0, 2**63, steps, np.uint64) | np.uint64(1)
        sampled = [set((2 * random.choice(slots, SAMPLED, replace=False)).tolist()) for _ in range(REPEATS // WALKS)]
        hashes = np.repeat(mix(random.integers(0, 2**63, len(sampled), np.uint64))[:, None], len(starts), axis=1)
        at = starts.copy()
        for step in range(steps):
            symbol = words[at]
            for repeat, own in enumerate(sampled):
                if step in own:
                    _add(hashes[repeat], symbol)
            at += ((symbol * odds[step]) >> np.uint64(63)).astype(np.int64)
        yield from hashes


def _add(hashes: np.ndarray, symbol: np.ndarray) -> None:
    hashes ^= symbol
    hashes *= np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)


def pieces(words: np.ndarray, starts: np.ndarray, length: int):
    """The hash of so many words from each start: a single row."""
    hashes = np.full(len(starts), 0x51ED270B5A1F3C29, np.uint64)
    for k in range(length):
        _add(hashes, words[starts + k])
    yield hashes


def align(pattern: list[int], text: list[int], most: int) -> list[tuple[int, int]]:
    """Ends in ``text`` of the best alignments of the whole pattern, with at most ``most`` edits: (edits, end).

    Bit-parallel columns; of a run of ends next to each other the best is taken.
    """
    masks: dict[int, int] = {}
    for i, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << i
    n, full, top = len(pattern), (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    plus, minus, score, found = full, 0, n, []
    for end, word in enumerate(text, 1):
        equal = masks.get(word, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(across | plus) & full, plus & across
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        if score <= most:
            if found and end - found[-1][2] <= 1:
                best = found[-1]
                found[-1] = (score, end, end) if score < best[0] else (best[0], best[1], end)
            else:
                found.append((score, end, end))
    return [(edits, end) for edits, end, _ in found]


class Index:
    """The walks of a block of items, by window size."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.items = [(item_id, words) for item_id, text in items if len(words := word_hashes(text))]
        self.tables = []  # how documents are read (function, size, stride, votes a hash counts for), and what is known
        by_reading: dict[tuple, list[tuple[int, np.ndarray]]] = {}
        for number, (_, words) in enumerate(self.items):
            n = len(words)
            if n >= SHORT:
                size = size_for(n)
                by_reading.setdefault((walks, size, stride(size), 1), []).append((number, np.arange(n - size + 1)))
            elif int(SHARE * n):
                by_reading.setdefault((pieces, n // 2, 1, VOTES), []).append((number, np.zeros(1, np.int64)))
                by_reading.setdefault((pieces, n - n // 2, 1, VOTES), []).append((number, np.full(1, n // 2)))
            else:
                by_reading.setdefault((pieces, n, 1, VOTES), []).append((number, np.zeros(1, np.int64)))
        for reading, own in sorted(by_reading.items(), key=lambda x: x[0][1:]):
            joined, starts = [], []
            at = 0
            for number, shift in own:
                words = self.items[number][1]
                starts.append(at + shift)
                joined += [words, np.zeros(1, np.uint64)]
                at += len(words) + 1
            words = np.concatenate([*joined, np.zeros(2 * reading[1] + SAMPLED, np.uint64)])
            hashes = np.array(list(reading[0](words, np.concatenate(starts), reading[1])))
            owner = np.tile(np.concatenate([np.full(len(shift), number) for number, shift in own]), len(hashes))
            shift = np.tile(np.concatenate([shift for _, shift in own]), len(hashes))
            order = np.argsort(hashes.ravel(), kind="stable")
            known = hashes.ravel()[order]
            table = np.zeros(1 << TABLE_BITS, bool)
            table[known >> np.uint64(64 - TABLE_BITS)] = True
            self.tables.append((reading, known, owner[order], shift[order], table))

    def hits(self, texts: list[bytes]) -> list[list[dict]]:
        """The items that each text holds."""
        docs = [word_hashes(t) for t in texts]
        if not self.items or not docs:
            return [[] for _ in texts]
        lengths = np.array([len(d) for d in docs])
        begins = np.cumsum(lengths + 1) - (lengths + 1)
        gap = np.zeros(1, np.uint64)
        words = np.concatenate([x for d in docs for x in (d, gap)] + [np.zeros(2 * max(reading[1] for reading, *_ in self.tables) + SAMPLED, np.uint64)])
        longest = max(len(own) for _, own in self.items)
        room = longest + int(lengths.max()) + 1
        met = []  # document, item and where the item would begin, in a single number: one a hash shared
        for (read, size, apart, weight), known, owner, shift, table in self.tables:
            counts = np.maximum(0, (lengths - size) // apart + 1)
            doc = np.repeat(np.arange(len(docs)), counts)
            place = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * apart
            for low in range(0, len(doc), 1 << 16):
                own_doc, own_place = doc[low:low + (1 << 16)], place[low:low + (1 << 16)]
                for hashes in read(words, begins[own_doc] + own_place, size):
                    likely = np.flatnonzero(table[hashes >> np.uint64(64 - TABLE_BITS)])
                    first = np.searchsorted(known, hashes[likely], "left")
                    last = np.searchsorted(known, hashes[likely], "right")
                    pick = np.repeat(np.arange(len(likely)), last - first)
                    entry = np.arange(len(pick)) - np.repeat(np.cumsum(last - first) - last, last - first)
                    at = likely[pick]
                    met += [(own_doc[at] * len(self.items) + owner[entry]) * room + own_place[at] - shift[entry] + longest] * weight
        if not met:
            return [[] for _ in texts]
        near, votes = np.unique(np.concatenate(met), return_counts=True)
        pair, begin = np.divmod(near[votes >= VOTES], room)
        doc, item = np.divmod(pair, len(self.items))
        return self._verified(docs, zip(doc.tolist(), item.tolist(), (begin - longest).tolist()))

    def _verified(self, docs, near) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in docs]
        spans: dict[tuple[int, int], list[list[int]]] = {}
        for doc, item, begin in near:  # stretches of the document to align, joined where they overlap
            n = len(self.items[item][1])
            most = int(SHARE * n)
            low, high = max(0, begin - 2 * most), min(len(docs[doc]), begin + n + 2 * most)
            own = spans.setdefault((doc, item), [])
            if own and low <= own[-1][1]:
                own[-1][1] = max(own[-1][1], high)
            else:
                own.append([low, high])
        for (doc, item), own in spans.items():
            item_id, words = self.items[item]
            pattern, most = words.tolist(), int(SHARE * len(words))
            for low, high in own:
                text = docs[doc][low:high].tolist()
                held = set(text)
                if sum(word not in held for word in pattern) > most:  # each such word is an edit
                    continue
                for edits, end in align(pattern, text, most):
                    back = align(pattern[::-1], text[max(0, end - len(pattern) - most):end][::-1], edits)
                    length = min((b for e, b in back if e == edits), default=len(pattern))
                    out[doc].append({"item_id": item_id, "first_word": low + end - length, "last_word": low + end - 1, "edits": edits})
        return out


def _searched(index):
    def run(batches):
        for batch in batches:
            texts = [b"" if t is None else t for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            found = index.value.hits(texts)
            hits = [(old or []) + new for old, new in zip(batch.column("_hits").to_pylist(), found)]
            columns = [pa.array(hits, _HIT) if c == "_hits" else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with ``hits``: item, first and last word of the passage (words from 0) and its edits."""
    spark = ready(docs.sparkSession)
    kept = [c for c in docs.columns if c != "hits"]
    rows = docs.select(F.col(text_col).alias("_text"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(kept) if c != text_col],
                       F.array().cast(HITS).alias("_hits"))
    items = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    blocks = -(-items.count() // ITEMS)
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        index = Index([(row["item_id"], row["text"].encode()) for row in own])
        rows = rows.mapInArrow(_searched(spark.sparkContext.broadcast(index)), rows.schema)
    names = {c: "_text" if c == text_col else f"_{i}" for i, c in enumerate(kept)}
    return rows.select(*[F.col(names[c]).alias(c) for c in kept], F.col("_hits").alias("hits"))
