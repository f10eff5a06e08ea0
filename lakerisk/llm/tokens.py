"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

Such a tokenizer cuts a text by a pattern and encodes every part for itself, so a text may be cut beforehand at
any place where the pattern is certain to cut. Those places are found for a block of texts at once; only parts
that a worker has not met lately are given to the tokenizer, the ids of all others are looked up by the part's
64-bit hash: a polynomial one, found for all parts at once, up to ``SHORT`` bytes, and XXH3 for longer parts, as
polynomials modulo a power of two agree on some long texts whatever their base. Strings of special tokens are ordinary
text.
"""

from functools import cache
from itertools import repeat

import numpy as np
import xxhash
from tokenizers import Tokenizer

BLOCK = 1 << 20  # bytes of text handled at a time
SHORT = 32  # bytes of a part that the polynomial hash is trusted with
REMEMBERED = 800_000  # parts that a worker remembers

LETTER, DIGIT, SPACE, BREAK, MARK, QUOTE, UNSURE = range(7)


def _classes() -> np.ndarray:
    kinds = np.full(256, UNSURE, np.uint8)  # control characters and all bytes of characters outside ASCII
    kinds[0x21:0x7F] = MARK
    for low, high, kind in (("a", "z", LETTER), ("A", "Z", LETTER), ("0", "9", DIGIT)):
        kinds[ord(low):ord(high) + 1] = kind
    kinds[[9, 10, 11, 12, 13]] = BREAK
    kinds[ord(" ")], kinds[ord("'")] = SPACE, QUOTE
    return kinds


def _sure_cuts() -> np.ndarray:
    """By the kinds of two neighbours: the pattern is certain to cut between them."""
    cuts = np.zeros((7, 7), bool)
    cuts[LETTER, [DIGIT, BREAK, MARK, QUOTE]] = True
    cuts[DIGIT, [LETTER, BREAK, MARK, QUOTE]] = True
    cuts[MARK, [LETTER, DIGIT, BREAK]] = True  # a quote may begin a contraction
    cuts[BREAK, [LETTER, DIGIT, MARK, QUOTE]] = True
    return cuts


KINDS, CUTS = _classes(), _sure_cuts()
# U+00C0 to U+017F are letters of two bytes, but for the signs of multiplication and division
LATIN_LEAD = np.isin(np.arange(256), [0xC3, 0xC4, 0xC5])
SIGN = np.isin(np.arange(256), [0x97, 0xB7])
WHITE = np.isin(np.arange(7), [SPACE, BREAK])
SOLID = np.isin(np.arange(7), [LETTER, DIGIT, MARK, QUOTE])  # the last white space before these stands apart
_RANDOM = np.random.default_rng(7)
BYTES = _RANDOM.integers(0, 2**64, 256, np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(of):
        out = np.full(size + 1, of, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return powers(BASE), powers(INVERSE)


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.newline = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.start, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.used = np.zeros(1 << 18, np.uint32), 0

    def _add(self, keys: list[int], counts: np.ndarray, ids: np.ndarray) -> None:
        at, stop = len(self.known), self.used + len(ids)
        while at + len(keys) > len(self.start):
            self.start, self.count = np.resize(self.start, 2 * len(self.start)), np.resize(self.count, 2 * len(self.count))
        while stop > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.count[at:at + len(keys)] = counts
        self.start[at:at + len(keys)] = self.used + np.cumsum(counts) - counts
        self.pool[self.used:stop] = ids
        self.used = stop
        self.known.update(zip(keys, range(at, at + len(keys))))

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, keys: list[int], lines: list[bytes], others: list[bytes]) -> None:
        """The ids of new parts. Those without white space inside, ``lines``, go to the tokenizer in one text."""
        if lines:
            ids = self._ids(b"\n".join(lines).decode())
            breaks = np.concatenate([[-1], np.flatnonzero(ids == self.newline), [len(ids)]])
            self._add(keys[:len(lines)], np.diff(breaks) - 1, ids[ids != self.newline])
        for key, part in zip(keys[len(lines):], others):
            ids = self._ids(part.decode())
            self._add([key], np.array([len(ids)]), ids)

    def _block(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text; texts are not empty."""
        data = b"".join(texts)
        raw = np.frombuffer(data, np.uint8)
        kinds = KINDS[raw]
        latin = np.flatnonzero(LATIN_LEAD[raw[:-1]] & ((raw[:-1] != 0xC3) | ~SIGN[raw[1:]]))
        kinds[latin] = kinds[latin + 1] = LETTER
        ends = np.cumsum([len(t) for t in texts])
        cut = np.zeros(len(raw), bool)
        cut[1:] = CUTS[kinds[:-1], kinds[1:]]
        apart = WHITE[kinds[:-1]] & SOLID[kinds[1:]]
        apart[ends[:-1] - 1] = False  # what follows is another text
        cut[:-1] |= apart
        cut[0] = True
        cut[ends[:-1]] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(raw))

        up, down = _powers(max(BLOCK, 1 << (len(raw) - 1).bit_length()))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTES[raw] * up[:len(raw)], out=sums[1:])
        keys = (sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * BYTES[0]
        for i in np.flatnonzero(end - begin > SHORT).tolist():
            keys[i] = xxhash.xxh3_64_intdigest(data[begin[i]:end[i]])
        keys, first, where = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > REMEMBERED:
            self.forget()
        place = np.fromiter(map(self.known.get, keys.tolist(), repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(place < 0)
        if len(new):
            doubtful = np.zeros(len(raw) + 1, np.int32)
            np.cumsum(WHITE[kinds] | (kinds == UNSURE), out=doubtful[1:])
            low, high = begin[first[new]], end[first[new]]
            inner = low + (kinds[low] == SPACE)
            plain = (doubtful[high] == doubtful[inner]) & (inner < high)
            parts = [data[b:e] for b, e in zip(low.tolist(), high.tolist())]
            for i in np.flatnonzero(~plain).tolist():  # it may be a word of another script
                part = parts[i].decode()
                plain[i] = len(part.split()) == 1 and part.lstrip(" ") == part.strip()
            order = np.argsort(~plain, kind="stable")
            parts = [parts[i] for i in order.tolist()]
            at, n = len(self.known), int(plain.sum())
            self._learn(keys[new[order]].tolist(), parts[:n], parts[n:])
            place[new[order]] = np.arange(at, at + len(new))
        place = place[where]
        counts = self.count[place]
        stop = np.cumsum(counts)
        source = np.arange(stop[-1]) + np.repeat(self.start[place] - (stop - counts), counts)
        ids = self.pool[source]
        bounds = [0, *stop[np.searchsorted(begin, ends[:-1]) - 1].tolist(), len(ids)]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit numbers."""
        pieces = [(i, piece) for i, text in enumerate(texts) for piece in _cut(text)]
        found: list[list[np.ndarray]] = [[] for _ in texts]
        at = 0
        while at < len(pieces):
            stop, size = at, 0
            while stop < len(pieces) and (stop == at or size + len(pieces[stop][1]) <= BLOCK):
                size += len(pieces[stop][1])
                stop += 1
            for (i, _), ids in zip(pieces[at:stop], self._block([p for _, p in pieces[at:stop]])):
                found[i].append(ids)
            at = stop
        return [np.concatenate(x) if x else np.empty(0, np.uint32) for x in found]


def _cut(text: bytes) -> list[bytes]:
    """A very long text in pieces of about ``BLOCK`` bytes, cut before a space that an ASCII letter follows."""
    out = []
    while len(text) > BLOCK:
        window = np.frombuffer(text, np.uint8, len(text) - BLOCK + 1, BLOCK - 1)
        kinds = KINDS[window]
        spots = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] == LETTER))
        if not len(spots):
            break
        at = BLOCK - 1 + int(spots[0])
        out.append(text[:at])
        text = text[at:]
    return out + [text] if text else out


@cache
def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    return Encoder(path)
