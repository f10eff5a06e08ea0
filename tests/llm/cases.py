"""Awkward rows, and plain versions of what the operators compute."""

import random
import re

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("score", "predicted", "hits", "n_lines", "n_dropped", "key", "id", "n", "bands", "row", "piece", "_text", "words", "place", "found")

LONG = " ".join(f"word{i % 7919} and{i % 13}" for i in range(60_000))
AWKWARD = [
    (1, "One two three four five six seven.\nA shared line of text\n", "en", "a", 40),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n\x0b ", "en", "a", 5),
    (5, "word", "en", "a", 4),
    (6, "One two three four five six seven.\nA SHARED line of text ", "en", "a", None),
    (6, "One two three four five six seven.\nA SHARED line of text ", "en", "a", None),
    (None, "no id here, but a text of some words\nA shared line of text", None, "b", 3),
    (None, None, None, None, None),
    (8, LONG, "en", "a", len(LONG)),
    (9, LONG + " tail", "en", "a", len(LONG) + 5),
    (10, "ünï ℵ   日本語 <|endoftext|> \\ ### </turn> 's 't", "xx", "a", 20),
    (-3, "Licensed under CC BY-NC 4.0.\n\n\n", "en", "a", 31),
]


def awkward(spark, rows=AWKWARD):
    """The awkward rows, with further columns of clashing names."""
    docs = spark.createDataFrame(rows, DOCS)
    return docs.select("*", *[F.lit(f"x{c}").alias(c) for c in CLASHES])


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def groups(texts):
    """The smallest id that each id reaches over links of 0.75."""
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}, {k: len(s) for k, s in sets.items()}


def kept_lines(texts):
    """Lines before, lines dropped and kept text by id; texts in ascending ids."""
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for doc in sorted(texts):
        for line in (texts[doc] or "").split("\n"):
            first.setdefault(key(line), doc)
    out = {}
    for doc, text in texts.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == doc]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def families(seed, bases=12, copies=8):
    """Random texts with near copies of many degrees, exact copies and short ones."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(bases):
        base = random.choices(vocabulary, k=random.randint(3, 60))
        for _ in range(copies):
            words = list(base)
            for _ in range(random.randint(0, 5)):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            texts.append(" ".join(words))
    texts += [texts[0]] * 5 + ["", " ", "w1 w2", "W1  w2"]
    random.shuffle(texts)
    return dict(enumerate(texts))
