import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lakerisk.llm import periodic, queries
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, LONG, awkward, empty


def plain(words):
    """All runs by comparing the words at every distance."""
    numbers = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found, held = [], set()
    for q in range(1, len(ids) // 3 + 1):
        same = np.r_[False, ids[:-q] == ids[q:], False].astype(np.int8)
        turns = np.flatnonzero(np.diff(same))
        for begin, end in zip(turns[::2].tolist(), (turns[1::2] + q).tolist()):
            if end - begin >= max(24, 3 * q) and (begin, end) not in held:  # smaller periods came first
                held.add((begin, end))
                found.append((begin, end, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def whole_row(doc_id, text):
    words = planted(doc_id, split(text))
    runs = plain(words) if len(words) < 50_000 else []  # LONG repeats nothing within 200,000 words
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = max(runs, key=lambda r: ((r[1] - r[0]) / r[2], -r[0], -r[2]), default=None)
    said = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    row = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *row, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def made(seed):
    """Words with repeats of many periods in and beside each other."""
    random.seed(seed)
    words = []
    for _ in range(random.randint(1, 5)):
        base = random.choices([f"w{i}" for i in range(random.choice([1, 2, 3, 40]))], k=random.randint(1, 60))
        if random.random() < 0.4:
            base = base[:7] * random.randint(1, 6) + base
        words += base * random.randint(1, 6) + base[:random.randint(0, len(base))]
        words += random.choices("xyz", k=random.randint(0, 4))
    return words


CASES = [
    [], ["a"], ["a"] * 23, ["a"] * 24, ["a"] * 500, ["a", "b"] * 12, fibonacci(700),
    [str(bin(i).count("1") % 2) for i in range(1024)], ["a"] * 30 + ["b"] * 30, (["a"] * 30 + ["b"]) * 4,
    (list("aaaaaaaaab") * 5 + ["c"]) * 5, [str(i) for i in range(200)] * 3, [str(i) for i in range(200)] * 2 + ["0"] * 9,
]


def test_all_runs_of_texts_read_together():
    texts = CASES + [made(seed) for seed in range(400)]
    for words, got in zip(texts, periodic.of_texts([[w.encode() for w in words] for words in texts])):
        assert got == plain(words)


@pytest.mark.parametrize("seed", range(3))
def test_binary_words_hold_runs_of_many_kinds(seed):
    random.seed(seed)
    for _ in range(100):
        words = random.choices("ab", k=random.randint(20, 80)) * random.randint(1, 5)
        assert periodic.of_texts([[w.encode() for w in words]]) == [plain(words)]


def test_set_depends_on_its_context_and_is_dense():
    random.seed(3)
    words = np.array([random.randrange(3) for _ in range(600)] * 2 + list(range(10, 30)))
    regions = periodic.small_periods(words)
    h = periodic.mix(words.astype(np.uint64) + np.uint64(1))
    for t in (1, 2, 4, 8, 16):
        if t >= 4:
            found = set(periodic.synchronising_set(h, t, regions).tolist())
            free = [i for i in range(600) if not any(3 * q <= t and s <= i and i + 3 * t - 1 <= e for s, e, q in regions)]
            assert all(any(j in found for j in range(i, i + t)) for i in free)
            assert all((i in found) == (i + 600 in found) for i in range(600 - 3 * t))
        h = periodic.doubled(h, t)


def test_query_on_whole_documents_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, SF_SMALL).collect()}
    assert got == {d["doc_id"]: whole_row(d["doc_id"], d["text"]) for d in docs}


def test_awkward_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic, "MOST_WORDS", 50)
    rows = [(i, "once upon a time " * i, "en", "a", 1) for i in range(0, 40)] + [(7, "x\x1cy " * 30, None, None, None)] * 2
    df = awkward(spark).select("*").unionByName(awkward(spark, rows))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want = []
    for r in df.select("doc_id", "text").collect():
        row = whole_row(r["doc_id"], r["text"]) if r["doc_id"] is not None else whole_row(1, r["text"])  # 1 is not altered
        want.append((r["doc_id"], *row[1:]))
    assert zlib.crc32(b"1") % 10 != 0 and got == sorted(want, key=str)
    assert any(r[0] == 8 for r in got) and len(LONG) > 800_000


def test_empty_table(spark):
    assert periodic.periodic_runs(empty(spark, DOCS)).collect() == []
