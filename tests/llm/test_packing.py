import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakerisk.llm import packing, queries, tokens
from tests.llm.cases import AWKWARD, awkward, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "a", " ", "  ", "a  b", "a \n b", "\n\n x", "it's 'tis don't's 's1", "x  y ", "  a  ", "a b ", "b \n", "<|endoftext|> x",
       "é é", "\x1c a\x1cb", "a\t b", "1a2 3.4,5", "''s 'll'x", "€5 €. €€ a", "日本 語。a", "a\u0085b \u0085c", "\r\n\r\nq", "½ⅷx²3", "÷ ×a ſ"]


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_tokenizers(tokenizer):
    random.seed(1)
    parts = ["a", "è", "÷", "ç", "b", " ", "  ", "\n", "'", "s", "t", "1", ".", " ", "\t", "-", "ll", " ", "日", "€", " x"]
    texts = ODD + ["".join(random.choices(parts, k=random.randint(1, 14))) for _ in range(4000)]
    for text, got in zip(texts, tokens.Encoder(PATH).encode([t.encode() for t in texts])):
        assert got.tolist() == ids(tokenizer, text), repr(text)


def test_parts_that_polynomial_hashes_confuse(tokenizer):
    """The Thue-Morse word and its complement agree in every polynomial modulo 2**64."""
    for n in (1024, 2048, 4096):
        texts = ["".join("ab"[(i.bit_count() + flip) % 2] for i in range(n)) for flip in (0, 1)]
        got = tokens.Encoder(PATH).encode([t.encode() for t in texts])
        assert [g.tolist() for g in got] == [ids(tokenizer, t) for t in texts]


def test_long_texts_and_a_full_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 64)
    monkeypatch.setattr(tokens, "REMEMBERED", 30)
    text = " ".join(f"word{i} and,{i}\n\n más" for i in range(300)) + "x" * 500
    assert tokens.Encoder(PATH).encode([text.encode(), b"", b"a"])[0].tolist() == ids(tokenizer, text)


@pytest.mark.parametrize("seed", range(5))
def test_windows_are_full_and_near_equal(seed):
    random.seed(seed)
    sizes = [random.randint(1, 512) for _ in range(random.randint(1, 600))]
    window = packing.windows_for(sizes, 2048)
    loads = np.bincount(window, sizes)
    assert len(window) == len(sizes) and loads.max() <= 2048
    assert len(loads) <= -(-sum(sizes) // 2048) * 1.02 + 1
    if len(sizes) > 100:
        assert loads.max() - loads.min() < 100


def test_differencing_reaches_a_known_optimum():
    assert sorted(np.bincount(packing.difference([8, 7, 6, 5, 4], 2), [8, 7, 6, 5, 4])) == [14, 16]
    assert sorted(np.bincount(packing.difference([5, 5, 4, 4, 3, 3], 3), [5, 5, 4, 4, 3, 3])) == [8, 8, 8]


def check(pieces, texts, tokenizer):
    """Every id in exactly one piece, sequences gapless and within the capacity."""
    pieces = pieces.sort_values(["sequence_id", "offset"])
    assert ((pieces.groupby("sequence_id")["length"].cumsum() - pieces["length"]) == pieces["offset"]).all()
    loads = pieces.groupby("sequence_id")["length"].sum()
    assert loads.max() <= 2048
    for doc, own in pieces.sort_values(["doc_id", "start"]).groupby("doc_id"):
        want = np.array([*ids(tokenizer, texts[doc] or ""), 1], "<u4")
        at = 0
        for row in own.itertuples():
            assert (row.start, row.doc_tokens) == (at, len(want))
            assert row.ids_crc32 == zlib.crc32(want[at:at + row.length].tobytes())
            at += row.length
        assert at == len(want)
    return loads


def test_query_against_the_tokenizer(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").toPandas()
    pieces = queries.QUERIES["op5_packing"](spark, "/root/testdata/sf0.001").toPandas()
    assert set(pieces["doc_id"]) == set(docs["doc_id"])
    loads = check(pieces, dict(zip(docs["doc_id"], docs["text"])), tokenizer)
    assert loads.sum() / (len(loads) * 2048) > 0.97


def test_awkward_rows(spark, tokenizer):
    rows = [r for r in AWKWARD if r[0] is not None and r[0] != 6]
    got = packing.pack(awkward(spark, rows), PATH).toPandas()
    check(got, {r[0]: r[1] for r in rows}, tokenizer)
    assert (got["ids"].map(zlib.crc32) == got["ids_crc32"]).all() and (got["ids"].map(len) == 4 * got["length"]).all()
    everything = packing.pack(awkward(spark), PATH)
    assert everything.where("start = 0").count() == len(AWKWARD)


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
