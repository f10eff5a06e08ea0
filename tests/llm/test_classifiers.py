"""Both classifiers: held-out accuracy, what a score may depend on, and awkward rows."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakerisk.llm import quality, queries, toxicity, training
from lakerisk.llm.common import table
from tests.llm.cases import AWKWARD, awkward, empty

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"
CASES = [("op4_quality", "quality", quality, 0.5, 0.98), ("op10_toxicity", "toxic", toxicity, 0.7, 0.85)]


def area(score, y):
    rank = pd.Series(score).rank().to_numpy()
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("query, label, module, threshold, least", CASES)
def test_held_out_accuracy(spark, query, label, module, threshold, least):
    got = queries.QUERIES[query](spark, SF).toPandas()
    assert len(got) == table(spark, SF, "documents").count() and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]).all()
    assert (got["predicted"] == (got["score"] >= threshold)).all()
    rows = got[got["held_out"]].merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert area(rows["score"], rows[label].to_numpy()) > least
    wrong = rows[(rows["predicted"] == 1) & (rows[label] == 0)]
    assert len(wrong) <= 0.02 * len(rows)


@pytest.mark.parametrize("query, label, module, threshold, least", CASES)
def test_held_out_labels_change_nothing(spark, query, label, module, threshold, least):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text"), table(spark, "/root/testdata/sf0.001", "labels")
    turned = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col(label)).otherwise(F.col(label)))
    one, two = (module.score_documents(docs, x).orderBy("doc_id").toPandas()["score"] for x in (labels, turned))
    assert (one == two).all()


@pytest.mark.parametrize("query, label, module, threshold, least", CASES)
def test_awkward_rows_and_labels(spark, query, label, module, threshold, least):
    ids = [r[0] for r in AWKWARD]
    rows = [(i, n % 2, n % 2) for n, i in enumerate(ids)] + [(1, 1, 1), (1, 0, 0), (5, None, None), (99, 1, 1), (None, 1, 1)]
    out = module.score_documents(awkward(spark), spark.createDataFrame(rows, LABELS)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in out) and out[0]["hits"] == "xhits"
    scores = {}
    for r in out:
        scores.setdefault(r["text"] or "", set()).add(r["score"])
    assert len(scores[""]) <= 2  # the stored length may differ, the text does not
    for labels in ([], [(1, 1, 1)]):
        out = module.score_documents(awkward(spark), spark.createDataFrame(labels, LABELS)).collect()
        assert {r["score"] for r in out} == {0.5 if module is quality else 0.0}
    assert module.score_documents(empty(spark), spark.createDataFrame(rows, LABELS)).count() == 0


def test_pairs_in_linear_time_are_the_pairs():
    random = np.random.default_rng(0)
    d = quality.BUCKETS + quality.N_STRUCTURE
    machine = quality.Machine(np.zeros(quality.N_STRUCTURE), np.ones(quality.N_STRUCTURE), 0.1, random.normal(size=d), random.normal(size=(d, 3)))
    x = np.zeros((1, d))
    spots = random.choice(d, 12, replace=False)
    x[0, spots] = random.normal(size=12)
    z = 0.1 + x[0] @ machine.w + sum(machine.v[i] @ machine.v[j] * x[0, i] * x[0, j] for a, i in enumerate(spots) for j in spots[a + 1:])
    assert np.isclose(machine.score(x)[0], 1 / (1 + np.exp(-z)))


def test_windows_hold_the_whole_text():
    text = "  Some words,\n of a text\t that ends ".encode() * 9
    assert b"".join(toxicity.windows(text)) == toxicity.spelled(b" ".join(text.lower().split()) + b" ")
    assert toxicity.windows(b" \n") == []


def test_a_repeated_id_is_one_row_to_learn_from(spark):
    rows = [(i, f"text {i}", 7) for i in range(20)]
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(20)], LABELS)
    learned = [
        training.labelled(spark.createDataFrame(r, "doc_id long, text string, n_chars long"), labels, "toxic", {0: 3, 1: 3}, more=("n_chars",))
        for r in (rows, rows + [(i, f"text {i} {n}", n) for i in range(20) for n in range(30)])
    ]
    assert len(learned[0][0]) == 6 and learned[0][0].equals(learned[1][0]) and learned[0][1] == learned[1][1]


def test_scripts_without_spaces_are_learned():
    """Toxic texts hold the parts of a run side by side, the others apart from each other."""
    random = np.random.default_rng(4)
    pool = [chr(0x4E00 + i) for i in range(300)]

    def text(toxic):
        own = list(random.choice(pool, 60))
        for n, part in enumerate(pool[k] for k in (7, 131, 52, 18, 99)):
            own.insert(20 + n if toxic else 12 * n, part)
        return "".join(own)

    rows = pd.DataFrame([(text(n % 4 == 0), int(n % 4 == 0)) for n in range(600)], columns=["text", "y"])
    model = toxicity.train(rows[:400], {1: 100, 0: 300})
    assert area(model.score([t.encode() for t in rows["text"][400:]]), rows["y"][400:].to_numpy()) > 0.9


def test_a_corpus_of_long_documents_is_learned(spark):
    """Texts that are all far longer than what is learned of one of them."""
    random = np.random.default_rng(3)
    pool = ["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(400)]
    kind, awful = pool[:20], pool[20:40]
    rows = [(i, " ".join(random.choice((kind, awful)[i % 2]) if n % 20 == 7 else random.choice(pool[40:]) for n in range(3_200)), i % 2, i % 2) for i in range(150)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], LABELS)
    learned, counts = training.labelled(docs, labels, "toxic", {0: 75, 1: 75})
    assert sum(counts.values()) == len(learned) and set(learned["text"].map(len)) == {training.MAX_CHARS}
    for module in (quality, toxicity):
        got = module.score_documents(docs, labels).orderBy("doc_id").toPandas()["score"].to_numpy()
        assert got[1::2].mean() > got[::2].mean() + 0.2, module
