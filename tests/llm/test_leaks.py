import random

from pyspark.sql import functions as F

from lakerisk.llm import leaks, queries
from lakerisk.llm.common import table
from tests.llm.cases import awkward, empty

SF = "/root/testdata/sf0.001"


def distance_in(pattern, text):
    """Least edits between the pattern and any part of the text."""
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for word in text:
        above, column[0] = 0, 0
        for i, own in enumerate(pattern, 1):
            above, column[i] = column[i], min(above + (own != word), column[i] + 1, column[i - 1] + 1)
        best = min(best, column[-1])
    return best


def test_alignment_against_dynamic_programming():
    random.seed(1)
    for _ in range(400):
        pattern, text = random.choices(range(4), k=random.randint(1, 9)), random.choices(range(4), k=random.randint(0, 30))
        best, most = distance_in(pattern, text), random.randint(0, 4)
        found = leaks.align(pattern, text, most)
        assert min((e for e, _ in found), default=None) == (best if best <= most and text else None)
        assert all(distance_in(pattern, text[:end]) <= e for e, end in found)


def test_query_against_all_items(spark):
    """On every document and item: what is within the distance is found, and nothing else."""
    docs = table(spark, SF, "documents").toPandas()
    items = table(spark, SF, "benchmark").toPandas()
    words = {r.item_id: leaks.word_hashes(r.text.encode()).tolist() for r in items.itertuples()}
    want = set()
    for r in docs.itertuples():
        text = leaks.word_hashes((r.text or "").encode()).tolist()
        near = set(text)
        for item, pattern in words.items():
            if sum(w in near for w in pattern) >= 0.8 * len(pattern) and distance_in(pattern, text) <= int(leaks.SHARE * len(pattern)):
                want.add((r.doc_id, item))
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op7_benchmark_leaks"](spark, SF).collect()}
    assert got == want and want


def test_recall_of_edited_passages(spark):
    random.seed(5)
    items = table(spark, "/root/testdata/sf0.1", "benchmark").toPandas()
    vocabulary = [f"word{i}" for i in range(500)]
    index = leaks.Index([(r.item_id, r.text.encode()) for r in items.itertuples()])
    for rate, least in ((0, 1), (0.05, 0.95), (0.1, 0.95)):
        docs = []
        for r in items.itertuples():
            words = r.text.split()
            for _ in range(round(rate * len(words))):
                at, kind = random.randrange(len(words)), random.choice("sid")
                words[at:at + (kind != "i")] = [] if kind == "d" else [random.choice(vocabulary)]
            docs.append(" ".join(random.choices(vocabulary, k=random.randint(0, 60)) + words + random.choices(vocabulary, k=random.randint(0, 60))))
        hits = index.hits([d.encode() for d in docs])
        found = [any(h["item_id"] == i for h in own) for i, own in zip(items["item_id"], hits)]
        assert sum(found) >= least * len(found)


def test_places_blocks_and_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(leaks, "ITEMS", 2)
    passage = " ".join(f"p{i}" for i in range(20))
    docs = awkward(spark).unionByName(awkward(spark, [(50, f"x {passage.upper()}, y {passage} z", None, None, None)]))
    items = spark.createDataFrame([(1, passage), (2, passage), (3, None), (4, ""), (None, "word"), (6, "q1 q2 q3"), (7, "no id here, but a text")], "item_id long, text string")
    rows = leaks.find_leaks(docs, items.withColumn("hits", F.lit(1))).select("doc_id", "lang", "score", F.explode("hits").alias("hit")).collect()
    got = {(r["doc_id"], r["hit"]["item_id"], r["hit"]["first_word"], r["hit"]["last_word"], r["hit"]["edits"]) for r in rows}
    assert {g for g in got if g[0] == 50} == {(50, i, a, a + 19, 0) for i in (1, 2) for a in (1, 22)}
    assert {g[:2] for g in got if g[0] != 50} == {(5, None), (None, 7)}


def test_empty_tables(spark):
    items = "item_id long, text string"
    assert leaks.find_leaks(empty(spark), spark.createDataFrame([(1, "a b c")], items)).count() == 0
    assert leaks.find_leaks(awkward(spark), empty(spark, items)).where(F.size("hits") > 0).count() == 0


def edited(words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at, kind = random.randrange(len(words)), random.choice("sid")
        words[at:at + (kind != "i")] = [] if kind == "d" else [random.choice(vocabulary)]
    return " ".join(random.choices(vocabulary, k=random.randint(0, 60)) + words + random.choices(vocabulary, k=random.randint(0, 60)))


def found(items, edits):
    """The share of items that are found in a text of random words and the item with so many edits."""
    vocabulary = [f"word{i}" for i in range(500)]
    hits = leaks.Index([(i, " ".join(words).encode()) for i, words in enumerate(items)]).hits([edited(w, edits(len(w)), vocabulary).encode() for w in items])
    return sum(any(h["item_id"] == i for h in own) for i, own in enumerate(hits)) / len(items)


def test_recall_up_to_the_declared_distance(spark):
    random.seed(6)
    items = [r["text"].split() for r in table(spark, "/root/testdata/sf0.1", "benchmark").collect()]
    for rate in (0.15, 0.2):
        assert found(items, lambda n: int(rate * n)) >= 0.99


def test_recall_of_items_of_all_lengths():
    random.seed(7)
    for n in (1, 4, 5, 6, 7, 9, 10, 11, 15, 18, 23, 40, 150, 400):
        items = [[f"v{random.randrange(3000)}" for _ in range(n)] for _ in range(200)]
        assert found(items, lambda n: int(leaks.SHARE * n)) >= (1 if n < leaks.SHORT else 0.98)  # 0.99 less the chance of 200 draws
