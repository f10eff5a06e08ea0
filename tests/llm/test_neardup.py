import numpy as np
import pytest
from pyspark.sql import functions as F

from lakerisk.llm import neardup
from lakerisk.llm.graph import components
from tests.llm.cases import awkward, empty, families, groups


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    texts = families(seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    roots, sizes = groups(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == {k: (sizes[k], roots[k], roots[k] == k) for k in texts}


def test_a_family_around_the_threshold_is_linked_in_full(spark):
    """One large bucket in which many pairs are just below the threshold: hubs alone would miss links."""
    texts = families(3, bases=1, copies=150)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    roots, _ = groups(texts)
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()} == roots


@pytest.mark.parametrize("elements", [neardup.ELEMENTS, 300])
def test_a_large_family_in_many_blocks(spark, monkeypatch, elements):
    monkeypatch.setattr(neardup, "BLOCK", 24)
    monkeypatch.setattr(neardup, "ELEMENTS", elements)
    texts = families(7, bases=2, copies=300)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    roots, _ = groups(texts)
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()} == roots


def test_full_sets_tie_what_trees_leave(spark):
    """Without any link of the first stage, the second finds all components."""
    texts = families(8, bases=4, copies=30)
    rows = spark.createDataFrame([(0, k, t) for k, t in texts.items() if t.strip()], "pad int, id long, text string").select("id", "text")
    sketched = rows.mapInArrow(neardup._sketched, neardup.SKETCH_SCHEMA)
    one = sketched.groupBy("key").agg(*(F.first(c).alias(c) for c in ("id", "n", "bands", "marks", "tags")))
    members = one.select("key", "n", "marks", "tags", F.posexplode("bands").alias("band", "bucket")).withColumn("root", F.col("key"))
    shared = members.groupBy("bucket").count().where("count > 1").select("bucket")
    sets = rows.mapInArrow(neardup._sets, neardup.SET_SCHEMA).dropDuplicates(["key"])
    links = neardup.further_links(members.join(shared, "bucket"), sets)
    assert links.count() < one.count()
    found = {r["node"]: r["root"] for r in components(links).collect()}
    ids = {r["id"]: found.get(r["key"], r["key"]) for r in one.collect()}
    roots, _ = groups(texts)
    tied = {}
    for doc, root in ids.items():
        tied.setdefault(root, set()).add(roots[doc])
    assert all(len(x) == 1 for x in tied.values()) and len(tied) == len({roots[doc] for doc in ids})


def test_sketches_agree_as_sets_do():
    random = np.random.default_rng(5)
    agree = []
    for _ in range(200):
        a = random.integers(0, 2**63, 100, np.uint64)
        b = np.concatenate([a[:80], random.integers(0, 2**63, 20, np.uint64)])
        agree.append((neardup.sketch(a) == neardup.sketch(b)).mean())
    assert abs(np.mean(agree) - 80 / 120) < 0.02


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_every_coordinate_is_filled(n):
    values = neardup.sketch(np.random.default_rng(n).integers(0, 2**63, n, np.uint64))
    assert values.max() < np.iinfo(np.uint64).max


def test_awkward_rows(spark):
    rows = neardup.near_duplicates(awkward(spark)).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert len(rows) == 13
    assert got[2] == (0, 2, True) and got[3] == (0, 3, True) and got[4] == (0, 4, True) and got[5] == (1, 5, True)
    assert got[6][1:] == (1, False) and got[9][1:] == (8, False)
    assert [r["kept"] for r in rows if r["doc_id"] is None] == [True, True]


def test_empty_table(spark):
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (102, 101)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(links).collect()} == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
