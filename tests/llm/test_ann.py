import math

import numpy as np

from lakerisk.llm import ann


def plain(rows, queries, k):
    out = []
    for q, u in queries:
        found = sorted((-float(np.dot(u, v) / math.sqrt(np.dot(u, u)) / math.sqrt(np.dot(v, v))), i) for i, v in rows if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


def search(spark, rows, k=5, every=1):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ann.build_index(df)
    found = ann.search(index, index.where(f"vec_id % {every} = 0").select("vec_id", "vector"), k)
    return [tuple(r) for r in found.orderBy("query_id", "rank").collect()]


def test_all_neighbours_are_found(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 40)  # several blocks of queries
    random = np.random.default_rng(1)
    centres = random.normal(size=(20, 24))
    rows = [(i, (centres[i % 20] + random.normal(size=24) * 0.5).tolist()) for i in range(900)]
    got, want = search(spark, rows, every=10), plain([(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in rows if i % 10 == 0], 5)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300, 0, -1)]
    assert [r[:3] for r in search(spark, rows, every=300)] == [(300, n + 1, n + 1) for n in range(5)]


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (None, [1.0, 1.0]), (8, [0.5, 0.5]), (9, [1.0, 1.0, 1.0]), (10, [1e200, 1e200]), (8, [0.5, 0.5])]
    got = search(spark, rows)
    assert {r[0] for r in got} == {1, 8, 10}
    assert [r[2] for r in got if r[0] == 8] == [10, 1]
    assert [r[2] for r in got if r[0] == 10] == [8, 8, 1]


def test_empty_table(spark):
    assert search(spark, []) == []


def test_few_pairs_are_compared_exactly(spark):
    """On the given vectors the bounds leave at most a twentieth of the pairs, and no neighbour is lost."""
    given = np.array([r[0] for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()], float)
    random = np.random.default_rng(6)
    vectors = np.vstack([given, *[given + random.normal(size=given.shape) * 0.1 for _ in range(4)]])
    queries = vectors[::50]
    points = ann.turned(vectors)
    codes, scalars = np.packbits(points > 0, axis=1), np.abs(points).sum(axis=1) / np.sqrt(points.shape[1])
    best, exact, ids = ann.Best(np.arange(0, len(vectors), 50), queries, 5), 0, np.arange(len(vectors))
    for at in range(0, len(vectors), ann.SLAB):
        part = slice(at, at + ann.SLAB)
        exact += best.add(ids[part], vectors[part], codes[part], scalars[part])
    share = exact / (len(queries) * len(vectors))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    whole = unit[::50] @ unit.T
    whole[np.arange(len(queries)), np.arange(0, len(vectors), 50)] = -2
    want = np.argsort(-whole, axis=1)[:, :5]
    print(share)
    assert share < 0.05 and (best.found == want).mean() == 1


def test_many_rounds_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 7)
    monkeypatch.setattr(ann, "BLOCKS_AT_ONCE", 3)
    random = np.random.default_rng(8)
    rows = [(i, random.normal(size=(5, 9)[i % 3 == 0]).tolist()) for i in range(200)]
    got = search(spark, rows)
    want = [w for dim in (5, 9) for own in [[(i, np.array(v)) for i, v in rows if len(v) == dim]] for w in plain(own, own, 5)]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
