import numpy as np
import pytest
from pyspark.sql import functions as F

from lakerisk.llm import pivots

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, threshold=0.95):
    """Links and smallest reachable ids by comparing all rows."""
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    links, root = [[] for _ in good], list(range(len(good)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unit = [v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for _, v in good]
    for i in range(len(good)):
        for j in range(i):
            if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i].append(j)
                links[j].append(i)
                root[find(i)] = find(j)
    names = {}
    for i, (key, _) in enumerate(good):
        if key is not None:
            names[find(i)] = min(names.get(find(i), key), key)
    out = [(key, len(links[i]), names.get(find(i))) for i, (key, _) in enumerate(good)]
    bad = len(rows) - len(good)
    return out, bad


def found(spark, rows, schema=SCHEMA):
    got = pivots.near_vectors(spark.createDataFrame(rows, schema).withColumns({"key": F.lit("x"), "vector": F.lit(1), "n_links": F.lit(2), "id": F.lit(3)}))
    return [tuple(r) for r in got.collect()]


def same(spark, rows):
    got, (want, bad) = found(spark, rows), plain(rows)
    assert len(got) == len(rows) and bad >= 0
    usable = sorted((g[:3] for g in got), key=str)
    loose = [(i, 0, i) for i, v in rows if not (v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v))]
    assert usable == sorted(want + loose, key=str)
    assert all(kept == (component is None or key == component) for key, _, component, kept in got)


def near(random, x, cosine):
    z = random.normal(size=x.shape)
    z -= (z * x).sum(-1, keepdims=True) / (x * x).sum(-1, keepdims=True) * x
    z *= np.linalg.norm(x, axis=-1, keepdims=True) / np.linalg.norm(z, axis=-1, keepdims=True)
    return cosine * x + np.sqrt(1 - cosine**2) * z


def test_against_all_pairs_with_crowds_chains_and_copies(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 40)
    random = np.random.default_rng(4)
    base = random.normal(size=(300, 24))
    groups = [base]
    groups += [near(random, np.repeat(base[i:i + 1], n, axis=0), random.uniform(0.985, 0.9999, (n, 1))) for i, n in ((0, 150), (1, 60), (2, 10))]
    chain = base[3:4]
    for _ in range(12):
        chain = near(random, chain, 0.965)
        groups.append(chain * 7)
    groups.append(np.repeat(base[:1], 80, axis=0))
    vectors = np.vstack(groups)
    order = random.permutation(len(vectors))
    same(spark, [(int(order[i]), v.tolist()) for i, v in enumerate(vectors)])


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    same(spark, [
        (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
        (None, [1.0, 1.0]), (8, [0.5, 0.5]), (9, [1.0, 1.0, 1.0]), (10, [1e200, 1e200]), (8, [0.5, 0.5]), (11, [-0.0, 1.0]),
        (12, [0.0, 3.0]), (None, [0.0, -1.0]), (None, [0.0, -2.0]), (13, [5.0]), (14, [-5.0]), (15, [1e-300]), (None, None),
    ])
    assert found(spark, []) == []


def test_recall_at_the_least_cosine(spark):
    """Made pairs of every degree beside the given vectors, in a table that is not theirs alone."""
    given = np.array([r[0] for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()], float)
    random = np.random.default_rng(9)
    cosines = np.repeat([0.951, 0.96, 0.98], 500)
    made = near(random, given[:1500], cosines[:, None])
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([given, made]))]
    got = {r[0]: r for r in found(spark, rows)}
    hit = np.array([got[2000 + i][1] > 0 for i in range(1500)])
    print([hit[cosines == c].mean() for c in (0.951, 0.96, 0.98)])
    assert hit[cosines == 0.951].mean() >= 0.98 and hit[cosines == 0.96].mean() >= 0.99 and hit[cosines == 0.98].mean() == 1
    assert all(got[i][1] == 0 for i in range(1500, 2000))


def test_a_crowd_is_not_paired(spark):
    """Of 3,000 near copies no pair among the ball's members becomes a candidate."""
    random = np.random.default_rng(2)
    centre = random.normal(size=(1, 32))
    crowd = near(random, np.repeat(centre, 3_000, axis=0), 0.995)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.vstack([crowd, random.normal(size=(500, 32))]))], SCHEMA)
    classes = rows.select(F.md5(F.col("vec_id").cast("string")).cast("binary").alias("key"), F.col("embedding").alias("vector"))
    index = pivots.build_index(classes).cache()
    sizes = index.where("ball >= 0").groupBy("ball").count().orderBy(F.desc("count")).collect()
    assert sizes[0]["count"] == 3_000
    pairs = pivots.block_pairs(pivots.blocks_of(index)).mapInArrow(pivots._candidates, pivots.PAIR_SCHEMA)
    assert pairs.count() < 3_000
    got = pivots.near_vectors(rows).where("vec_id < 3000").collect()
    assert all(r["n_links"] == 2_999 and r["component_id"] == 0 for r in got)


@pytest.mark.parametrize("dim", [1, 2, 3])
def test_few_dimensions(spark, dim):
    random = np.random.default_rng(dim)
    same(spark, [(i, v.tolist()) for i, v in enumerate(random.normal(size=(150, dim)))])
