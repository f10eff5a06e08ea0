"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are drawn from a bounded sample of the vectors, no two of them nearer than a cosine of
``APART``, each moved to the middle of the sampled vectors around it. Every vector is described by its ``PREFIX``
nearest pivots in order, and stands in the inverted list of each of them. Near vectors order the pivots alike: two
vectors that stand in at least ``SHARED`` common lists, and lie on the same side of nearly all of the first ``SIDES``
pivots, are a candidate; it is handled in the list of the least pivot they share, once, and verified by the cosine of
the original components in double precision. The number of pivots grows with the square root of the number of
vectors, so lists stay of that order.

Copies are one class and are compared as one. Vectors within half of the linking angle of the same pivot are linked
with each other by the triangle inequality: such a ball of at least ``BALL`` classes counts its links without
comparing its members among themselves, so a crowd of near copies costs its size and not its square. A list is
compared in blocks of about ``BLOCK`` vectors, every two of them (but for two of one ball) by one row of a join that
may be split over tasks.

Found are nearly all pairs, not surely all: of made pairs of the least cosine 0.95 on the given vectors 99.8 % or more
(``tests/llm/test_pivots.py`` holds it above 0.99); no pair below the threshold is linked.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component link with nothing; vectors
are compared within their own length; repeated rows and rows of one id are linked as copies; rows without an id take
part, but name no component and are kept only if their whole component has no id; further columns are ignored; an
empty table gives an empty table.
"""

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.ann import cosines, tamed
from lakerisk.llm.common import ready, stored
from lakerisk.llm.graph import components

COSINE = 0.95
PREFIX = 12
SHARED = 4
SIDES = 128
SAME_SIDES = 32  # of SIDES pivots two candidates may lie on different sides; 13 of 128 are to be expected at 0.95
APART = 0.8
SAMPLE_A_PIVOT = 8
MOST_PIVOTS = 4096  # bounds the sample, and what is sent to the tasks: 4,096 vectors
BALL = 32
BLOCK = 1024
AT_ONCE = 200_000  # pairs looked at together

ROW_SCHEMA = "id long, key binary, vector array<double>"
INDEX_SCHEMA = "key binary, dim long, prefix array<int>, sides binary, ball long"
OF_LENGTH = 2**32  # numbers of lists and balls hold the vectors' length above the pivot's number
PAIR_SCHEMA = "a binary, b binary"


def _rows(batches):
    """Rows with the digest of their vector; no digest where it can't be compared."""
    for batch in batches:
        keys, vectors = [], []
        for vector in batch.column("vector").to_pylist():
            found = None
            if vector and None not in vector:
                x = np.array(vector, np.float64) + 0.0  # a zero has no sign
                if np.isfinite(x).all() and x.any():
                    found = x
            keys.append(None if found is None else xxhash.xxh128_digest(found.tobytes()))
            vectors.append(None if found is None else found)
        columns = [batch.column("id"), pa.array(keys, pa.binary()), pa.array(vectors, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "vector"])


def units(vectors: np.ndarray) -> np.ndarray:
    vectors = tamed(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_pivots(sample: np.ndarray, count: int, threshold: float) -> np.ndarray:
    """At most ``count`` reference points for vectors of one length."""
    points = units(sample)
    chosen = np.empty((0, points.shape[1]))
    for point in points:
        if len(chosen) == count:
            break
        if not len(chosen) or (chosen @ point).max() < APART:
            chosen = np.vstack([chosen, point])
    near = (chosen @ points.T >= threshold).astype(float)  # each has itself at least
    return units(near @ points)


def points_of_length(dim: int) -> np.ndarray:
    """Seeded reference points for a length that the sample lacks."""
    return units(np.random.default_rng(dim).normal(size=(64, dim)))


def _indexed(pivots, radius):
    """Every class with its nearest pivots, the sides it lies on, and the pivot whose ball it is in."""
    def run(batches):
        for batch in batches:
            rows, vectors = batch.column("key").to_pylist(), batch.column("vector").to_pylist()
            sizes = np.array([len(v) for v in vectors], np.int64)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                points = pivots.value[int(dim)] if int(dim) in pivots.value else points_of_length(int(dim))
                near = units(np.array([vectors[i] for i in own])) @ points.T
                order = np.argsort(-near, axis=1, kind="stable")[:, :PREFIX]
                best = near[np.arange(len(own)), order[:, 0]]
                sides = np.packbits(np.pad(near[:, :SIDES] > 0, ((0, 0), (0, max(0, SIDES - near.shape[1])))), axis=1)
                columns = [
                    pa.array([rows[i] for i in own], pa.binary()), pa.array(sizes[own]), pa.array(list(order), pa.list_(pa.int32())),
                    pa.array([s.tobytes() for s in sides], pa.binary()), pa.array(np.where(best >= radius, order[:, 0] + dim * OF_LENGTH, -1)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "dim", "prefix", "sides", "ball"])

    return run


def candidates(pivot: int, keys, prefixes, sides, other=None):
    """Index pairs worth verifying, of one block with itself or with another one; handled by the list ``pivot``."""
    size = prefixes.shape[1]
    enough = min(SHARED, size)
    right_prefixes, right_sides = (prefixes, sides) if other is None else other
    step = max(1, AT_ONCE // len(right_sides))
    for at in range(0, len(sides), step):
        apart = np.bitwise_count(sides[at:at + step, None, :] ^ right_sides[None, :, :]).sum(axis=2, dtype=np.int64)
        i, j = np.nonzero(apart <= SAME_SIDES)
        i += at
        if other is None:
            i, j = i[i < j], j[i < j]
        same = prefixes[i][:, :, None] == right_prefixes[j][:, None, :]
        shared = same.any(axis=2)
        least = np.where(shared, prefixes[i], np.iinfo(np.int32).max).min(axis=1, initial=np.iinfo(np.int32).max)
        good = (shared.sum(axis=1) >= enough) & (least == pivot % OF_LENGTH)
        yield i[good], j[good]


def _block(row, side):
    keys = row[f"{side}_keys"].values.to_pylist()
    prefixes = np.array(row[f"{side}_prefixes"].as_py(), np.int32)
    return keys, prefixes, np.frombuffer(b"".join(row[f"{side}_sides"].as_py()), np.uint64).reshape(len(keys), -1)


def _candidates(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            now = {c: batch.column(c)[row] for c in batch.schema.names}
            keys, prefixes, sides = _block(now, "a")
            others, other = (keys, None)
            if not now["same"].as_py():
                others, *other = _block(now, "b")
            for i, j in candidates(now["pivot"].as_py(), keys, prefixes, sides, other):
                left, right = [keys[x] for x in i], [others[x] for x in j]
                ends = [sorted(pair) for pair in zip(left, right)]
                yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends], pa.binary()), pa.array([e[1] for e in ends], pa.binary())], names=["a", "b"])


def _verified(batches, threshold):
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = batch.column("va").to_pylist(), batch.column("vb").to_pylist()
        good = np.zeros(len(left), bool)
        sizes = np.array([len(v) for v in left])
        for dim in np.unique(sizes):
            own = np.flatnonzero(sizes == dim)
            good[own] = cosines(np.array([left[i] for i in own]), np.array([right[i] for i in own])) >= threshold
        yield batch.select(["a", "b"]).filter(pa.array(good))


def build_index(classes: DataFrame, threshold: float = COSINE, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """``key, dim, prefix, sides, ball`` of every class ``key, vector``; the pivots come from at most
    ``SAMPLE_A_PIVOT * most_pivots`` classes, the first by a hash, of each length in proportion."""
    spark = classes.sparkSession
    count = min(most_pivots, max(64, int(4 * classes.count() ** 0.5)))
    sample = classes.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_A_PIVOT * count).select("vector").toPandas()["vector"]
    pivots = {dim: fit_pivots(np.stack(own.to_numpy()), count, threshold) for dim, own in sample.groupby(sample.map(len))}
    radius = np.cos(np.arccos(threshold) / 2) + 1e-9
    return classes.select("key", "vector").mapInArrow(_indexed(spark.sparkContext.broadcast(pivots), radius), INDEX_SCHEMA)


def blocks_of(index: DataFrame) -> DataFrame:
    """The inverted lists, ``pivot, block, ball, keys, prefixes, sides``: a ball has blocks of its own."""
    listed = F.transform("prefix", lambda p: F.col("dim") * OF_LENGTH + p)
    placed = index.select("key", "prefix", "sides", "ball", F.explode(listed).alias("pivot"))
    sizes = placed.groupBy("pivot", "ball").agg(F.count("*").alias("rows"))
    lists = sizes.groupBy("pivot").agg(F.sum("rows").alias("of_list")).where("of_list > 1").select("pivot")
    dealt = placed.join(sizes.join(lists, "pivot"), ["pivot", "ball"])
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("rows") / BLOCK)).cast("int")
    return (
        dealt.groupBy("pivot", "ball", part.alias("part"))
        .agg(F.collect_list(F.struct("key", "prefix", "sides")).alias("rows"))
        .select("pivot", "ball", "part", F.col("rows.key").alias("keys"), F.col("rows.prefix").alias("prefixes"), F.col("rows.sides").alias("sides"))
    )


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Every two blocks of a list that may hold candidates: not a ball with itself."""
    side = lambda s: blocks.select("pivot", *[F.col(c).alias(f"{s}_{c}") for c in blocks.columns if c != "pivot"])
    a, b = F.struct("a_ball", "a_part"), F.struct("b_ball", "b_part")
    met = side("a").join(side("b"), "pivot").where((a <= b) & ((F.col("a_ball") < 0) | (F.col("a_ball") != F.col("b_ball"))))
    again = a == b
    return met.select(
        "pivot", again.alias("same"), "a_keys", "a_prefixes", "a_sides",
        *[F.when(~again, F.col(f"b_{c}")).alias(f"b_{c}") for c in ("keys", "prefixes", "sides")])


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = COSINE) -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly), ``component_id`` and ``kept``."""
    ready(rows.sparkSession)
    read = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    keyed = stored(read.mapInArrow(_rows, ROW_SCHEMA), "vectors")
    # copies collapse inside each task before they are shuffled
    classes = stored(keyed.where("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector")), "vector-classes")
    index = stored(build_index(classes, threshold), "pivot-index")
    balls = index.where("ball >= 0").join(classes.select("key", "copies"), "key").groupBy("ball").agg(
        F.count("*").alias("size"), F.sum("copies").alias("rows"), F.min("key").alias("head")).where(F.col("size") >= BALL)
    balls = stored(balls, "balls")
    in_balls = index.drop("ball").join(index.select("key", "ball").join(balls, "ball", "left_semi"), "key", "left").withColumn("ball", F.coalesce("ball", F.lit(-1).cast("long")))
    blocks = stored(blocks_of(in_balls), "pivot-lists")
    pairs = stored(block_pairs(blocks).mapInArrow(_candidates, PAIR_SCHEMA), "candidates")
    vector = lambda key, name: classes.select(F.col("key").alias(key), F.col("vector").alias(name))
    links = stored(pairs.join(vector("a", "va"), "a").join(vector("b", "vb"), "b").select("a", "b", "va", "vb").mapInArrow(
        partial(_verified, threshold=threshold), PAIR_SCHEMA), "links")

    ties = in_balls.where("ball >= 0").join(balls, "ball").select(F.col("head").alias("a"), F.col("key").alias("b"), "rows")
    parts = components(links.unionByName(ties.select("a", "b")))
    copies = classes.select("key", "copies")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = ends.join(copies.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key")).agg(F.sum("copies").alias("met"))
    named = (
        classes.select("key", "id", "copies").join(met, "key", "left").join(ties.select(F.col("b").alias("key"), "rows"), "key", "left")
        .join(parts.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "id", F.coalesce("root", "key").alias("root"),
                (F.coalesce("met", F.lit(0)) + F.coalesce(F.col("rows") - F.col("copies"), F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    named = stored(named, "named-vectors")
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of_class = named.join(least, "root").select("key", "n_links", "component_id")
    out = keyed.select("id", "key").join(of_class, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.when(component.isNull(), True).otherwise(F.coalesce(F.col("id") == component, F.lit(False))).alias("kept"),
    )
