"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is scaled to length one, padded with zeros to ``CODE_BITS`` components (or to its own length, if that is
larger) and turned by one seeded random rotation; its code keeps the signs of the turned components, one bit each,
beside one correction scalar: the inner product of the turned unit vector with its own code direction. From a code and
its scalar the cosine with any query is estimated without bias, with a spread that falls with the root of the number
of bits. A vector whose upper bound, ``SIGMAS`` spreads above its estimate, does not reach the k-th best score that the
task has found so far cannot be among the k nearest but by such a deviation; all other vectors are compared exactly,
in double precision on the original components.

Index and queries meet in blocks: every task packs the index rows it reads into blocks of at most ``SLAB`` vectors, and
``BLOCKS_AT_ONCE`` blocks of at most ``BLOCK`` queries at a time are broadcast to them, a bounded size whatever the
number of queries; no query passes the driver. A task returns its own k best.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component take no part, as
query or as candidate, nor do rows without an id; vectors are compared within their own length; a candidate
with the query's id is the query's own row, repeated or not; equal scores go to the smaller id; a repeated
candidate row counts once for each row; further columns are ignored; an empty table gives an empty result.
"""

from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.llm.common import ready, stored

SEED = 20_240_521
CODE_BITS = 512
SIGMAS = 5.0  # half-width of the error bound, in spreads of the estimate
BLOCK = 1024  # queries in a block
BLOCKS_AT_ONCE = 32  # query blocks that are broadcast together
SLAB = 4096  # vectors compared with a block of queries at a time

INDEX_SCHEMA = "vec_id long, vector array<double>, code binary, scalar double"
PACKED_SCHEMA = "dim int, ids binary, vectors binary, codes binary, scalars binary"
QUERIES_SCHEMA = "dim int, block long, query_ids binary, queries binary"
FOUND_SCHEMA = "query_id long, vec_id long, score double"


@cache
def rotation(dim: int) -> np.ndarray:
    """The first ``dim`` columns of the same random orthogonal matrix in every task."""
    bits = max(CODE_BITS, -(-dim // 8) * 8)
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).normal(size=(bits, dim)))
    return q * np.sign(np.diag(r))


def tamed(vectors: np.ndarray) -> np.ndarray:
    """The vectors times powers of two, so that no square overflows; cosines keep every bit."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def turned(vectors: np.ndarray) -> np.ndarray:
    vectors = tamed(vectors)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return units @ rotation(vectors.shape[1]).T


def _encode(frames):
    for frame in frames:
        for _, group in frame.groupby(frame["vector"].map(len)):
            vectors = np.stack(group["vector"].to_numpy())
            points = turned(vectors)
            codes = np.packbits(points > 0, axis=1)
            scalars = np.abs(points).sum(axis=1) / np.sqrt(points.shape[1])
            yield pd.DataFrame({
                "vec_id": group["vec_id"], "vector": group["vector"],
                "code": [row.tobytes() for row in codes], "scalar": scalars,
            })


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that can be compared, in double precision."""
    vector = F.col(vector_col).cast("array<double>")
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", sound) & F.exists("vector", lambda x: x != 0)
    )


def build_index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Codes of all rows, stored in the shared folder. The rotation depends on nothing in the data."""
    return stored(usable(rows, id_col, vector_col).mapInPandas(_encode, INDEX_SCHEMA), "ann-index")


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``; a pair's value does not depend on its neighbours."""
    a, b = tamed(a), tamed(b)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _packed(batches):
    """The rows of each batch as one row per vector length and at most ``SLAB`` vectors."""
    for batch in batches:
        frame = batch.to_pandas()
        for dim, group in frame.groupby(frame["vector"].map(len)):
            for at in range(0, len(group), SLAB):
                part = group.iloc[at:at + SLAB]
                row = [dim, part["vec_id"].to_numpy(np.int64).tobytes(), np.stack(part["vector"].to_numpy()).tobytes(),
                       b"".join(part["code"]), part["scalar"].to_numpy(np.float64).tobytes()]
                kinds = [pa.int32()] + [pa.binary()] * 4
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["dim", "ids", "vectors", "codes", "scalars"])


def _query_blocks(key, table):
    """The queries of one block, one row per vector length."""
    frame = table.to_pandas()
    rows = [
        (dim, key[0].as_py(), group["vec_id"].to_numpy(np.int64).tobytes(), np.stack(group["vector"].to_numpy()).tobytes())
        for dim, group in frame.groupby(frame["vector"].map(len))
    ]
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["dim", "block", "query_ids", "queries"])


class Best:
    """The k best scores of each query of a block, as far as a task has come."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.turned = turned(vectors).astype(np.float32)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, scalars: np.ndarray) -> int:
        """Take what a slab has to offer; returns how many pairs were compared exactly."""
        bits = self.turned.shape[1]
        signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
        estimate = (self.turned / np.sqrt(bits)) @ signs.T / scalars.astype(np.float32)
        margin = (SIGMAS * np.sqrt(np.maximum(1 - scalars**2, 0)) / scalars / np.sqrt(max(bits - 1, 1)) + 1e-5).astype(np.float32)
        estimate += margin  # upper bounds from here on
        estimate[self.ids[:, None] == ids[None, :]] = -np.inf
        first = np.argpartition(-estimate, min(self.k, estimate.shape[1]) - 1, axis=1)[:, :self.k]
        row = np.repeat(np.arange(len(self.ids)), first.shape[1])
        near = first.ravel()
        self._offer(row, near, ids, vectors, estimate)
        taken = np.zeros(estimate.shape, bool)
        taken[row, near] = True
        row, near = np.nonzero((estimate >= self.scores[:, -1:]) & ~taken & (estimate > -np.inf))
        for at in range(0, len(row), 200_000):  # bounds the copies of vectors
            self._offer(row[at:at + 200_000], near[at:at + 200_000], ids, vectors, estimate)
        return int(taken.sum()) + len(row)

    def _offer(self, row, near, ids, vectors, estimate):
        live = estimate[row, near] > -np.inf  # not the query's own row
        row, near = row[live], near[live]
        scores = cosines(self.vectors[row], vectors[near])
        good = scores >= self.scores[row, -1]
        row, near, scores = row[good], near[good], scores[good]
        touched = np.unique(row)
        all_rows = np.concatenate([row, np.repeat(touched, self.k)])
        all_scores = np.concatenate([scores, self.scores[touched].ravel()])
        all_ids = np.concatenate([ids[near], self.found[touched].ravel()])
        order = np.lexsort((all_ids, -all_scores, all_rows))
        all_rows, all_scores, all_ids = all_rows[order], all_scores[order], all_ids[order]
        starts = np.flatnonzero(np.r_[True, all_rows[1:] != all_rows[:-1]]) if len(all_rows) else np.empty(0, np.int64)
        place = starts[:, None] + np.arange(self.k)  # every touched query has its k former places at least
        self.scores[touched], self.found[touched] = all_scores[place], all_ids[place]

    def rows(self) -> pa.RecordBatch:
        row, rank = np.nonzero(self.scores > -np.inf)
        columns = [pa.array(self.ids[row]), pa.array(self.found[row, rank]), pa.array(self.scores[row, rank])]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])


def _search(k):
    def run(batches):
        best: dict[tuple[int, int], Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                if (dim, row["block"]) not in best:
                    best[dim, row["block"]] = Best(np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["queries"]).reshape(-1, dim), k)
                ids = np.frombuffer(row["ids"], np.int64)
                best[dim, row["block"]].add(
                    ids, np.frombuffer(row["vectors"]).reshape(-1, dim), np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1),
                    np.frombuffer(row["scalars"]))
        for found in best.values():
            yield found.rows()

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of the index to each query.

    ``queries`` has ``vec_id, vector`` as ``usable`` gives them; of a repeated query id one row is taken. Query blocks
    go over the index ``BLOCKS_AT_ONCE`` at a time; each round's result is stored before the next one.
    """
    ready(index.sparkSession)
    queries = stored(queries.groupBy("vec_id").agg(F.min("vector").alias("vector")), "ann-queries")
    blocks = max(1, -(-queries.count() // BLOCK))
    placed = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    packed_queries = stored(placed.groupBy("block").applyInArrow(_query_blocks, QUERIES_SCHEMA), "ann-query-blocks")
    packed = index.mapInArrow(_packed, PACKED_SCHEMA)
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = None
    for first in range(0, blocks, BLOCKS_AT_ONCE):
        some = packed_queries.where(F.col("block").between(first, first + BLOCKS_AT_ONCE - 1))
        met = packed.join(F.broadcast(some), "dim").mapInArrow(_search(k), FOUND_SCHEMA)
        ranked = met.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if blocks > BLOCKS_AT_ONCE:
            ranked = stored(ranked, "ann-found")
        found = ranked if found is None else found.unionByName(ranked)
    return found
