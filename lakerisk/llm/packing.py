"""Packing of tokenised documents by Karmarkar-Karp differencing.

A document's ids, closed by an end id, are cut into full windows as far as they go, and the rest into tail
pieces of at most ``TAIL`` ids. Full windows are sequences of their own. The tails are dealt at random (by a
hash, whole rows) into groups of about ``GROUP`` pieces, and every group is split into near-equal windows by
multiway differencing: each piece is first a partition of its own with one loaded window; the two partitions
with the largest differences are merged, the fullest windows of one with the emptiest of the other, until one
partition is left. If its fullest window exceeds the capacity, the number of windows rises and the group is
split again. Groups are small and equal at every size of the corpus, so no task grows with it.

Defined cases: a null text counts as empty; an empty text is the end id alone; every input row is packed, also
repeated ones and those without an id; further columns are ignored; an empty table gives an empty table.
"""

import zlib
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import ready
from lakerisk.llm.tokens import encoder
from lakerisk.session import shared_dir

CAPACITY = 2048
TAIL = 512
GROUP = 1400
END_ID = 1

PIECE_SCHEMA = "doc_id long, row long, start long, length long, doc_tokens long, full boolean, ids_crc32 long, ids binary"
PLACE_SCHEMA = "piece long, sequence_id long, offset long"


def _cut(path, end_id, capacity, tail):
    def pieces(batch):
        texts = ["" if x is None else x for x in batch.column("text").to_pylist()]
        coded = encoder(path).encode([t.encode() for t in texts])
        for doc_id, row, ids in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), coded):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            whole = len(ids) // capacity * capacity
            starts = [*range(0, whole, capacity), *range(whole, len(ids), tail)]
            for begin, end in zip(starts, [*starts[1:], len(ids)]):
                data = ids[begin:end].tobytes()
                yield doc_id, row, begin, end - begin, len(ids), begin < whole, zlib.crc32(data), data

    def run(batches):
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        for batch in batches:
            found = list(zip(*pieces(batch))) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=names)

    return run


def difference(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each piece, by multiway differencing into so many windows."""
    heap, merges = [], []
    for i, size in enumerate(sizes):
        load = np.zeros(windows, np.int64)
        load[0] = size
        heap.append((-size, i, load))
    heapify(heap)
    while len(heap) > 1:
        _, a, left = heappop(heap)
        _, b, right = heappop(heap)
        load = left + right[::-1]
        order = np.argsort(-load, kind="stable")
        load = load[order] - load[order[-1]]  # only differences matter
        merges.append((a, b, order))
        heappush(heap, (-int(load[0]), len(sizes) + len(merges) - 1, load))
    spot = {len(sizes) + len(merges) - 1: np.arange(windows)}  # which window each slot of a partition became
    for number in range(len(merges) - 1, -1, -1):
        a, b, order = merges[number]
        slots = np.empty(windows, np.int64)
        slots[order] = spot.pop(len(sizes) + number)
        spot[a], spot[b] = slots, slots[::-1]
    return np.array([spot[i][0] for i in range(len(sizes))])


def windows_for(sizes: list[int], capacity: int) -> np.ndarray:
    """Near-equal windows within the capacity: their number rises until the fullest one fits."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        window = difference(sizes, windows)
        over = int(np.bincount(window, sizes, windows).max()) - capacity
        if over <= 0:
            return window
        windows += max(1, windows * over // (2 * capacity))


def _place(capacity):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece")
        sizes = group["length"].tolist()
        window = windows_for(sizes, capacity)
        out = pd.DataFrame({"piece": group["piece"].to_numpy(), "window": window, "length": sizes})
        out["offset"] = out.groupby("window")["length"].cumsum() - out["length"]
        out["sequence_id"] = int(group["group"].iloc[0]) * (1 << 20) + out["window"]
        return out[["piece", "sequence_id", "offset"]]

    return run


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, capacity: int = CAPACITY, tail: int = TAIL, group: int = GROUP,
) -> DataFrame:
    """One row per piece: id, ``start, length, doc_tokens, ids, ids_crc32, sequence_id, offset``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. Sequences from tails have ids from
    0 up, full windows have negative ones.
    """
    spark = ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    made = rows.mapInArrow(_cut(tokenizer, end_id, capacity, tail), PIECE_SCHEMA).withColumn("piece", F.monotonically_increasing_id())
    path = shared_dir(spark, "pieces")
    made.write.option("compression", "zstd").parquet(path)  # stored: the numbers above hold from here on
    pieces = spark.read.parquet(path)

    tails = pieces.where("NOT full").select("piece", "row", "length")
    groups = max(1, -(-tails.count() // group))
    dealt = tails.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    placed = dealt.groupBy("group").applyInPandas(_place(capacity), PLACE_SCHEMA)
    sequence = F.when(F.col("full"), -1 - F.col("piece")).otherwise(F.col("sequence_id"))
    offset = F.when(F.col("full"), F.lit(0).cast("long")).otherwise(F.col("offset"))
    return pieces.join(placed, "piece", "left").select(
        F.col("doc_id").alias(id_col), "start", "length", "doc_tokens", "ids", "ids_crc32",
        sequence.alias("sequence_id"), offset.alias("offset"),
    )
