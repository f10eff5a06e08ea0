"""Line deduplication with levelled sorted runs.

The corpus is taken in batches of ascending ids. The lines seen so far stand in runs: tables of line hashes
with the id that keeps the line, bucketed by hash and sorted within the buckets, so that a merge join reads
them as they lie, without a shuffle. A batch reduces its lines to one row a hash, drops the hashes that a run
holds (a merge anti-join with each run), and adds the rest as a run of its own. When ``FANOUT`` runs stand on
a level, they are compacted into one run of the next level.

A line's key is the line without white space at either end, with A-Z in lower case; keys are compared by a
128-bit hash. A key of at least ``MIN_CHARS`` code points keeps its lines in the smallest id that holds it,
all of them if it stands there more than once, and loses them elsewhere.

Defined cases: a null or empty text is one empty line and comes out as an empty text; rows of one id count as
one document; rows without an id count together as one document after all others; input columns named like
an output column are replaced by it, all others stay; an empty table gives an empty table.
"""

import uuid
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import parts, ready, stored
from lakerisk.session import shared_dir

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
LAST = 2**63 - 1  # where rows without an id stand in the order; ``none`` tells them from a row of that id
LINES_SCHEMA = "hash binary, keeper long, none int, mark long"


def digest(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a line's key; None for a key too short to count."""
    key = line.strip().lower()  # of bytes: the six ASCII spaces and A-Z alone
    if len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode()) >= min_chars:
        return xxhash.xxh128_digest(key)
    return None


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def _line_hashes(min_chars):
    def run(batches):
        for batch in batches:
            hashes, ids, nones, marks = [], [], [], []
            for key, none, mark, text in zip(*(batch.column(c).to_pylist() for c in ("_key", "_none", "_mark")), _bytes(batch.column("_text"))):
                found = {h for line in text.split(b"\n") if (h := digest(line, min_chars))}
                hashes += found
                ids += [key] * len(found)
                nones += [none] * len(found)
                marks += [mark] * len(found)
            columns = [pa.array(hashes, pa.binary()), pa.array(ids, pa.int64()), pa.array(nones, pa.int32()), pa.array(marks, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["hash", "keeper", "none", "mark"])

    return run


def _without(min_chars, columns):
    def run(batches):
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(_bytes(batch.column("_text")), batch.column("_gone").to_pylist()):
                lines = text.split(b"\n")
                kept = lines
                if gone:
                    gone = set(gone)
                    kept = [line for line in lines if digest(line, min_chars) not in gone]
                texts.append(b"\n".join(kept).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            made = {"_text": pa.array(texts, pa.string()), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in columns], names=columns)

    return run


class Runs:
    """The runs of all levels, each a bucketed and sorted table in the shared folder."""

    def __init__(self, spark, fanout=FANOUT):
        self.spark, self.fanout, self.levels, self.buckets = spark, fanout, [[]], parts(spark)

    def write(self, rows: DataFrame) -> str:
        name = f"lines_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, "hash").write.format("parquet")
            .bucketBy(self.buckets, "hash").sortBy("hash")
            .option("path", shared_dir(self.spark, name)).saveAsTable(name)
        )
        return name

    def add(self, rows: DataFrame) -> DataFrame:
        """The rows whose hash no run holds, which become a run."""
        self.compact()
        for name in (name for level in self.levels for name in level):
            rows = rows.join(self.spark.table(name).hint("merge"), "hash", "left_anti")
        self.levels[0].append(self.write(rows))
        return self.spark.table(self.levels[0][-1])

    def compact(self) -> None:
        for number, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                merged = self.spark.table(level[0])
                for name in level[1:]:
                    merged = merged.unionByName(self.spark.table(name))
                if number + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[number + 1].append(self.write(merged))
                self.forget(level)
                level.clear()

    def forget(self, names) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def close(self) -> None:
        for level in self.levels:
            self.forget(level)


def batch_bounds(keys: DataFrame, batches: int) -> list[int]:
    """Ids that cut the corpus into batches of about the same number of rows."""
    if batches < 2:
        return []
    cuts = keys.agg(F.percentile_approx("_key", [i / batches for i in range(1, batches)], 1000)).first()[0]
    return sorted(set(cuts or []))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with the kept text, and ``n_lines`` (before dropping) and ``n_dropped``."""
    spark = ready(docs.sparkSession)
    others = [c for c in docs.columns if c not in (id_col, text_col, "n_lines", "n_dropped")]
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_key"), F.col(id_col).isNull().cast("int").alias("_none"), F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_mark"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(others)],
    )
    bounds = batch_bounds(rows.select("_key"), batches)
    runs, gone = Runs(spark, fanout), []
    for low, high in zip([None, *bounds], [*bounds, None]):
        batch = rows
        if low is not None:
            batch = batch.where(F.col("_key") >= low)
        if high is not None:
            batch = batch.where(F.col("_key") < high)
        lines = stored(batch.select("_key", "_none", "_mark", "_text").mapInArrow(_line_hashes(min_chars), LINES_SCHEMA), "lines")
        # where the least is LAST, all rows have it, and those with an id come before those without
        fresh = runs.add(lines.groupBy("hash").agg(F.min("keeper").alias("keeper"), F.min("none").alias("none")))
        # joined on the id too: a line that many documents hold is spread over all tasks
        gone.append(stored(lines.join(fresh, ["hash", "keeper", "none"], "left_anti"), "lines-gone"))
    runs.close()

    # By text as well as id: rows without an id, or of one id, do not share an array. Texts of one id whose
    # marks are equal may, as whether a line goes depends on the line and the id alone.
    by_text = [F.col("keeper").alias("_key"), F.col("none").alias("_none"), F.col("mark").alias("_mark")]
    dropped = reduce(DataFrame.unionByName, gone).groupBy(*by_text).agg(F.collect_set("hash").alias("_gone"))
    names = ["_id", "_text", "n_lines", "n_dropped", *[f"_{i}" for i in range(len(others))]]
    types = dict(rows.dtypes) | {"n_lines": "bigint", "n_dropped": "bigint"}
    schema = ", ".join(f"{c} {types[c]}" for c in names)
    kept = rows.join(dropped, ["_key", "_none", "_mark"], "left").mapInArrow(_without(min_chars, names), schema)
    return kept.toDF(id_col, text_col, "n_lines", "n_dropped", *others)
