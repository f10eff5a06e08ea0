"""A corpus pipeline in five stages, each calling one operator of ``lakerisk.llm``.

Every stage takes the documents that its predecessor kept, whole, and its decisions take effect: toxic
documents go; lines that an earlier document holds go from the text (the document itself stays, if need be
empty); of each near-duplicate group the smallest id stays; documents that hold a benchmark passage go; the
rest is packed into sequences. All stages but the last return the columns of ``documents`` in their order.

Null texts leave the second stage as empty ones; rows without an id pass all stages (a leak or a toxic text
removes the row itself); columns beyond those of ``documents`` come through with their values, whatever their names:
no operator sees them under these.
"""

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm import leaks, lines, neardup, packing, toxicity
from lakerisk.llm.common import ready, table
from lakerisk.session import shared_dir


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage: Stage) -> Stage:
    """The stage with further columns of its documents set aside under names that no operator uses."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        aside = [c if c in COLUMNS else f"_aside_{i}" for i, c in enumerate(names)]
        return stage(spark, docs.toDF(*aside), sf_dir).select(*aside).toDF(*names)

    return run


@keeps_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("predicted") == 0).select(*docs.columns)


@keeps_columns
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


@keeps_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of one id stay or go together."""
    copies = neardup.near_duplicates(docs.select("doc_id", "text")).where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_copy")).distinct()
    return docs.join(copies, docs["doc_id"] == F.col("_copy"), "left_anti")


@keeps_columns
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = leaks.find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.where(F.size("hits") == 0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack),
]

# The stages train models and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; each result is stored and read back as the next one's input."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
