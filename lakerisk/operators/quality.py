"""Counts, profiles and checks on the layers."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakerisk.functions.measures import rate_pct, row_count
from lakerisk.operators.layers import key_duplicates
from lakerisk.operators.ordering import top_k
from lakerisk.operators.rules import STRICT, broken_rules


def preview(silver: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """The chosen columns of the ``k`` lowest transaction ids."""
    return top_k(silver.select("transaction_id", *columns), ["transaction_id"], k)


def layer_counts(raw: DataFrame, bronze: DataFrame, silver: DataFrame) -> DataFrame:
    parts = [
        df.agg(row_count().alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in (("raw", raw), ("bronze", bronze), ("silver", silver))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


class Counted:
    """Counts of frames on the way through the job that uses them; no frame is read again to be counted.

    ``through(name, df)`` stands for ``df`` in a plan. After that plan's job, ``counts`` has the rows that passed, also where
    a stage had to run again: an observed metric of a task counts once. A frame that the job did not need, such as one
    side of a join whose other side turned out empty, counts as not seen and is missing from ``counts``.
    """

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def through(self, name: str, df: DataFrame) -> DataFrame:
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], row_count().alias("rows"))

    def counts(self) -> dict[str, int]:
        return {name: seen.get["rows"] for name, seen in self._seen.items() if seen.get.get("rows") is not None}


def counts_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "layer string, rows long")


def silver_vs_bronze(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    counted = bronze.agg(row_count().alias("bronze")).scalar()
    return silver.agg(row_count().alias("silver")).withColumn("bronze", counted)


def profile_amount(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"),
        row_count().alias("total"))


def profile_fraud(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("is_fraud").agg(row_count().alias("total"))


def duplicate_ids(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    return key_duplicates(df, key)


def missing(df: DataFrame, column: str = "segment") -> DataFrame:
    return df.filter(F.col(column).isNull())


def null_segment_count(silver: DataFrame) -> DataFrame:
    return missing(silver).agg(row_count().alias("sem_segmento"))


def quality_indicators(raw: DataFrame) -> DataFrame:
    """Size, empty cells, repeated ids and value ranges of Raw.

    Rows are first reduced to one per id. The repeated ids are counted from that, and every other
    figure adds up over it, so one shuffle serves them all and no id's rows meet in one list.
    """
    empty_cells = sum(F.col(c).isNull().cast("bigint") for c in raw.columns)
    ranges = {"amount": ("min",), "risk_score": ("min", "max"), "credit_score": ("min", "max")}
    extremes = [(getattr(F, how), f"{how}_{c}", c) for c, hows in ranges.items() for how in hows]
    per_id = raw.groupBy("transaction_id").agg(
        row_count().alias("n"),
        F.sum(empty_cells).alias("empty"),
        *[how(c).alias(name) for how, name, c in extremes],
    )
    repeated = F.col("transaction_id").isNotNull() & (F.col("n") > 1)
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.lit(len(raw.columns)).alias("columns"),
        F.coalesce(F.sum("empty"), F.lit(0)).alias("null_cells"),
        F.count(F.when(repeated, 1)).alias("duplicate_ids"),
        *[how(name).alias(name) for how, name, _ in extremes],
    )


def partition_monitor(raw_parts: DataFrame) -> DataFrame:
    """Volume, rejected rows and newest record of each year/month partition."""
    rejected = F.sum(F.when(F.size(broken_rules(STRICT)) > 0, 1).otherwise(0))
    return raw_parts.groupBy("year", "month").agg(
        row_count().alias("rows"),
        rejected.alias("rejected"),
        rate_pct(rejected, row_count(), 4).alias("rejected_pct"),
        F.max("timestamp").alias("newest"),
    )
