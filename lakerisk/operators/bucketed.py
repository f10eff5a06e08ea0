"""Enrichment of stored facts without moving them: facts and dimension bucketed alike by the join key.

The shuffle by customer is paid once, when Bronze is stored; every join on the customer then reads bucket by bucket.
A customer with more rows than a bucket's share would make one task long: such customers, of which there can be no
more than buckets, are kept apart in evenly sized files and joined with their own rows of the dimension, which are
broadcast.
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.measures import row_count
from lakerisk.operators.layers import add_silver_columns
from lakerisk.session import shared_dir


def store_bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` stored in ``buckets`` files by ``key``, sorted within each; read back with that layout known."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    path = shared_dir(spark, "bucketed")
    (
        df.repartition(buckets, key).write.format("parquet").option("compression", "zstd").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    )
    stored = spark.table(name)
    stored.schema  # resolved, so that the files stay readable when the name goes
    spark.sql(f"DROP TABLE {name}")
    return stored


def hot_keys(df: DataFrame, key: str, buckets: int) -> list:
    """Keys with more rows than an even bucket: fewer than ``buckets`` of them, whatever the data."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(row_count().alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r[key] for r in counts.filter(F.col("n") > total / buckets).select(key).collect()] if total else []


class BucketedFacts:
    """Bronze and customers stored for joins on ``key``."""

    def __init__(self, facts: DataFrame, dimension: DataFrame, key: str = "customer_id", buckets: int = 64):
        self.key, self.hot = key, hot_keys(facts, key, buckets)
        is_hot = F.coalesce(F.col(key).isin(self.hot), F.lit(False)) if self.hot else F.lit(False)
        self.facts = store_bucketed(facts.filter(~is_hot), key, buckets)
        self.dimension = store_bucketed(dimension, key, buckets)
        apart = shared_dir(facts.sparkSession, "hot-facts")
        facts.filter(is_hot).hint("rebalance").write.option("compression", "zstd").parquet(apart)
        self.hot_facts = facts.sparkSession.read.schema(facts.schema).parquet(apart)

    def join(self, columns: list[str]) -> DataFrame:
        """The facts with ``columns`` of the dimension, as an inner join on the key."""
        dim = self.dimension.select(self.key, *columns)
        cold = self.facts.join(dim.hint("merge"), self.key)
        if not self.hot:
            return cold
        few = dim.filter(F.col(self.key).isin(self.hot))  # the dimension's rows of fewer keys than buckets
        return cold.unionByName(self.hot_facts.join(F.broadcast(few), self.key))

    def silver(self) -> DataFrame:
        renamed = self.join(["created_at"]).withColumnRenamed("created_at", "customer_created_at")
        return add_silver_columns(renamed.select(*self.facts.columns, "customer_created_at"))
