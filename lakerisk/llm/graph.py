"""Connected components by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.common import discard, stored


def _hung_below(edges: DataFrame, upward: bool) -> DataFrame:
    """Each node's larger (large star) or smaller (small star) neighbours, tied to its smallest neighbour or itself."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = edges.join(smallest, "u")
    if upward:
        return met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    tied = met.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(smallest.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v"))


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of the links ``a, b`` reaches. Nodes without links are left out.

    Every pass aggregates and joins on a node's neighbours; a node with very many of them is split like any
    skewed join key. The number of passes grows with the logarithm of the longest path.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = _print(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_hung_below(both, True).distinct(), "large-star")
        last, edges = edges, stored(_hung_below(large, False).distinct(), "small-star")
        discard(large)
        discard(last)
        after = _print(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
