"""Sorted output and top-k, with the key as tie-breaker so that results are repeatable."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(by: list[str]) -> list[Column]:
    """Sort keys; a leading minus means descending."""
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in by]


def order_by(df: DataFrame, by: list[str]) -> DataFrame:
    return df.orderBy(*_keys(by))


def top_k(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows; each task keeps its own ``k``, so nothing is sorted in full."""
    return df.orderBy(*_keys(by)).limit(k)


def rank_in(column: str, order: list[str]) -> Column:
    """Position of a value in ``order``, counted from 1; unlisted values come last."""
    rank = F.lit(len(order) + 1)
    for position, value in reversed(list(enumerate(order, 1))):
        rank = F.when(F.col(column) == value, position).otherwise(rank)
    return rank


def order_listed(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    return df.orderBy(rank_in(column, order), column)
