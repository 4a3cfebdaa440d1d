"""Duplicate removal with a declared, total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in ``order``; the order must leave no ties.

    Spark prunes to one row per key inside every task before the shuffle (window group
    limit), so a key with very many copies costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).filter("__rn = 1").drop("__rn")


def dedup_best(
    df: DataFrame, keys: Sequence[str | Column], preference: Column, order: Sequence[Column | str]
) -> DataFrame:
    """Row with the lowest preference number per key, ties by ``order``."""
    return dedup_first(df, keys, [preference, *order])


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def count_distinct(df: DataFrame, cols: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """Distinct combinations with a NULL counting as a value."""
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias(name))


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    # Each input is reduced before the shuffle by the partial aggregation of distinct.
    return union_all(*frames).distinct()


def top_count(df: DataFrame, measure: str, n: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the largest measure (a report feature, not a work limit)."""
    return df.orderBy(F.desc(measure), *tie_break).limit(n)
