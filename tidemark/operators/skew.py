"""Keeping hot groups out of single tasks.

A key can hold a third of all rows. Aggregations are safe (they combine before the
shuffle) and so is ``row_number() = 1`` (Spark keeps one row per key and task before
the shuffle). Rows that need a value of their whole key get it here: they are dealt by
(key, salt), so that a hot key lies in many tasks, and one exchange of the rows serves
both the counting and the join with its result. The plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Over so many tasks a key can spread.
SALTS = 64


def any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Rows per key; NULL counts as a key value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def struct_key(keys: Sequence[str | Column]) -> Column:
    """The key as one column: NULL fields compare as equal inside a struct."""
    return F.struct(*[(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(keys)])


def with_key_counts(
    df: DataFrame,
    keys: Sequence[str | Column],
    name: str = "n_rows",
    least: int = 1,
    totals: DataFrame | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Rows of ``df`` with the number of rows of their key, NULL being a key value.

    Rows of keys with fewer than ``least`` rows drop out. ``totals`` (``__key`` as by
    ``struct_key``, and the number) replaces the counts of ``df`` itself; a key that it
    lacks counts 0.
    """
    salt = F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.lit(salts)).cast("int")
    rows = df.withColumns({"__key": struct_key(keys), "__salt": salt}).repartition("__key", "__salt")
    parts = rows.groupBy("__key", "__salt").agg(F.count(F.lit(1)).alias("__n"))
    if totals is None:  # a key has at most as many parts as salts
        whole = parts.withColumn(name, F.sum("__n").over(Window.partitionBy("__key")))
    else:
        known = totals.select("__key", F.col(totals.columns[-1]).alias("__total"))
        whole = parts.join(known, "__key", "left").withColumn(name, F.coalesce("__total", F.lit(0).cast("bigint")))
    whole = whole.filter(F.col(name) >= least).select("__key", "__salt", name)
    return rows.join(whole, ["__key", "__salt"]).drop("__key", "__salt")


def spread_null_keys(keys: Sequence[str], cols: Sequence[str], parts: int = 256) -> Column:
    """Extra join key: 0 for complete keys, else a value that differs by row and task.

    Rows with a NULL key match nothing, but an outer join would send all of them to one
    task. The value depends only on the row and its input partition, so a repeated task
    gives the same rows.
    """
    spread = F.pmod(F.xxhash64(*cols) + F.spark_partition_id(), F.lit(parts)) + 1
    return F.when(any_null(keys), spread).otherwise(F.lit(0)).cast("int")
