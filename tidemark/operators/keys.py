"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 16 to this power buckets: the bound of the offset table. More for more than some 10^9 new rows at once.
BUCKET_DIGITS = 3


def key_bucket(natural_keys: Sequence[str], digits: int = BUCKET_DIGITS) -> Column:
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in natural_keys])
    return F.substring(F.md5(text), 1, digits)


def allocate_keys(
    new_rows: DataFrame, target: DataFrame, sk: str, natural_keys: Sequence[str], digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Dense keys after the largest one in ``target``, ordered by (bucket, natural key).

    Rows are numbered inside hash buckets in parallel; the running total of the at most
    16^``digits`` bucket sizes gives each bucket its offset. Nothing is numbered globally.
    """
    bucketed = new_rows.withColumn("__b", key_bucket(natural_keys, digits))
    sizes = bucketed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    start = target.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint").alias("__max"))
    offsets = offsets.crossJoin(start)  # one row
    numbered = bucketed.withColumn("__rn", F.row_number().over(Window.partitionBy("__b").orderBy(*natural_keys)))
    joined = numbered.join(offsets, "__b")
    return joined.select(
        (F.col("__max") + F.col("__before") + F.col("__rn")).cast("bigint").alias(sk), *new_rows.columns
    )


def hash_key(natural_keys: Sequence[str]) -> Column:
    """64-bit key straight from the natural key: no order, no shuffle, stable over runs."""
    return F.xxhash64(*natural_keys)
