"""Ordered passes over keys of any size: range partitions with values carried across.

``lay`` deals rows by ranges of (key, order), so a hot key lies in as many partitions as its
rows fill, and writes them bucketed by partition. Windows over (partition, key) then need no
shuffle. What a window cannot see, because the key began in an earlier partition or goes on
in a later one, is carried over: the partitions' last (or first) rows, one per partition,
are put in order and broadcast. The rows are shuffled once, whatever is computed over them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import bucketed

PART = "__part"


@dataclass(frozen=True)
class Laid:
    """A table in ranges of (keys, order); ``PART`` says in which of ``partitions`` a row lies."""

    table: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    partitions: int

    def inside(self) -> WindowSpec:
        """Window over the rows of a key in its partition."""
        return Window.partitionBy(PART, *self.keys).orderBy(*self.order)

    def _key(self) -> Column:
        return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)])

    def carry(
        self,
        df: DataFrame,
        rows: DataFrame,
        last: Mapping[str, str] = {},
        total: Mapping[str, str] = {},
        first: Mapping[str, str] = {},
    ) -> DataFrame:
        """``df`` with values that ``rows`` of the same key hold in other partitions, NULL where there are none.

        Each argument maps a column of ``rows`` to its name in the result. ``last``: the value
        in the last row in earlier partitions. ``total``: what the last row of a key says
        stands for all its rows in the partition, and the sum over earlier partitions is
        taken. ``first``: the value in the first row in later partitions.

        The last row before a partition has the key with which the partition begins, or that
        key did not occur before; the first row after it likewise.
        """
        key = self._key().alias("key")
        ends = []
        if last or total:
            ends.append(F.max(F.struct(key, *self.order, *[F.col(c).alias(n) for c, n in (last | total).items()])).alias("__tail"))
        if first:
            ends.append(F.min(F.struct(key, *self.order, *[F.col(c).alias(n) for c, n in first.items()])).alias("__head"))
        found = rows.groupBy(PART).agg(*ends)
        every = rows.sparkSession.range(0, self.partitions, 1, 1).select(F.col("id").cast("int").alias(PART))
        every = every.join(F.broadcast(found), PART, "left")  # a row per partition, all in one task
        step = Window.partitionBy(F.lit(0)).orderBy(PART)
        taken = [PART]
        if last or total:
            tail = F.col("__tail")
            sofar = Window.partitionBy("__tail.key").orderBy(PART).rowsBetween(Window.unboundedPreceding, 0)
            for name in total.values():
                tail = tail.withField(name, F.sum(f"__tail.{name}").over(sofar))
            earlier = step.rowsBetween(Window.unboundedPreceding, -1)
            every = every.withColumn("__tail", tail).withColumn("__before", F.last("__tail", True).over(earlier))
            taken.append("__before")
        if first:
            every = every.withColumn("__after", F.first("__head", True).over(step.rowsBetween(1, Window.unboundedFollowing)))
            taken.append("__after")
        joined = df.join(F.broadcast(every.select(*taken)), PART, "left")
        same = {side: self._key().eqNullSafe(F.col(f"{side}.key")) for side in taken[1:]}
        values = {n: F.when(same["__before"], F.col(f"__before.{n}")) for n in (last | total).values()}
        values |= {n: F.when(same["__after"], F.col(f"__after.{n}")) for n in first.values()}
        return joined.withColumns(values).drop(*taken[1:])


def lay(df: DataFrame, keys: Sequence[str], order: Sequence[str], spread: Sequence[str] = (), partitions: int | None = None) -> Laid:
    """``df`` in ranges of (keys, order, spread).

    ``spread``: columns that split rows equal in key and order. By default there are as many
    partitions as the session's shuffles have.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *keys, *order, *spread).withColumn(PART, F.spark_partition_id())
    return Laid(bucketed(ranges, PART, n, "ranges"), tuple(keys), tuple(order), n)
