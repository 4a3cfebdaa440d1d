"""Cube cells kept up to date by day: each load adds what it changed, and nothing else is read.

The finest cells hold sums and counts, which can be added and taken back. A load appends the
cells of its new rows less those of the rows that they replace; the cells are the sum of all
loads, folded from time to time (``changelog``). Coarser cuboids come from the cells, which
are few, not from the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.cube import Cube
from tidemark.streaming import changelog

# Rows of a cell; rows in which a measure is not NULL.
ROWS, KNOWN = "__rows", "__known_{}"


@dataclass(frozen=True)
class Cells:
    """Cells over ``levels`` below ``path``. Levels must not change for a stored row: use keys rather than names.

    ``schema`` is that of the rows. Sums of whole and decimal numbers are exact; those of
    floating ones may differ in the last digits from a full cube.
    """

    spark: SparkSession
    path: str
    levels: tuple[str, ...]
    measures: tuple[str, ...]
    schema: T.StructType

    def _aggregate(self, rows: DataFrame, removed: DataFrame) -> DataFrame:
        both = rows.withColumn("__sign", F.lit(1)).unionByName(removed.select(*rows.columns).withColumn("__sign", F.lit(-1)))
        sign = F.col("__sign")
        sums = [F.sum(F.when(sign == 1, F.col(m)).otherwise(-F.col(m))).alias(m) for m in self.measures]
        known = [F.sum(F.when(F.col(m).isNotNull(), sign).otherwise(0)).alias(KNOWN.format(m)) for m in self.measures]
        return both.groupBy(*self.levels).agg(F.sum(sign).alias(ROWS), *sums, *known)

    def _merged(self, parts: DataFrame) -> DataFrame:
        numbers = [ROWS, *self.measures, *[KNOWN.format(m) for m in self.measures]]
        types = self._schema()
        totals = [F.sum(c).cast(types[c].dataType).alias(c) for c in numbers]
        return parts.groupBy(*self.levels).agg(*totals, F.max(changelog.BATCH).alias(changelog.BATCH)).filter(f"{ROWS} <> 0")

    def _schema(self) -> T.StructType:
        empty = self.spark.createDataFrame([], self.schema)
        return self._aggregate(empty, empty).schema

    def add(self, load: int, rows: DataFrame, removed: DataFrame | None = None) -> None:
        """What load number ``load`` changed; a load that is repeated replaces itself."""
        none = rows.limit(0)
        delta = self._aggregate(rows, none if removed is None else removed)
        changelog.store_changes(self.path)(delta, load)

    def fold(self) -> int | None:
        """Put all loads so far together; run it while no reader is at work."""
        return changelog.fold(self.spark, self.path, self._schema(), self._merged)

    def cells(self) -> DataFrame:
        """The cells; a measure that is NULL in all rows of a cell is NULL."""
        merged = self._merged(changelog.changes(self.spark, self.path, self._schema()))
        shown = [F.when(F.col(KNOWN.format(m)) > 0, F.col(m)).alias(m) for m in self.measures]
        return merged.select(*self.levels, *shown, F.col(ROWS).alias("rows"))

    def cube(self, hierarchies=None) -> Cube:
        """A cube whose star is the cells: hypercube, rollup and ``cube_all`` run on it."""
        return Cube(self.cells(), hierarchies or {}, list(self.measures))


def cells_of(rows: DataFrame, path: str, levels: Sequence[str], measures: Sequence[str]) -> Cells:
    """Cells for rows like ``rows``; other columns play no part."""
    schema = rows.select(*levels, *measures).schema
    return Cells(rows.sparkSession, path, tuple(levels), tuple(measures), schema)
