"""Ordered computations over keys that may be too large for one task.

Each function takes an optional ``slice_by``: a column that never decreases along the
order, such as the month of the ordering timestamp. The window then runs inside
(key, slice), and what crosses slice borders comes from a small per-slice summary. The
rows are shuffled once, by (key, slice); the join with the summary uses the same layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import skew

_KEY, _SLICE = "__key", "__slice"
_PARTS = [_KEY, _SLICE]
LAYOUT = (_KEY, _SLICE)
_HELPERS = [_KEY, _SLICE, "__v", "__in", "__carry", "__before", "__next"]


def _sliced(df: DataFrame, keys: Sequence[str], slice_by: Column) -> DataFrame:
    # One struct column: NULL key fields compare as equal, and windows, groups and joins
    # all partition by the same expression. A frame that has it already keeps its layout.
    if _KEY in df.columns:
        return df
    return df.withColumns({_KEY: F.struct(*keys), _SLICE: slice_by})


def _over_slices() -> Window:
    return Window.partitionBy(_KEY).orderBy(_SLICE)


def _slices_before() -> Window:
    return _over_slices().rowsBetween(Window.unboundedPreceding, -1)


def count_over(df: DataFrame, keys: Sequence[str], name: str = "key_count") -> DataFrame:
    """``count(*) over (partition by keys)``, NULL keys forming a group; no task holds a whole group."""
    return skew.with_key_counts(df, keys, name)


def rank_rows(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    name: str = "row_num",
    slice_by: Column | None = None,
) -> DataFrame:
    """``row_number()`` of every row within its key."""
    if slice_by is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    sliced = _sliced(df, keys, slice_by)
    offsets = skew.key_counts(sliced, _PARTS, "__n").select(
        *_PARTS, F.coalesce(F.sum("__n").over(_slices_before()), F.lit(0)).alias("__before")
    )
    ranked = sliced.withColumn("__in", F.row_number().over(Window.partitionBy(*_PARTS).orderBy(*order)))
    joined = ranked.join(offsets, _PARTS)
    return joined.withColumn(name, (F.col("__in") + F.col("__before")).cast("bigint")).drop(*_HELPERS)


def previous_value(
    df: DataFrame, keys: Sequence[str], ts: str, value: Column, name: str, slice_by: Column | None = None
) -> DataFrame:
    """``lag(value)`` in ``ts`` order. (keys, ts) must be unique and ``value`` not NULL.

    A sliced result keeps the ``LAYOUT`` columns for a following step.
    """
    if slice_by is None:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(ts)))
    sliced = _sliced(df, keys, slice_by).withColumn("__v", value)
    edges = (
        sliced.groupBy(*_PARTS)
        .agg(F.max_by("__v", ts).alias("__last"))
        .select(*_PARTS, F.lag("__last").over(_over_slices()).alias("__carry"))
    )
    inner = sliced.withColumn("__in", F.lag("__v").over(Window.partitionBy(*_PARTS).orderBy(ts)))
    return inner.join(edges, _PARTS).withColumn(name, F.coalesce("__in", "__carry")).drop("__v", "__in", "__carry")


def number_intervals(
    df: DataFrame, keys: Sequence[str], ts: str, end: str, number: str, slice_by: Column | None = None
) -> DataFrame:
    """``end`` = the next ``ts`` of the key (NULL for the last) and the position ``number``."""
    if slice_by is None:
        w = Window.partitionBy(*keys).orderBy(ts)
        return df.withColumns({end: F.lead(ts).over(w), number: F.row_number().over(w).cast("bigint")})
    sliced = _sliced(df, keys, slice_by)
    summary = (
        sliced.groupBy(*_PARTS)
        .agg(F.count(F.lit(1)).alias("__n"), F.min(ts).alias("__first"))
        .select(
            *_PARTS,
            F.coalesce(F.sum("__n").over(_slices_before()), F.lit(0)).alias("__before"),
            F.lead("__first").over(_over_slices()).alias("__next"),
        )
    )
    w = Window.partitionBy(*_PARTS).orderBy(ts)
    inner = sliced.withColumns({"__in": F.row_number().over(w), "__v": F.lead(ts).over(w)})
    joined = inner.join(summary, _PARTS)
    position = (F.col("__in") + F.col("__before")).cast("bigint")
    return joined.withColumns({end: F.coalesce("__v", "__next"), number: position}).drop(*_HELPERS)
