"""Reconciliation between layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile_totals(left: DataFrame, right: DataFrame, measures: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row per measure: both totals, the difference and OK or LEAK."""
    names = list(measures)
    zero = F.lit(0)
    a = left.agg(*[F.coalesce(measures[m][0], zero).alias(f"l_{m}") for m in names])
    b = right.agg(*[F.coalesce(measures[m][1], zero).alias(f"r_{m}") for m in names])
    both = a.crossJoin(b)  # one row each
    rows = [
        F.struct(
            F.lit(m).alias("measure"),
            F.col(f"l_{m}").cast("bigint").alias("left_total"),
            F.col(f"r_{m}").cast("bigint").alias("right_total"),
        )
        for m in names
    ]
    out = both.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    diff = F.abs(F.col("left_total") - F.col("right_total"))
    return out.withColumns({"difference": diff, "status": F.when(diff == 0, "OK").otherwise("LEAK")})


def leaking(report: DataFrame, *cols: str) -> DataFrame:
    """Rows with a discrepancy above zero in any of ``cols``."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.col(c) > 0)
    return report.filter(cond)


def missing_rows(expected: DataFrame, fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected grains without a fact row."""
    return expected.select(*keys).distinct().join(fact.select(*keys), list(keys), "left_anti")


def reconcile_cube(cube: DataFrame, base: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Cells where the cube and an independent aggregation of the base disagree."""
    direct = base.groupBy(*keys).agg(*[F.sum(m).alias(f"b_{m}") for m in measures])
    c = cube.select(*keys, *[F.col(m).alias(f"c_{m}") for m in measures])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"c.{k}").eqNullSafe(F.col(f"b.{k}"))
    joined = c.alias("c").join(direct.alias("b"), cond, "full")
    bad = F.lit(False)
    for m in measures:
        bad = bad | ~F.col(f"c_{m}").eqNullSafe(F.col(f"b_{m}"))
    return joined.filter(bad).select(
        *[F.coalesce(F.col(f"c.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
        *[F.col(f"{p}_{m}") for m in measures for p in ("c", "b")],
    )
