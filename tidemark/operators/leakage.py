"""Temporal leakage checks and splits."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule codes and severities of the leakage report.
FUTURE, CROSSES, SPLIT_ORDER = (
    "FUTURE_RECORD_AFTER_ETL_CUTOFF",
    "TRIP_END_CROSSES_TRAIN_CUTOFF",
    "TEMPORAL_SPLIT_ORDER",
)


def _at(t: Column | datetime | str) -> Column:
    return t if isinstance(t, Column) else F.lit(str(t)).cast("timestamp_ntz")


def _report(rows: DataFrame, source: str, code: str, severity: str, hit: Column) -> DataFrame:
    counts = rows.agg(F.count(F.lit(1)).alias("checked_count"), F.count_if(hit).alias("leak_count"))
    return counts.select(
        F.lit(source).alias("source_name"),
        F.lit(code).alias("rule_code"),
        F.lit(severity).alias("severity"),
        "checked_count",
        "leak_count",
    )


def leak_future(df: DataFrame, ts: str, cutoff, source: str) -> DataFrame:
    """Rows newer than the extraction cutoff."""
    return _report(df, source, FUTURE, "reject", F.col(ts) > _at(cutoff))


def leak_crosses(df: DataFrame, start: str, end: str, train_end, source: str) -> DataFrame:
    """Rows that begin in the training period and end after it."""
    t = _at(train_end)
    return _report(df, source, CROSSES, "warning", (F.col(start) <= t) & (F.col(end) > t))


def leak_split_order(cutoffs: DataFrame, source: str = "mining_split") -> DataFrame:
    """train_end < valid_end < test_end, for each given triple."""
    ordered = (F.col("train_end") < F.col("valid_end")) & (F.col("valid_end") < F.col("test_end"))
    return _report(cutoffs, source, SPLIT_ORDER, "reject", ~F.coalesce(ordered, F.lit(False)))


def leak_status(report: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("leak_count") == 0, "PASS").when(F.col("severity") == "warning", "WARNING").otherwise("FAIL")
    )
    return report.withColumn("status", status)


def temporal_split(df: DataFrame, start: str, end: str, cutoffs: Mapping[str, datetime]) -> DataFrame:
    """Name the first split whose cutoff the row starts before, and drop rows that end
    after it. ``cutoffs`` is ordered in time; rows after the last cutoff drop out."""
    split, limit = None, None
    for name, t in cutoffs.items():
        cond = F.col(start) <= _at(t)
        split = F.when(cond, name) if split is None else split.when(cond, name)
        limit = F.when(cond, _at(t)) if limit is None else limit.when(cond, _at(t))
    tagged = df.withColumns({"split": split, "__limit": limit}).filter("split is not null")
    return tagged.filter(F.col(end).isNull() | (F.col(end) <= F.col("__limit"))).drop("__limit")
