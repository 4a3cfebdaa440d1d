"""Load counts, candidate counts, job log and freshness."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.context import RunContext


def load_counts(
    raw: DataFrame | int, staged: DataFrame, source_name: str, table_name: str, raw_cond=None, staged_cond=None
) -> DataFrame:
    """Raw rows of the window, or their number, against staged rows. FAILED only if nothing arrived."""
    true = F.lit(True)
    if isinstance(raw, int):  # counted already
        a = staged.sparkSession.range(1).select(F.lit(raw).cast("bigint").alias("total_rows_count"))
    else:
        a = raw.agg(F.count_if(true if raw_cond is None else raw_cond).alias("total_rows_count"))
    b = staged.agg(F.count_if(true if staged_cond is None else staged_cond).alias("success_rows_count"))
    both = a.crossJoin(b)  # one row each
    failed = F.greatest(F.col("total_rows_count") - F.col("success_rows_count"), F.lit(0).cast("bigint"))
    nothing = (F.col("total_rows_count") > 0) & (F.col("success_rows_count") == 0)
    return both.select(
        F.lit(source_name).alias("source_name"),
        F.lit(table_name).alias("table_name"),
        "total_rows_count",
        "success_rows_count",
        failed.alias("failed_rows_count"),
        F.when(nothing, "FAILED").otherwise("SUCCESS").alias("status"),
    )


def candidate_counts(parts: Mapping[str, DataFrame], pending: DataFrame) -> DataFrame:
    """Candidate rows of a layer load by part, their total, and total minus pending.

    Each part is a frame whose rows are the candidates (already distinct).
    """
    total = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias(name))
        total = one if total is None else total.crossJoin(one)  # one row each
    total = total.crossJoin(pending.agg(F.count(F.lit(1)).alias("pending_rows")))
    whole = sum((F.col(n) for n in parts), F.lit(0).cast("bigint"))
    return total.withColumns(
        {"total_rows_count": whole, "success_rows_count": whole - F.col("pending_rows")}
    )


def job_log(
    counts: DataFrame, ctx: RunContext, job_name: str, status: Column | str | None = None, finished_at=None
) -> DataFrame:
    """Log rows for a frame with source_name and total/success/failed counts."""
    made = F.lit(status) if isinstance(status, str) else (F.col("status") if status is None else status)
    return counts.select(
        F.lit(ctx.load_run_id).alias("load_run_id"),
        F.lit(job_name).alias("job_name"),
        "source_name",
        F.lit(str(ctx.started_at)).cast("timestamp_ntz").alias("started_at"),
        (F.lit(str(finished_at)) if finished_at else F.localtimestamp()).cast("timestamp_ntz").alias("finished_at"),
        made.alias("status"),
        "total_rows_count",
        "success_rows_count",
        "failed_rows_count",
    )


def total_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of several tables in one result."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def sum_counts(counts: DataFrame) -> DataFrame:
    """Totals over all sources, without a key."""
    return counts.agg(*[F.sum(c).alias(c) for c in ("total_rows_count", "success_rows_count", "failed_rows_count")])


def freshness(control: DataFrame) -> DataFrame:
    """Last successful extraction per source, for report headers."""
    return control.filter("status = 'SUCCESS'").groupBy("source_name").agg(F.max("cet").alias("last_success"))
