"""Times the main loads on a replicated, skewed events table.

usage: scale_check.py <folder for the table> [copies] [query ...]
A third of all rows gets one user and one station; a sixth of all rows is one ride.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SOURCE = "/root/testdata/sf0.1"


def build(spark, folder: str, copies: int) -> None:
    events = spark.read.parquet(f"{SOURCE}/events.parquet").repartition(8)
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    many = events.select("*", copy)
    hot = F.col("event_id") % 3 == 0
    spread = many.select(
        F.when(hot & (F.col("copy") > 0) & (F.col("event_id") % 2 == 0), F.lit(6))
        .otherwise(F.col("event_id") + F.col("copy") * 100000)
        .alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("copy"))).alias("ts"),
        F.when(hot, F.lit(42)).otherwise(F.col("user_id")).cast("bigint").alias("user_id"),
        "event_type",
        "value",
        "props",
    )
    spread.write.parquet(f"{folder}/events.parquet")
    for name in ("customer", "supplier", "orders", "lineitem", "part", "nation", "region"):
        spark.read.parquet(f"{SOURCE}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")


def main() -> None:
    folder, copies = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 160
    spark = build_session("local[8]", 64, **{"spark.driver.memory": "20g"})
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.exists(f"{folder}/events.parquet"):
        build(spark, folder, copies)
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    names = sys.argv[3:] or ["dq_summary", "dq_details", "stage_trips", "late_pending", "up_upsert", "ag_flow"]
    for name in names:
        start = time.perf_counter()
        entry.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        print(f"{name} {rows} rows {took:.1f} s {rows / took:,.0f} rows/s", flush=True)


if __name__ == "__main__":
    main()
