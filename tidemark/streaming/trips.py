"""Trip streams: hourly flow, duplicates and late masters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import lookup
from tidemark.operators.dedup import dedup_first
from tidemark.session import materialize
from tidemark.sources.sinks import replace_partitions, write_replace

# Fixed value: lookback of the pulled sources, used as the lateness bound.
DELAY = "3 days"

# Event times need a time zone in Spark. Local times are moved through UTC by plain
# arithmetic, so the session time zone and its clock changes play no part.
_INSTANT, _LOCAL = "timestamp '1970-01-01 00:00:00Z'", "timestamp_ntz '1970-01-01 00:00:00'"


def as_instant(ts: str) -> Column:
    return F.expr(f"{_INSTANT} + ({ts} - {_LOCAL})")


def as_local(instant: str) -> Column:
    return F.expr(f"{_LOCAL} + ({instant} - {_INSTANT})")


def hourly_flow(trips: DataFrame, delay: str = DELAY, start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """Trips started and ended per city, station and tumbling hour.

    The watermark bounds the state; an hour is final ``delay`` after its end.
    """
    def leg(station: str, ts: str, started: int) -> Column:
        return F.struct(F.col(station).alias("source_station_id"), F.col(ts).alias("ts"), F.lit(started).alias("started"))

    both = F.array(leg("start_station_id", start, 1), leg("end_station_id", end, 0))
    legs = (
        trips.select("city_sk", F.explode(both).alias("leg"))
        .select("city_sk", "leg.*")
        .filter("source_station_id is not null and ts is not null")
    )
    counted = (
        legs.withColumn("ts", as_instant("ts"))
        .withWatermark("ts", delay)
        .groupBy("city_sk", "source_station_id", F.window("ts", "1 hour"))
        .agg(F.sum("started").alias("trips_started"), F.sum(1 - F.col("started")).alias("trips_ended"))
    )
    return counted.select(
        "city_sk",
        "source_station_id",
        as_local("window.start").alias("date_hour"),
        "trips_started",
        "trips_ended",
        (F.col("trips_ended") - F.col("trips_started")).alias("net_flow"),
    )


def dedup_stream(trips: DataFrame, keys: Sequence[str], ts: str, delay: str | None = DELAY) -> DataFrame:
    """First arrival of each key; keys are forgotten ``delay`` after their event time.

    Without ``delay`` no key is ever forgotten, so a repeat is dropped however late it comes.
    The keys are the whole state; start such a stream with ``state.on_rocksdb``, which keeps
    them on disk.
    """
    if delay is None:
        return trips.dropDuplicates(list(keys))
    timed = trips.withColumn("__event_time", as_instant(ts)).withWatermark("__event_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("__event_time")


def run_once(stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    """Process what is available and stop."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def store_by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to its own partition: a repeated batch replaces itself."""

    def store(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn("batch_id", F.lit(batch_id)), path, ["batch_id"])

    return store


def latest_by_key(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Last emitted row per key of an update-mode stream stored by batch."""
    return dedup_first(spark.read.parquet(path), keys, [F.desc("batch_id")]).drop("batch_id")


def backlog_store(
    out_path: str, resolve: Callable[[DataFrame], DataFrame], id_to_sk: dict, schema
) -> Callable[[DataFrame, int], None]:
    """Resolve each batch together with the waiting trips of the batch before.

    ``resolve`` reads the current master each time, so waiting trips are released by the
    first batch after their master arrived. Two snapshots of the backlog take turns: the
    one a batch reads stays until the batch after it, so a batch can be repeated.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        waiting = (
            spark.createDataFrame([], schema)
            if batch_id == 0
            else spark.read.schema(schema).parquet(f"{out_path}/backlog/snapshot={(batch_id - 1) % 2}")
        )
        offered = batch.unionByName(waiting)
        resolved = materialize(resolve(offered), "resolved")  # used twice below
        ready, pending = lookup.split_pending(resolved, id_to_sk)
        replace_partitions(ready.withColumn("batch_id", F.lit(batch_id)), f"{out_path}/ready", ["batch_id"])
        write_replace(pending.select(*batch.columns), f"{out_path}/backlog/snapshot={batch_id % 2}")

    return store
