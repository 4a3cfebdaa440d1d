"""The station-hour fact kept up to date from a stream of ride versions, on keyed state.

Two queries, both with their state in RocksDB:

* ``ride_changes`` holds the last version of each ride, an entry of its bucket's map. A version that replaces another one
  gives the legs it adds and, negated, those it takes back, so the hours that a ride leaves
  are corrected too. Its output is an exactly-once file sink.
* ``fact_changes`` holds the sums of each station-hour, adds those legs to them, and appends
  the hours that moved to a change table (``changelog``).

A micro-batch reads its own rows and the state of their keys, never stored rides or facts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.functions import measures
from tidemark.operators import flow
from tidemark.streaming import changelog
from tidemark.streaming.state import on_rocksdb

# Executors get the processor itself and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RIDE = ["city_sk", "ride_id"]
# Fixed by a checkpoint: rides are handled by bucket, a call of the processor each.
BUCKETS = 1 << 14
_EPOCH = "timestamp_ntz '1970-01-01 00:00:00'"

# A version, as far as the fact depends on it. Hours count from 1970; a leg that does not
# count has no station; minutes are hundredths.
_VERSION = (
    "version long, start_station string, start_hour long, end_station string, end_hour long,"
    " member_casual string, rideable_type string, minutes long"
)
MEASURES = [
    "trips_started", "trips_ended", "member_trip_count", "casual_trip_count", "electric_trip_count",
    "classic_trip_count", "member_minutes", "casual_minutes", "member_timed", "casual_timed",
]


def legs_of(version: Sequence) -> Iterator[tuple[tuple, list[int]]]:
    """((station, hour), measures) of the legs of a version."""
    _, start, start_hour, end, end_hour, rider, bike, minutes = version
    if start is not None:
        member, casual = int(rider == "member"), int(rider == "casual")
        timed = int(minutes is not None)
        values = [1, 0, member, casual, int(bike == "electric_bike"), int(bike == "classic_bike")]
        yield (start, start_hour), [*values, member * (minutes or 0), casual * (minutes or 0), member * timed, casual * timed]
    if end is not None:
        yield (end, end_hour), [0, 1, *[0] * 8]


class RideVersions(StatefulProcessor):
    """Last version of each ride of a bucket; a row per station-hour whose measures new versions move.

    The versions are the entries of a map, so only those of rides that occur are read, and a
    ride costs a call for its entry, not several for a state of its own.
    """

    def __init__(self, ride_schema: str):
        self.ride_schema = ride_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last_of_ride", self.ride_schema, _VERSION)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # The greatest version holds; in a batch ties go to the least hash, over batches to the later one.
        best: dict[tuple, tuple] = {}
        for r in rows:
            ride, rank = (r.city_sk, r.ride_id), (r.version is not None, r.version or 0, -r.tie)
            if ride not in best or rank > best[ride][0]:
                best[ride] = rank, (
                    r.version, r.start_station, r.start_hour, r.end_station, r.end_hour,
                    r.member_casual, r.rideable_type, r.minutes,
                )
        seen = self.last.exists()  # of any ride of the bucket
        moved: dict[tuple, list[int]] = {}
        for ride, (_, new) in best.items():
            found = self.last.getValue(ride) if seen else None
            old = None if found is None else tuple(found)
            if old == new or old is not None and old[0] is not None and (new[0] is None or new[0] < old[0]):
                continue
            self.last.updateValue(ride, new)
            for sign, version in ((1, new), (-1, old)):
                for (station, hour), values in legs_of(version) if version is not None else ():
                    sums = moved.setdefault((ride[0], station, hour), [0] * len(values))
                    for i, v in enumerate(values):
                        sums[i] += sign * v
        for (city, station, hour), sums in moved.items():
            if any(sums):
                yield Row(city_sk=city, source_station_id=station, hour=hour, **dict(zip(MEASURES, sums)))

    def close(self) -> None:
        pass


def _hours(ts: str) -> Column:
    return F.expr(f"timestampdiff(HOUR, {_EPOCH}, {ts})")


def _versions(trips: DataFrame, version: str) -> DataFrame:
    """The columns that the processor needs; the ``version`` column may be a time or a whole number."""
    number = F.col(version)
    if isinstance(trips.schema[version].dataType, (T.TimestampNTZType, T.TimestampType)):
        number = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, cast({version} as timestamp_ntz))")
    starts = F.col("start_station_sk").isNotNull()
    ends = F.col("end_station_sk").isNotNull() & F.col("ended_at").isNotNull()
    hours = trips.withColumns({"__tie": F.xxhash64(*trips.columns), "__s": measures.hour_of("started_at"), "__e": measures.hour_of("ended_at")})
    return hours.select(
        F.pmod(F.xxhash64(*RIDE), F.lit(BUCKETS)).cast("int").alias("bucket"),
        *RIDE,
        number.cast("long").alias("version"),
        F.col("__tie").alias("tie"),
        F.when(starts, F.col("start_station_id")).alias("start_station"),
        _hours("__s").alias("start_hour"),
        F.when(ends, F.col("end_station_id")).alias("end_station"),
        _hours("__e").alias("end_hour"),
        "member_casual",
        "rideable_type",
        (F.col("duration_minutes").cast("decimal(10,2)") * 100).cast("long").alias("minutes"),
    )


def _legs_schema(trips: DataFrame) -> T.StructType:
    out = T.StructType().add("city_sk", trips.schema["city_sk"].dataType).add("source_station_id", "string").add("hour", "long")
    for name in MEASURES:
        out = out.add(name, "long")
    return out


def ride_changes(trips: DataFrame, root: str, version: str = "loaded_at", once: bool = True, retention: str = "30d") -> StreamingQuery:
    """Stream of trips to moved legs below ``root``. Ride keys must not be NULL.

    The version with the greatest ``version`` holds; NULL is the least. ``retention``: legs
    older than that leave the sink's log; the fact query must have read them by then.
    """
    changed = _versions(trips, version).groupBy("bucket")
    ride_schema = ", ".join(f"{c} {trips.schema[c].dataType.simpleString()}" for c in RIDE)
    moved = changed.transformWithState(RideVersions(ride_schema), _legs_schema(trips), "Append", "None")
    writer = moved.writeStream.format("parquet").option("path", f"{root}/legs").option("retention", retention)
    return on_rocksdb(writer.option("checkpointLocation", f"{root}/checkpoint-rides"), once)


def fact_changes(spark: SparkSession, root: str, legs: T.StructType, once: bool = True) -> StreamingQuery:
    """Stream of moved legs to the station-hours that changed, a change table at ``root/fact``."""
    sums = spark.readStream.schema(legs).parquet(f"{root}/legs").groupBy("city_sk", "source_station_id", "hour")
    totals = sums.agg(*[F.sum(m).alias(m) for m in MEASURES])
    store = changelog.store_changes(f"{root}/fact")

    def rows(batch: DataFrame, batch_id: int) -> None:
        store(_fact_rows(batch), batch_id)

    writer = totals.writeStream.outputMode("update").foreachBatch(rows)
    return on_rocksdb(writer.option("checkpointLocation", f"{root}/checkpoint-fact"), once)


def _fact_rows(totals: DataFrame) -> DataFrame:
    def minutes(who: str) -> Column:
        total = (F.col(f"{who}_minutes").cast("decimal(18,0)") / 100).cast("decimal(20,2)")
        return F.when(F.col(f"{who}_timed") > 0, total).alias(f"__{who}_minutes")

    counts = [m for m in MEASURES if m.endswith(("started", "ended", "count"))]
    hour = F.expr(f"timestampadd(HOUR, hour, {_EPOCH})").alias("date_hour")
    return flow.balance_sums(totals.select("city_sk", "source_station_id", hour, *counts, minutes("member"), minutes("casual")))


def refresh(trips: DataFrame, root: str, version: str = "loaded_at") -> None:
    """Both queries over what is available."""
    ride_changes(trips, root, version).awaitTermination()
    fact_changes(trips.sparkSession, root, _legs_schema(trips)).awaitTermination()


def _fact_schema(spark: SparkSession, legs: T.StructType) -> T.StructType:
    return _fact_rows(spark.createDataFrame([], legs)).schema


def fact(spark: SparkSession, root: str, trips: DataFrame) -> DataFrame:
    """The station-hours with legs, as the stream left them. ``trips`` gives the type of the city key."""
    schema = _fact_schema(spark, _legs_schema(trips))
    return changelog.latest(spark, f"{root}/fact", flow.GRAIN, schema).filter("trips_started > 0 or trips_ended > 0")


def compact_fact(spark: SparkSession, root: str, trips: DataFrame) -> int | None:
    """Folds the changes of the fact; run it while no reader is at work."""
    return changelog.compact(spark, f"{root}/fact", flow.GRAIN, _fact_schema(spark, _legs_schema(trips)))
