"""Master change events: validated against the master, applied to staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions import clean
from tidemark.operators.lookup import lookup, lookup_current
from tidemark.operators.upsert import upsert
from tidemark.plans.bike import station_push_checks
from tidemark.streaming import changelog
from tidemark.streaming.state import on_rocksdb
from tidemark.streaming.trips import store_by_batch

EVENT_SCHEMA = (
    "operation string, sent_at string, data struct<source_city_code: string, gbfs_station_id: string, "
    "short_name: string, station_name: string, latitude: double, longitude: double, capacity: int, "
    "station_type: string, region_id: string, station_status: string>"
)
KEY = ["source_city_code", "short_name"]
STAGING_COLUMNS = [
    "source_city_code",
    "short_name",
    "gbfs_station_id",
    "station_name",
    "latitude",
    "longitude",
    "capacity",
    "station_type",
    "region_id",
    "station_status",
    "operation",
    "sent_at",
]


def flatten(events: DataFrame) -> DataFrame:
    return events.select(F.upper("operation").alias("operation"), "sent_at", "data.*")


def judge_events(events: DataFrame, station: DataFrame, city: DataFrame) -> DataFrame:
    """Each event with http_status, message and the operation that really applies.

    INSERT and UPDATE follow the existence in the master; deleting an unknown station is
    answered with 404.
    """
    known = lookup(events, city, {"source_city_code": "city_code"}, ["city_sk"])
    found = lookup_current(
        known, station, {"city_sk": "city_sk", "short_name": "source_station_id"}, {"station_sk": "__station_sk"}
    )
    error = clean.first_error(station_push_checks())
    exists = F.col("__station_sk").isNotNull()
    lost = (F.col("operation") == "DELETE") & ~exists
    status = F.when(F.col("__error").isNotNull(), 400).when(lost, 404).otherwise(200)
    message = F.coalesce(F.col("__error"), F.when(lost, "Station not found in NDS"), F.lit("ACCEPTED"))
    real: Column = F.when(F.col("operation") == "DELETE", "DELETE").when(exists, "UPDATE").otherwise("INSERT")
    return (
        found.withColumn("__error", error)
        .withColumns({"http_status": status, "message": message})
        .withColumn("operation", F.when(F.col("http_status") == 200, real).otherwise(F.col("operation")))
        .withColumn("station_status", F.coalesce(clean.blank_to_null("station_status"), F.lit("open")))
        .drop("__error", "__station_sk", "city_sk")
    )


def last_accepted(judged: DataFrame) -> DataFrame:
    """The latest accepted event per station, ties by operation and name; the same for a stream."""
    body = [c for c in STAGING_COLUMNS if c not in (*KEY, "sent_at", "operation", "station_name")]
    accepted = judged.filter("http_status = 200")
    last = accepted.groupBy(*KEY).agg(F.max(F.struct("sent_at", "operation", "station_name", *body)).alias("last"))
    return last.select(*KEY, "last.*").select(*STAGING_COLUMNS)


def apply_change_events(
    events: DataFrame, station: DataFrame, city: DataFrame, staging: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(new staging snapshot, one response per event); the same function for a batch."""
    judged = judge_events(events, station, city)
    return upsert(staging, last_accepted(judged), KEY), responses_of(judged)


def responses_of(judged: DataFrame) -> DataFrame:
    return judged.select(*KEY, "operation", "sent_at", "http_status", "message")


def change_stream(
    spark: SparkSession, in_path: str, out_path: str, checkpoint: str, station: DataFrame, city: DataFrame, once: bool = True
) -> tuple[StreamingQuery, StreamingQuery]:
    """File stream of JSON events into ``<out>/staging`` and ``<out>/responses``, a query for each.

    The last accepted event of each station is held as state: an event that arrives late
    does not replace a later one, and a batch reads nothing but its events and their
    stations' state. The stations that it moves are appended to a change table.
    """
    judged = judge_events(flatten(spark.readStream.schema(EVENT_SCHEMA).json(in_path)), station, city)
    staging = last_accepted(judged).writeStream.outputMode("update").foreachBatch(changelog.store_changes(f"{out_path}/staging"))
    answers = responses_of(judged).writeStream.foreachBatch(store_by_batch(f"{out_path}/responses"))
    return (
        on_rocksdb(staging.option("checkpointLocation", f"{checkpoint}/staging"), once),
        on_rocksdb(answers.option("checkpointLocation", f"{checkpoint}/responses"), once),
    )


def _staging_schema(spark: SparkSession) -> StructType:
    events = flatten(spark.createDataFrame([], EVENT_SCHEMA)).withColumn("http_status", F.lit(200))
    return last_accepted(events).schema


def latest_staging(spark: SparkSession, out_path: str) -> DataFrame:
    """The last accepted event of each station."""
    return changelog.latest(spark, f"{out_path}/staging", KEY, _staging_schema(spark))


def compact_staging(spark: SparkSession, out_path: str) -> int | None:
    """Folds the changes of the stations; run it while no reader is at work."""
    return changelog.compact(spark, f"{out_path}/staging", KEY, _staging_schema(spark))
