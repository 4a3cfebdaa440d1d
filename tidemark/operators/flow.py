"""Station-hour balance: the periodic snapshot fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import measures

GRAIN = ["city_sk", "source_station_id", "date_hour"]
MISSING_WEATHER = ("zero", "unknown")


def trip_legs(trips: DataFrame, extra: Sequence[Column | str] = ()) -> DataFrame:
    """A start leg and an end leg per trip, those with a resolved station only, with the ``extra`` columns.

    ``trips`` holds city_sk, start/end_station_id, start/end_station_sk, started_at,
    ended_at, member_casual, rideable_type and duration_minutes.
    """
    start = F.struct(
        F.col("start_station_id").alias("source_station_id"),
        measures.hour_of("started_at").alias("date_hour"),
        F.lit(True).alias("is_start"),
        F.col("start_station_sk").isNotNull().alias("counts"),
    )
    end = F.struct(
        F.col("end_station_id").alias("source_station_id"),
        measures.hour_of("ended_at").alias("date_hour"),
        F.lit(False).alias("is_start"),
        (F.col("end_station_sk").isNotNull() & F.col("ended_at").isNotNull()).alias("counts"),
    )
    legs = trips.select(
        "city_sk", "member_casual", "rideable_type", "duration_minutes", F.explode(F.array(start, end)).alias("leg"), *extra
    ).filter("leg.counts")
    return legs.select(
        "city_sk",
        "leg.source_station_id",
        "leg.date_hour",
        "leg.is_start",
        "member_casual",
        "rideable_type",
        "duration_minutes",
        *[c for c in legs.columns if c not in ("city_sk", "member_casual", "rideable_type", "duration_minutes", "leg")],
    )


def balance_legs(legs: DataFrame) -> DataFrame:
    """Flow measures per grain from legs: one shuffle, combined before it."""
    is_start = F.col("is_start")

    def started(cond):
        return F.count_if(is_start & cond)

    member, casual = F.col("member_casual") == "member", F.col("member_casual") == "casual"
    electric, classic = F.col("rideable_type") == "electric_bike", F.col("rideable_type") == "classic_bike"
    minutes = F.col("duration_minutes").cast("decimal(10,2)")
    sums = legs.groupBy(*GRAIN).agg(
        F.count_if(is_start).alias("trips_started"),
        F.count_if(~is_start).alias("trips_ended"),
        started(member).alias("member_trip_count"),
        started(casual).alias("casual_trip_count"),
        started(electric).alias("electric_trip_count"),
        started(classic).alias("classic_trip_count"),
        F.sum(F.when(is_start & member, minutes)).alias("__member_minutes"),
        F.sum(F.when(is_start & casual, minutes)).alias("__casual_minutes"),
    )
    return balance_sums(sums)


def balance_sums(sums: DataFrame) -> DataFrame:
    """Flow measures from the sums of each grain."""
    net = F.col("trips_ended") - F.col("trips_started")

    def average(total: str, count: str):
        n = F.nullif(F.col(count), F.lit(0)).cast("decimal(19,0)")
        return F.round(F.col(total) / n, 2).cast("decimal(10,2)")

    return sums.select(
        *GRAIN,
        "trips_started",
        "trips_ended",
        net.alias("net_flow"),
        F.abs(net).alias("abs_imbalance"),
        "member_trip_count",
        "casual_trip_count",
        "electric_trip_count",
        "classic_trip_count",
        average("__member_minutes", "member_trip_count").alias("avg_duration_member_minutes"),
        average("__casual_minutes", "casual_trip_count").alias("avg_duration_casual_minutes"),
    )


def station_hour_balance(trips: DataFrame) -> DataFrame:
    return balance_legs(trip_legs(trips))


def add_weather(balance: DataFrame, weather: DataFrame, missing: str = "zero") -> DataFrame:
    """Weather of the city and hour. A missing hour reads as 0 and ``Clear``, or stays
    NULL and ``Unknown`` with ``missing="unknown"``."""
    if missing not in MISSING_WEATHER:
        raise ValueError(f"missing must be one of {MISSING_WEATHER}")
    w = weather.select(
        "city_sk",
        F.col("observation_hour").alias("date_hour"),
        F.col("temperature_c").alias("temperature"),
        F.col("precipitation_mm").alias("precipitation"),
        F.col("wind_speed_ms").alias("wind_speed"),
        "weather_category",
    )
    joined = balance.join(w, ["city_sk", "date_hour"], "left")
    if missing == "unknown":
        return joined.withColumn("weather_category", F.coalesce("weather_category", F.lit("Unknown")))
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(w.schema[c].dataType)) for c in
            ("temperature", "precipitation", "wind_speed")}
    return joined.withColumns({**zero, "weather_category": F.coalesce("weather_category", F.lit("Clear"))})
