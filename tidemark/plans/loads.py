"""Layer loads: staging -> normalised layer -> star. Each returns a new snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.functions import measures
from tidemark.operators import dims, flow, incremental, lookup, scd
from tidemark.operators.dedup import dedup_best, dedup_first, union_all
from tidemark.operators.keys import allocate_keys
from tidemark.operators.upsert import delete_matching, upsert, upsert_actions

TRIP_KEY = ["city_sk", "ride_id"]
STATION_KEY = ["city_sk", "source_station_id"]
TRACKED = ["station_name", "latitude", "longitude", "capacity", "station_status"]
TRIP_COLUMNS = [
    "city_sk",
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_id",
    "end_station_id",
    "start_station_sk",
    "end_station_sk",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
    "duration_minutes",
    "trip_month",
    "loaded_at",
    "updated_at",
]


def _now(ctx: RunContext):
    return F.lit(str(ctx.cet)).cast("timestamp_ntz")


def load_city(city: DataFrame, sources: Sequence[DataFrame]) -> DataFrame:
    """Upsert the observed known cities; new ones get the next key."""
    seen = dims.observed_codes(sources, "source_city_code", dims.CITIES, dims.CITY_ATTRIBUTES, "city_code")
    new = seen.join(city.select("city_code"), "city_code", "left_anti")
    keyed = city.unionByName(allocate_keys(new, city, "city_sk", ["city_code"]).select(*city.columns))
    return upsert(keyed, seen, ["city_code"])


def load_calendar(calendar: DataFrame, frames) -> DataFrame:
    return upsert(calendar, dims.calendar(frames), ["calendar_date"])


def load_stations(station: DataFrame, staged: DataFrame, city: DataFrame, ctx: RunContext) -> DataFrame:
    """Apply staged station operations; rows of unknown cities are skipped."""
    attrs = [*TRACKED]
    ops = lookup.lookup(staged, city, {"source_city_code": "city_code"}, ["city_sk"])
    ops = lookup.keep_resolved(ops, "city_sk").filter("short_name is not null").select(
        "city_sk",
        F.col("short_name").alias("source_station_id"),
        "station_name",
        "latitude",
        "longitude",
        "capacity",
        F.coalesce("station_status", F.lit("open")).alias("station_status"),
        F.upper(F.coalesce(F.nullif(F.trim("operation"), F.lit("")), F.lit("UPDATE"))).alias("operation"),
        _now(ctx).alias("now"),
    )
    versions = scd.apply_operations(station, ops, STATION_KEY, attrs, "now")
    version_key = [*STATION_KEY, "effective_from"]
    kept = lookup.lookup(versions, station, version_key, ["station_sk", "loaded_at"])
    touched = ops.select(*STATION_KEY, F.lit(True).alias("__touched"))
    kept = kept.join(touched, STATION_KEY, "left")
    in_run = F.col("__touched").isNotNull() & (F.col("is_current") | (F.col("effective_to") == _now(ctx)))
    stamped = kept.withColumn("loaded_at", F.when(in_run, _now(ctx)).otherwise(F.col("loaded_at"))).drop("__touched")
    old = stamped.filter("station_sk is not null").select(*station.columns)
    new = stamped.filter("station_sk is null").drop("station_sk")
    return old.unionByName(allocate_keys(new, station, "station_sk", version_key).select(*station.columns))


def load_weather(weather: DataFrame, staged: DataFrame, city: DataFrame, ctx: RunContext) -> DataFrame:
    """Best report per city and hour, with its category, upserted by (city, hour)."""
    hours = staged.filter("observation_ts is not null").withColumn("observation_hour", measures.hour_of("observation_ts"))
    best = dedup_best(
        hours, ["source_city_code", "observation_hour"], measures.report_rank("report_type"), ["observation_ts"]
    )
    rows = lookup.keep_resolved(
        lookup.lookup(best, city, {"source_city_code": "city_code"}, ["city_sk"]), "city_sk"
    ).select(
        "city_sk",
        "observation_hour",
        "report_type",
        F.col("hourly_dry_bulb_temperature").alias("temperature_c"),
        F.col("hourly_precipitation").alias("precipitation_mm"),
        F.col("hourly_wind_speed").alias("wind_speed_ms"),
        F.col("hourly_present_weather_type").alias("present_weather"),
        measures.weather_category("hourly_present_weather_type", "hourly_precipitation").alias("weather_category"),
        _now(ctx).alias("loaded_at"),
    )
    return upsert(weather, rows, ["city_sk", "observation_hour"])


def resolve_trips(staged: Sequence[DataFrame], city: DataFrame, station: DataFrame, ctx: RunContext) -> DataFrame:
    """Union, one row per (city, ride), duration, city and station keys."""
    rows = union_all(*staged).filter("ride_id is not null and started_at is not null and source_city_code is not null")
    first = dedup_first(rows, ["source_city_code", "ride_id"], ["source_file", "loaded_at"])
    timed = first.withColumn("duration_minutes", measures.duration_minutes("started_at", "ended_at"))
    out = lookup.keep_resolved(
        lookup.lookup(timed, city, {"source_city_code": "city_code"}, ["city_sk"]), "city_sk"
    )
    best = lookup.best_version(station, STATION_KEY, ["station_sk"])
    for end in ("start", "end"):
        keys = {"city_sk": "city_sk", f"{end}_station_id": "source_station_id"}
        out = lookup.lookup(out, best, keys, {"station_sk": f"{end}_station_sk"})
    return out.withColumns({"loaded_at": _now(ctx), "updated_at": _now(ctx)})


ID_TO_SK = {"start_station_id": "start_station_sk", "end_station_id": "end_station_sk"}


def load_trips(trip: DataFrame, resolved: DataFrame, ctx: RunContext) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, backlog). ``loaded_at`` keeps the first load time; ``updated_at``
    moves with every change, so that changed trips enter the next fact window."""
    ready, backlog = lookup.split_pending(resolved, ID_TO_SK)
    business = [c for c in TRIP_COLUMNS if c not in (*TRIP_KEY, "loaded_at", "updated_at")]
    source = ready.select(*TRIP_COLUMNS)
    acts = upsert_actions(trip, source, TRIP_KEY, business, ["loaded_at", "updated_at"], null_keys=False)
    stamp = F.when(F.col("action") == "update", _now(ctx)).otherwise(F.col("updated_at"))
    moved = acts.withColumn("updated_at", stamp)
    return moved.select(*trip.columns), backlog


def reresolve(trip: DataFrame, station: DataFrame, ctx: RunContext) -> tuple[DataFrame, DataFrame]:
    """(trips whose missing station keys are now known, the grains they touch)."""
    open_trips = trip.filter(
        "(start_station_sk is null and start_station_id is not null)"
        " or (end_station_sk is null and end_station_id is not null)"
    )
    best = lookup.best_version(station, STATION_KEY, ["station_sk"])
    out = open_trips
    for end in ("start", "end"):
        keys = {"city_sk": "city_sk", f"{end}_station_id": "source_station_id"}
        out = lookup.lookup(out, best, keys, {"station_sk": f"__{end}"})
    changed = out.filter(
        "(start_station_sk is null and __start is not null) or (end_station_sk is null and __end is not null)"
    )
    updates = changed.withColumns(
        {
            "start_station_sk": F.coalesce("start_station_sk", "__start"),
            "end_station_sk": F.coalesce("end_station_sk", "__end"),
            "updated_at": _now(ctx),
        }
    ).select(*trip.columns)
    return updates, incremental.affected_grains(updates)


def cleanup_staged(staged: DataFrame, trip: DataFrame, city: DataFrame) -> DataFrame:
    """Staged trips that did not reach the normalised layer; these stay staged."""
    keyed = lookup.lookup(staged, city, {"source_city_code": "city_code"}, ["city_sk"])
    return delete_matching(keyed, trip, TRIP_KEY).select(*staged.columns)


def load_dim_station(dim: DataFrame, station: DataFrame, lset, cet, first_from: str | None = scd.FIRST_FROM):
    """Versions of the stations that changed in the window, and soft closes."""
    recent = incremental.incremental(station, "loaded_at", lset, cet)
    active = recent.filter("is_current and row_status = 'active'")
    changes = active.withColumn("__ts", F.greatest("effective_from", "loaded_at"))
    core = ["city_sk", "source_station_id", *TRACKED, "effective_from", "effective_to", "is_current", "version"]
    dim_cols = dim.select(*core, "station_sk")
    versions = scd.scd2_apply(dim_cols, changes, STATION_KEY, TRACKED, "__ts", first_from, ["station_sk"])
    gone = scd.deleted_only(station, STATION_KEY)
    closed = scd.scd2_close(versions, gone, STATION_KEY)
    old = closed.filter("station_sk is not null").select(*dim.columns)
    new = closed.filter("station_sk is null").drop("station_sk")
    return old.unionByName(allocate_keys(new, dim, "station_sk", [*STATION_KEY, "effective_from"]).select(*dim.columns))


@dataclass(frozen=True)
class Star:
    dim_station: DataFrame
    dim_datetime: DataFrame
    dim_weather: DataFrame


def to_fact(balance: DataFrame, weather: DataFrame, star: Star, ctx: RunContext, missing: str = "zero") -> DataFrame:
    """Fact rows: weather, then the keys of hour, weather class and valid station version."""
    rows = flow.add_weather(balance, weather, missing)
    # The key is arithmetic on the hour; the dimension is only asked whether it exists.
    rows = rows.withColumn("__dt", measures.datetime_sk("date_hour"))
    rows = lookup.lookup(rows, star.dim_datetime, {"__dt": "datetime_sk"}, ["datetime_sk"])
    rows = lookup.lookup(rows, star.dim_weather, ["weather_category"], ["weather_condition_sk"])
    rows = lookup.scd2_lookup(rows, star.dim_station, STATION_KEY, "date_hour", ["station_sk"])
    return rows.withColumn("loaded_at", _now(ctx)).drop("__dt", "weather_category")


FACT_KEY = ["station_sk", "datetime_sk"]


def load_fact(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert by (station, hour); rows without a station version or hour wait."""
    ready = rows.filter("station_sk is not null and datetime_sk is not null").select(*fact.columns)
    return upsert(fact, ready, FACT_KEY, insert_only=["loaded_at"], null_keys=False)
