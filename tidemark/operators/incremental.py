"""Watermarks, load windows and re-aggregation of touched grains."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.context import DEFAULT_LOOKBACK_DAYS, DEFAULT_LSET, RunContext
from tidemark.operators.flow import GRAIN, balance_legs, trip_legs
from tidemark.operators.upsert import upsert


def read_watermark(
    control: DataFrame, source_name: str, table_name: str, ctx: RunContext, start_from: str = "lset"
) -> RunContext:
    """Context with the stored watermark; defaults apply when there is none.

    ``start_from="cet"`` continues at the previous extraction time.
    """
    row = (
        control.filter((F.col("source_name") == source_name) & (F.col("table_name") == table_name))
        .agg(F.max(start_from).alias("lset"), F.max("lookback_days").alias("lookback_days"))
        .first()
    )
    lset = row["lset"] or DEFAULT_LSET
    days = DEFAULT_LOOKBACK_DAYS if row["lookback_days"] is None else row["lookback_days"]
    return ctx.with_watermark(lset, days)


def watermarks(control: DataFrame, start_from: str = "lset") -> DataFrame:
    """Stored watermark and lookback of every source and table, defaults where they are missing."""
    return control.groupBy("source_name", "table_name").agg(
        F.coalesce(F.max(start_from), _literal(DEFAULT_LSET)).alias("lset"),
        F.coalesce(F.max("lookback_days"), F.lit(DEFAULT_LOOKBACK_DAYS)).alias("lookback_days"),
    )


def _literal(t: datetime) -> Column:
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def in_window(ts: str, lset: datetime, cet: datetime, lookback_days: int | None = None) -> Column:
    """Pull window as a plain range predicate, so it reaches the scan.

    Without lookback ``lset < ts <= cet``; with it ``lset - n days <= ts <= cet``.
    """
    upper = F.col(ts) <= _literal(cet)
    if lookback_days is None:
        return (F.col(ts) > _literal(lset)) & upper
    return (F.col(ts) >= _literal(lset - timedelta(days=lookback_days))) & upper


def incremental(df: DataFrame, ts: str, lset: datetime, cet: datetime, lookback_days: int | None = None) -> DataFrame:
    return df.filter(in_window(ts, lset, cet, lookback_days))


def advance_watermark(control: DataFrame, runs: DataFrame) -> DataFrame:
    """Set lset = cet for the sources that succeeded; a failed one keeps its lset.

    ``runs`` holds source_name, table_name, cet, status, row_count.
    """
    keys = ["source_name", "table_name"]
    done = runs.join(control.select(*keys, F.col("lset").alias("__old")), keys, "left").withColumn(
        "lset", F.when(F.col("status") == "SUCCESS", F.col("cet")).otherwise(F.col("__old"))
    )
    return upsert(control, done.drop("__old"), keys, ["lset", "cet", "status", "row_count"])


def affected_grains(*changed: DataFrame) -> DataFrame:
    """Distinct station-hours of the given trip versions.

    Pass the new *and* the previous version of changed trips: a trip that moves to
    another hour or station also changes the grain it leaves.
    """
    out = None
    for trips in changed:
        legs = trip_legs(trips).select(*GRAIN)
        out = legs if out is None else out.unionByName(legs)
    return out.distinct()


def weather_grains(fact_grains: DataFrame, weather_changes: DataFrame) -> DataFrame:
    """Station-hours whose city-hour received new weather."""
    hours = weather_changes.select("city_sk", F.col("observation_hour").alias("date_hour")).distinct()
    return fact_grains.select(*GRAIN).join(hours, ["city_sk", "date_hour"], "left_semi").select(*GRAIN)


def prune_trips(trips: DataFrame, grains: DataFrame) -> DataFrame:
    """Trips that can have a leg in the span of the (materialised) grains.

    The bounds become literals, so the scan skips files and row groups by the statistics
    of either time column.
    """
    low, high = grains.agg(F.min("date_hour"), F.max("date_hour")).first()
    if low is None:
        return trips.filter(F.lit(False))
    after = high + timedelta(hours=1)

    def inside(ts: str) -> Column:
        return (F.col(ts) >= _literal(low)) & (F.col(ts) < _literal(after))

    return trips.filter(inside("started_at") | inside("ended_at"))


def reaggregate(trips: DataFrame, grains: DataFrame) -> DataFrame:
    """Flow measures of the given grains from all trips.

    Pass materialised grains: their measured size lets Spark broadcast them when small,
    and then only the legs of touched grains are shuffled.
    """
    return balance_legs(trip_legs(trips).join(grains, GRAIN, "left_semi"))


def refresh_fact(fact: DataFrame, trips: DataFrame, grains: DataFrame) -> DataFrame:
    """New fact snapshot: touched grains replaced, emptied grains removed."""
    return replace_grains(fact, reaggregate(trips, grains), grains)


def replace_grains(fact: DataFrame, fresh: DataFrame, grains: DataFrame) -> DataFrame:
    """``fact`` with the rows of ``fresh`` in place of the given grains."""
    return fact.join(grains, GRAIN, "left_anti").unionByName(fresh.select(*fact.columns))


def period_filter(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """Rows whose leading date text lies in an inclusive range; blank dates drop out."""
    day = F.substring(F.trim(F.col(col)), 1, 10)
    return df.filter((F.length(day) > 0) & day.between(start, end))


def month_filter(df: DataFrame, col: str, month: str = "ALL") -> DataFrame:
    return df if month == "ALL" else df.filter(F.col(col) == month)
