"""Generated and static dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import clean, measures

# Attributes of the known cities.
CITIES = {
    "CHI": ("Chicago", "America/Chicago", "USW00014819", "divvy"),
    "NYC": ("New York City", "America/New_York", "USW00094728", "citibike"),
}
CITY_ATTRIBUTES = ("city_name", "timezone", "noaa_station_id", "gbfs_system_id")

# Weather categories with their precipitation band.
WEATHER_CONDITIONS = [
    ("Clear", "none"),
    ("Rain", "light_moderate"),
    ("Snow", "snow"),
    ("Fog", "none"),
]


def day_attributes(day: str) -> dict:
    return {
        "day_of_week": measures.iso_weekday(day),
        "is_weekend": measures.is_weekend(day),
        "month": F.month(day),
        "season": measures.season(day),
    }


def date_span(frames: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """First and last date over several sources (one row)."""
    spans = None
    for df, ts in frames:
        d = F.to_date(F.col(ts))
        one = df.agg(F.min(d).alias("first_day"), F.max(d).alias("last_day"))
        spans = one if spans is None else spans.unionByName(one)
    return spans.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def calendar(frames: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One row per day between the first and last date seen."""
    span = date_span(frames).filter("first_day is not null")
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("calendar_date"))
    return days.withColumns(day_attributes("calendar_date"))


def datetime_dim(span: DataFrame) -> DataFrame:
    """Every hour of the days first_day..last_day (one row) with its attributes."""
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("date"))
    hours = days.select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    sk = F.year("date") * 1000000 + F.month("date") * 10000 + F.dayofmonth("date") * 100 + F.col("hour")
    return hours.select(
        sk.alias("datetime_sk"),
        "date",
        "hour",
        measures.iso_weekday("date").alias("day_of_week"),
        measures.is_weekend("date").alias("is_weekend"),
        measures.is_peak_hour("date", F.col("hour")).alias("is_peak_hour"),
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        measures.season("date").alias("season"),
    )


def span_frame(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )


def observed_codes(
    frames: Sequence[DataFrame], col: str, mapping: Mapping[str, Sequence[str]], names: Sequence[str], out: str
) -> DataFrame:
    """Known codes that occur in the sources, with their attributes."""
    seen = None
    for df in frames:
        one = df.select(F.col(col).alias(out)).filter(F.col(out).isin(list(mapping))).distinct()
        seen = one if seen is None else seen.unionByName(one)
    seen = seen.distinct()
    attrs = {n: clean.decode(out, {k: v[i] for k, v in mapping.items()}) for i, n in enumerate(names)}
    return seen.withColumns(attrs)


def static_dim(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A declared constant dimension (weather conditions, source registry, holidays).

    Made of literals, so its size is known when the query is planned and joins with it
    never shuffle the other side by its few values.
    """
    fields = StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def weather_conditions(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, c, b) for i, (c, b) in enumerate(WEATHER_CONDITIONS)]
    return static_dim(spark, rows, "weather_condition_sk int, weather_category string, precipitation_band string")
