"""Calendar attributes and trip measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weather codes by category, in order of precedence.
SNOW_CODES = "SN|SG|PL"
FOG_CODES = "FG|BR|HZ"
RAIN_CODES = "RA|DZ|TS|GR"

# Report types from most to least preferred.
REPORT_TYPES = ("FM-15", "FM-16", "FM-12")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_weekday(d: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), _col(d)).cast("int")


def is_weekend(d: Column | str) -> Column:
    return iso_weekday(d) >= 6


def season(d: Column | str) -> Column:
    month = F.month(_col(d))
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .otherwise("fall")
    )


def is_peak_hour(d: Column | str, hour: Column) -> Column:
    return ~is_weekend(d) & hour.isin(7, 8, 17, 18)


def datetime_sk(ts: Column | str) -> Column:
    ts = _col(ts)
    return F.year(ts) * 1000000 + F.month(ts) * 10000 + F.dayofmonth(ts) * 100 + F.hour(ts)


def hour_of(ts: Column | str) -> Column:
    """Start of the hour. Built without a time zone, so no clock change can move it."""
    ts = _col(ts)
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return (_col(end) - _col(start)).cast("interval second").cast("decimal(18,6)")


def weather_category(codes: Column | str, precipitation: Column | str) -> Column:
    text = F.upper(F.coalesce(_col(codes), F.lit("")))
    wet = F.coalesce(_col(precipitation) > 0, F.lit(False))
    return (
        F.when(text.rlike(SNOW_CODES), "Snow")
        .when(text.rlike(FOG_CODES), "Fog")
        .when(text.rlike(RAIN_CODES) | wet, "Rain")
        .otherwise("Clear")
    )


def report_rank(report_type: Column | str) -> Column:
    rank = F.array_position(F.array(*[F.lit(t) for t in REPORT_TYPES]), _col(report_type))
    return F.when(rank > 0, rank).otherwise(len(REPORT_TYPES) + 1)


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes with two decimals; NULL for an open or backward interval."""
    start, end = _col(start), _col(end)
    return F.when(end >= start, F.round(seconds_between(start, end) / F.lit(60), 2).cast("decimal(10,2)"))


def ratio(top: Column, bottom: Column) -> Column:
    """Double division that gives NULL instead of an error on zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
