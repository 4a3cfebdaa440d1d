"""Checks of projections, filters, rules, duplicates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks.registry import check
from tidemark.checks.views import Tables, day, num, ts
from tidemark.functions import clean, measures
from tidemark.operators import dedup, dims, incremental, lookup, ordered, rules, scd
from tidemark.plans import bike

# Texts that begin like a timestamp: with a zone or a fraction, and impossible ones. Same meaning in both engines.
ODD_STARTS = (
    "case when source_row_number % 103 = 0 then substr(started_at, 1, 19) || '+00'"
    " when source_row_number % 107 = 0 then '2024-02-31 10:00:00'"
    " when source_row_number % 109 = 0 then substr(started_at, 1, 19) || 'Z'"
    " when source_row_number % 113 = 0 then '2024-02-10 25:61:00'"
    " when source_row_number % 127 = 0 then '2023-06-01 10:00:00.5' else started_at end"
)
ODD_HOURS = (
    "case when source_row_number % 103 = 0 then observation_ts || 'Z'"
    " when source_row_number % 107 = 0 then '2024-02-31T10:00:00'"
    " when source_row_number % 109 = 0 then substr(observation_ts, 1, 16)"
    " when source_row_number % 113 = 0 then '2024-02-10T25:61:00'"
    " when source_row_number % 127 = 0 then '2023-06-01 10:00:00.5' else observation_ts end"
)


@check(
    "sc_blank_to_null",
    "select source_row_number, nullif(trim(ride_id), '') as ride_id, nullif(trim(start_station_id), '') as station_id,"
    " nullif(trim(rideable_type), '') as rideable_type from raw_trips",
)
def _(t: Tables):
    return t.raw_trips.select(
        "source_row_number",
        clean.blank_to_null("ride_id").alias("ride_id"),
        clean.blank_to_null("start_station_id", any_whitespace=True).alias("station_id"),
        clean.blank_to_null("rideable_type").alias("rideable_type"),
    )


@check("sc_trim", "select source_row_number, trim(ride_id) as ride_id from raw_trips")
def _(t: Tables):
    return t.raw_trips.select("source_row_number", F.trim("ride_id").alias("ride_id"))


@check(
    "sc_trip_month",
    "select source_row_number, case when regexp_matches(started_at, '^20[0-9]{2}-(0[1-9]|1[0-2])')"
    " then substr(started_at, 1, 4) || substr(started_at, 6, 2) end as trip_month from raw_trips",
)
def _(t: Tables):
    return t.raw_trips.select("source_row_number", clean.year_month("started_at").alias("trip_month"))


@check(
    "sc_cast_ts",
    "select source_row_number, strftime(try_strptime(substr(trim(started_at), 1, 19), '%Y-%m-%d %H:%M:%S'),"
    f" '%Y-%m-%d %H:%M:%S') as started_at from (select * replace ({ODD_STARTS} as started_at) from raw_trips) r",
)
def _(t: Tables):
    odd = t.raw_trips.withColumn("started_at", F.expr(ODD_STARTS))
    return odd.select("source_row_number", clean.ts_seconds("started_at").alias("started_at"))


@check(
    "sc_cast_iso_ts",
    "select source_row_number, strftime(try_strptime(case when length(o) < 19 then o || ':00' else substr(o, 1, 19) end,"
    " '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as observation_ts"
    f" from (select *, replace(trim({ODD_HOURS}), 'T', ' ') as o from raw_weather) r",
)
def _(t: Tables):
    odd = t.raw_weather.withColumn("observation_ts", F.expr(ODD_HOURS))
    return odd.select("source_row_number", clean.ts_iso("observation_ts").alias("observation_ts"))


@check(
    "sc_cast_num",
    f"select source_row_number, {num('try_cast(trim(latitude) as double)')} as latitude,"
    " try_cast(trim(capacity) as bigint) as capacity from raw_stations",
)
def _(t: Tables):
    return t.raw_stations.select(
        "source_row_number", clean.number("latitude").alias("latitude"), clean.integer("capacity").alias("capacity")
    )


@check(
    "sc_cast_num_dirty",
    "select source_row_number, round(try_cast(hourly_dry_bulb_temperature as double), 6) as temperature,"
    " hourly_wind_speed::decimal(12,4)::double as wind_speed from raw_weather",
)
def _(t: Tables):
    marked = F.concat("hourly_wind_speed", F.lit("s"))  # trailing quality mark
    return t.raw_weather.select(
        "source_row_number",
        clean.dirty_number("hourly_dry_bulb_temperature").alias("temperature"),
        clean.dirty_number(marked).alias("wind_speed"),
    )


@check(
    "sc_cast_masks",
    f"select event_id, {num('value')} as value, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') as ts from events",
)
def _(t: Tables):
    text = t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit(" "), F.col("value").cast("string")).alias("value"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSSSSS"), F.lit("000")).alias("ts"),
    )
    spec = {"event_id": "bigint", "value": "decimal(10,2)", "user_id": "int", "ts": "masked_ts"}
    return text.select(*clean.cast_columns(spec)).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))


@check(
    "sc_array_flatten",
    "select p_partkey, replace(p_name, ' ', '|') || '|' || p_type as genres from part",
)
def _(t: Tables):
    words = F.concat(F.split("p_name", " "), F.array("p_type"))
    mixed = F.when(F.col("p_partkey") % 2 == 0, F.to_json(words)).otherwise(F.array_join(words, "|"))
    return t.part.select("p_partkey", clean.flatten_array_text(mixed).alias("genres"))


@check(
    "sc_json_payload",
    "select source_row_number, '{\"ride_id\":' || coalesce('\"' || ride_id || '\"', 'null') || ',\"end_station_id\":'"
    " || coalesce('\"' || end_station_id || '\"', 'null') || '}' as raw_payload from raw_trips",
)
def _(t: Tables):
    return t.raw_trips.select(
        "source_row_number", clean.raw_payload(["ride_id", "end_station_id"]).alias("raw_payload")
    )


@check(
    "sc_business_key",
    "select source_row_number, coalesce(nullif(trim(noaa_station_id), ''), '(null)') || '@' ||"
    " coalesce(nullif(trim(observation_ts), ''), '(null)') as business_key from raw_weather",
)
def _(t: Tables):
    key = clean.business_key("noaa_station_id", "observation_ts")
    return t.raw_weather.select("source_row_number", key.alias("business_key"))


@check(
    "sc_code_lookup",
    "select source_row_number, case source_city_code when 'CHI' then 'Chicago' when 'NYC' then 'New York City' end"
    " as city_name, case when gbfs_station_id like 'g1%' then 'first' when gbfs_station_id like 'g%' then 'other' end"
    " as id_group from raw_stations",
)
def _(t: Tables):
    names = {k: v[0] for k, v in dims.CITIES.items()}
    return t.raw_stations.select(
        "source_row_number",
        clean.decode("source_city_code", names).alias("city_name"),
        clean.decode_prefix("gbfs_station_id", {"g1": "first", "g": "other"}).alias("id_group"),
    )


SEASON_SQL = (
    "case when month({0}) in (12, 1, 2) then 'winter' when month({0}) <= 5 then 'spring'"
    " when month({0}) <= 8 then 'summer' else 'fall' end"
)


@check("sc_season", f"select o_orderkey, {SEASON_SQL.format('o_orderdate')} as season from orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", measures.season("o_orderdate").alias("season"))


@check(
    "sc_calendar",
    "select o_orderkey, isodow(o_orderdate) as day_of_week, isodow(o_orderdate) >= 6 as is_weekend,"
    " month(o_orderdate) as month from orders",
)
def _(t: Tables):
    return t.orders.select(
        "o_orderkey",
        measures.iso_weekday("o_orderdate").alias("day_of_week"),
        measures.is_weekend("o_orderdate").alias("is_weekend"),
        F.month("o_orderdate").alias("month"),
    )


@check(
    "sc_peak",
    "select event_id, isodow(ts) <= 5 and hour(ts) in (7, 8, 17, 18) as is_peak_hour from events",
)
def _(t: Tables):
    return t.events.select("event_id", measures.is_peak_hour("ts", F.hour("ts")).alias("is_peak_hour"))


@check(
    "sc_datetime_sk",
    "select event_id, year(ts) * 1000000 + month(ts) * 10000 + day(ts) * 100 + hour(ts) as datetime_sk from events",
)
def _(t: Tables):
    return t.events.select("event_id", measures.datetime_sk("ts").alias("datetime_sk"))


@check(
    "sc_weather_category",
    "select event_id, case when regexp_matches(upper(present_weather), 'SN|SG|PL') then 'Snow'"
    " when regexp_matches(upper(present_weather), 'FG|BR|HZ') then 'Fog'"
    " when regexp_matches(upper(present_weather), 'RA|DZ|TS|GR') or precipitation_mm > 0 then 'Rain' else 'Clear' end"
    " as weather_category from stg_weather",
)
def _(t: Tables):
    category = measures.weather_category("present_weather", "precipitation_mm")
    return t.stg_weather.select("event_id", category.alias("weather_category"))


@check("sc_duration", f"select ride_id, {num('duration_minutes')} as duration_minutes from trips")
def _(t: Tables):
    return t.trips.select("ride_id", measures.duration_minutes("started_at", "ended_at").alias("duration_minutes"))


@check(
    "sc_norm_name",
    "select s_suppkey, nullif(regexp_replace(lower(coalesce(s_name, '')), '[^a-z0-9]+', '', 'g'), '') as name"
    " from supplier",
)
def _(t: Tables):
    noisy = F.concat(F.upper("s_name"), F.lit(" !"))
    return t.supplier.select("s_suppkey", clean.normalize_name(noisy).alias("name"))


@check("sc_constants", "select event_id, true as is_current, 'daily' as job_name, 1 as step from events")
def _(t: Tables):
    return clean.with_constants(t.events.select("event_id"), is_current=True, job_name="daily", step=1)


@check(
    "sc_route",
    "select e.event_id, case when event_type = 'error' then case when c_custkey is not null then 'DELETE' else 'SKIP'"
    " end when c_custkey is not null then 'UPDATE' else 'INSERT' end as route"
    " from events e left join customer c on c.c_custkey = e.user_id * 13",
)
def _(t: Tables):
    known = lookup.lookup(
        t.events.withColumn("k", F.col("user_id") * 13), t.customer, {"k": "c_custkey"}, {"c_name": "c_name"}
    )
    op = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "view", "insert")
    return known.select("event_id", scd.route_operation(F.col("c_name").isNotNull(), op).alias("route"))


# ---- filters ----


@check("flt_not_null", "select ride_id, start_station_sk from resolved where start_station_sk is not null")
def _(t: Tables):
    return lookup.keep_resolved(t.resolved, "start_station_sk").select("ride_id", "start_station_sk")


@check(
    "flt_route",
    "select case when event_type = 'error' then 'DELETE' when value > 50 then 'UPDATE' when value > 10 then 'INSERT'"
    " else 'SKIP' end as route, count(*) as n, count(distinct user_id) as users from events group by 1",
)
def _(t: Tables):
    routes = {
        "DELETE": F.col("event_type") == "error",
        "UPDATE": F.col("value") > 50,
        "INSERT": F.col("value") > 10,
    }
    parts = lookup.split_by(t.events, routes)
    out = dedup.union_all(*parts.values())
    return out.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@check(
    "flt_month_param",
    "select trip_month, count(*) as n from raw_trips group by 1 union all"
    " select 'only ' || trip_month, count(*) from raw_trips where trip_month = '202401' group by 1",
)
def _(t: Tables):
    def counted(df, label):
        return df.groupBy(label.alias("trip_month")).agg(F.count(F.lit(1)).alias("n"))

    every = incremental.month_filter(t.raw_trips, "trip_month")
    one = incremental.month_filter(t.raw_trips, "trip_month", "202401")
    only = F.concat(F.lit("only "), "trip_month")
    return dedup.union_all(counted(every, F.col("trip_month")), counted(one, only))


TS_OK = (
    r"(regexp_matches(started_at, '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')"
    r" and try_strptime(substr(started_at, 1, 19), '%Y-%m-%d %H:%M:%S') is not null)"
)
ACCEPT_TRIPS = f"""
nullif(trim(ride_id), '') is not null and nullif(trim(started_at), '') is not null
  and nullif(trim(source_city_code), '') is not null and {TS_OK}
  and regexp_matches(coalesce(trip_month, ''), '^[0-9]{{6}}$')
  and not (nullif(trim(start_station_id), '') is null and nullif(trim(end_station_id), '') is null)"""

TRIP_RULES = bike.trip_rules


@check("flt_accept", f"select source_row_number, ride_id from raw_trips where {ACCEPT_TRIPS}")
def _(t: Tables):
    return rules.accept_rows(t.raw_trips, TRIP_RULES("CITI", "citibike_trips")).select("source_row_number", "ride_id")


@check(
    "flt_threshold",
    "select * from (select l_orderkey, count(*) - count(distinct l_linenumber) as extra,"
    " count(*) filter (l_discount > 0.09) as high from lineitem group by 1) x where extra > 0 or high > 0",
)
def _(t: Tables):
    from tidemark.operators.reconcile import leaking

    report = t.lineitem.groupBy("l_orderkey").agg(
        (F.count(F.lit(1)) - F.count_distinct("l_linenumber")).alias("extra"),
        F.count_if(F.col("l_discount") > 0.09).alias("high"),
    )
    return leaking(report, "extra", "high")


# ---- data quality ----

BLANK = "nullif(trim({0}), '') is null"
SOUND = f"""nullif(trim(ride_id), '') is not null and nullif(trim(started_at), '') is not null and {TS_OK}
  and regexp_matches(coalesce(trip_month, ''), '^[0-9]{{6}}$')"""
MONTH_BAD = "not regexp_matches(coalesce(trip_month, ''), '^[0-9]{6}$')"
TRIP_FAILS = {
    "NULL_REQUIRED": ("null", "reject", f"{BLANK.format('ride_id')} or {BLANK.format('started_at')}"
                      f" or {BLANK.format('source_city_code')}"),
    "DATATYPE_TIMESTAMP": ("datatype", "reject", f"nullif(trim(ride_id), '') is not null"
                           f" and nullif(trim(started_at), '') is not null and not {TS_OK}"),
    "FORMAT_TRIP_MONTH": ("format", "reject", f"nullif(trim(ride_id), '') is not null and {MONTH_BAD}"),
    "REJECT_BOTH_STATION_ID": ("null", "reject", f"{SOUND} and {BLANK.format('start_station_id')}"
                               f" and {BLANK.format('end_station_id')}"),
    "WARN_STATION_ID": ("null", "warning", f"{SOUND} and ({BLANK.format('start_station_id')})"
                        f" <> ({BLANK.format('end_station_id')})"),
}


def trip_details_sql(prefix: str, trimmed: bool) -> str:
    key = "coalesce(nullif(trim(ride_id), ''), '(null)') as business_key"
    parts = [
        f"select source_file, source_row_number, {key}, '{prefix}_{code}' as rule_code, '{kind}' as rule_type,"
        f" '{sev}' as dq_verdict from raw_trips where {cond}"
        for code, (kind, sev, cond) in TRIP_FAILS.items()
    ]
    shown = "nullif(trim(r.{0}), '')" if trimmed else "r.{0}"
    parts.append(
        f"select r.source_file, r.source_row_number, {key.replace('ride_id', 'r.ride_id')},"
        f" '{prefix}_DUPLICATE_RIDE', 'duplicate', 'reject' from raw_trips r join (select source_city_code, ride_id"
        " from raw_trips group by all having count(*) > 1) d on"
        f" d.source_city_code = {shown.format('source_city_code')} and d.ride_id = {shown.format('ride_id')}"
    )
    return "\nunion all\n".join(parts)


DETAIL = ["source_file", "source_row_number", "business_key", "rule_code", "rule_type", "dq_verdict"]


def trip_details(t: Tables, prefix="CITI", source="citibike_trips", trimmed=False, codes=None):
    codes = codes and [f"{prefix}_{c}" for c in codes]
    return rules.dq_details(t.raw_trips, TRIP_RULES(prefix, source, trimmed), codes=codes).select(*DETAIL)


def one_rule_sql(prefix: str, codes: list[str]) -> str:
    wanted = ", ".join(f"'{prefix}_{c}'" for c in codes)
    return f"select * from ({trip_details_sql(prefix, False)}) d where rule_code in ({wanted})"


@check("dq_null_required", one_rule_sql("CITI", ["NULL_REQUIRED"]))
def _(t: Tables):
    return trip_details(t, codes=["NULL_REQUIRED"])


@check("dq_duplicate", one_rule_sql("CITI", ["DUPLICATE_RIDE"]))
def _(t: Tables):
    return trip_details(t, codes=["DUPLICATE_RIDE"])


@check("dq_datatype_ts", one_rule_sql("CITI", ["DATATYPE_TIMESTAMP"]))
def _(t: Tables):
    return trip_details(t, codes=["DATATYPE_TIMESTAMP"])


WEATHER_ID = "nullif(trim(noaa_station_id), '') is not null and nullif(trim(observation_ts), '') is not null"
NUMERIC = r"'^-?[0-9]+(\.[0-9]+)?$'"
WEATHER_NUM = " or ".join(
    f"not regexp_matches({c}, {NUMERIC})"
    for c in ("hourly_dry_bulb_temperature", "hourly_precipitation", "hourly_wind_speed")
)
REPORT_BAD = "nullif(trim(report_type), '') is null or report_type not in ('FM-15', 'FM-16', 'FM-12')"


def weather_rule_sql(code: str, kind: str, cond: str) -> str:
    return (
        "select source_row_number, coalesce(nullif(trim(noaa_station_id), ''), '(null)') || '@' ||"
        f" coalesce(nullif(trim(observation_ts), ''), '(null)') as business_key, '{code}' as rule_code,"
        f" '{kind}' as rule_type from raw_weather where {WEATHER_ID} and ({cond})"
    )


STATION_ID = (
    "nullif(trim(source_city_code), '') is not null"
    " and (nullif(trim(short_name), '') is not null or nullif(trim(gbfs_station_id), '') is not null)"
)
CAP_BAD = "nullif(trim(capacity), '') is not null and not regexp_matches(trim(capacity), '^[0-9]+$')"
COORD_BAD = (
    f"not regexp_matches(coalesce(trim(latitude), ''), {NUMERIC}) or"
    f" not regexp_matches(coalesce(trim(longitude), ''), {NUMERIC}) or"
    " coalesce(try_cast(trim(latitude) as double) not between -90 and 90, true) or"
    " coalesce(try_cast(trim(longitude) as double) not between -180 and 180, true)"
)


def station_rule_sql(code: str, kind: str, cond: str) -> str:
    return (
        "select source_row_number, coalesce(nullif(trim(short_name), ''), nullif(trim(gbfs_station_id), ''), '(null)')"
        f" as business_key, '{code}' as rule_code, '{kind}' as rule_type from raw_stations"
        f" where {STATION_ID} and ({cond})"
    )


SHORT = ["source_row_number", "business_key", "rule_code", "rule_type"]


@check(
    "dq_datatype_num",
    weather_rule_sql("NOAA_DATATYPE_NUMERIC", "datatype", WEATHER_NUM)
    + " union all "
    + station_rule_sql("GBFS_DATATYPE_CAPACITY", "datatype", CAP_BAD),
)
def _(t: Tables):
    a = rules.dq_details(t.raw_weather, bike.weather_rules(), codes=["NOAA_DATATYPE_NUMERIC"])
    b = rules.dq_details(t.raw_stations, bike.station_rules(), codes=["GBFS_DATATYPE_CAPACITY"])
    return dedup.union_all(a.select(*SHORT), b.select(*SHORT))


@check(
    "dq_format",
    weather_rule_sql("NOAA_FORMAT_REPORT_TYPE", "format", REPORT_BAD)
    + " union all select source_row_number, coalesce(nullif(trim(ride_id), ''), '(null)'),"
    f" 'CITI_FORMAT_TRIP_MONTH', 'format' from raw_trips where nullif(trim(ride_id), '') is not null and {MONTH_BAD}",
)
def _(t: Tables):
    a = rules.dq_details(t.raw_weather, bike.weather_rules(), codes=["NOAA_FORMAT_REPORT_TYPE"])
    b = trip_details(t, codes=["FORMAT_TRIP_MONTH"])
    return dedup.union_all(a.select(*SHORT), b.select(*SHORT))


@check(
    "dq_range",
    station_rule_sql("GBFS_FORMAT_COORDINATE", "format", f"not coalesce({CAP_BAD}, false) and ({COORD_BAD})"),
)
def _(t: Tables):
    return rules.dq_details(t.raw_stations, bike.station_rules(), codes=["GBFS_FORMAT_COORDINATE"]).select(*SHORT)


@check("dq_cross_field", one_rule_sql("CITI", ["REJECT_BOTH_STATION_ID", "WARN_STATION_ID"]))
def _(t: Tables):
    return trip_details(t, codes=["REJECT_BOTH_STATION_ID", "WARN_STATION_ID"])


@check("dq_details", trip_details_sql("DIVVY", True))
def _(t: Tables):
    return trip_details(t, "DIVVY", "divvy_trips", trimmed=True)


SUMMARY_SQL = f"""
select rule_code, rule_type, severity, greatest(total - failed - warned, 0) as passed_count, failed as failed_count,
  warned as warning_count
from (select count(*) as total,
    count(*) filter ({TRIP_FAILS['NULL_REQUIRED'][2]}) as c1,
    count(*) filter (n > 1) as c2,
    count(*) filter ({TRIP_FAILS['DATATYPE_TIMESTAMP'][2]}) as c3,
    count(*) filter ({MONTH_BAD}) as c4,
    count(*) filter ({TRIP_FAILS['REJECT_BOTH_STATION_ID'][2]}) as c5,
    count(*) filter ({TRIP_FAILS['WARN_STATION_ID'][2]}) as c6
  from (select *, count(*) over (partition by source_city_code, ride_id) as n from raw_trips) r) m,
lateral (values ('CITI_NULL_REQUIRED', 'null', 'reject', c1, 0), ('CITI_DUPLICATE_RIDE', 'duplicate', 'reject', c2, 0),
  ('CITI_DATATYPE_TIMESTAMP', 'datatype', 'reject', c3, 0), ('CITI_FORMAT_TRIP_MONTH', 'format', 'reject', c4, 0),
  ('CITI_REJECT_BOTH_STATION_ID', 'null', 'reject', c5, 0), ('CITI_WARN_STATION_ID', 'null', 'warning', 0, c6))
  v(rule_code, rule_type, severity, failed, warned)"""


@check("dq_summary", SUMMARY_SQL)
def _(t: Tables):
    out = rules.dq_summary(t.raw_trips, TRIP_RULES("CITI", "citibike_trips"))
    return out.drop("source_name", "load_run_id")


@check(
    "dq_rollup",
    f"""select 'run' as load_run_id, 'citibike_trips' as source_name, rule_type, count(*) as rule_count,
  sum(passed_count)::bigint as passed_count, sum(failed_count)::bigint as failed_count,
  sum(warning_count)::bigint as warning_count, case when sum(failed_count) = 0 then 'DQ_PASSED'
  when sum(passed_count) + sum(warning_count) = 0 then 'DQ_FAILED' else 'DQ_PARTIAL_PASSED' end as status
from ({SUMMARY_SQL}) s group by rule_type""",
)
def _(t: Tables):
    return rules.dq_rollup(rules.dq_summary(t.raw_trips, TRIP_RULES("CITI", "citibike_trips")))


@check(
    "dq_gate",
    "select source_file as source_name, count(*) as row_count, case when count(*) filter (trip_month = '2024-01') > 18"
    " then 'FAILED' end as status from raw_trips group by 1",
)
def _(t: Tables):
    control = t.raw_trips.groupBy(F.col("source_file").alias("source_name")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.when(F.count_if(F.col("trip_month") == "2024-01") > 18, "FAILED").alias("status"),
    )
    return rules.gate_offenders(control)


@check(
    "dq_gbfs_fallback",
    "select source_row_number, coalesce(nullif(trim(short_name), ''), nullif(trim(gbfs_station_id), '')) as short_name"
    " from raw_stations",
)
def _(t: Tables):
    key = clean.first_filled("short_name", "gbfs_station_id")
    return t.raw_stations.select("source_row_number", key.alias("short_name"))


@check(
    "dq_user_push",
    """select event_id, case
  when op is null or op not in ('INSERT', 'UPDATE', 'DELETE') then 'Invalid operation'
  when user_id is null or user_id <= 0 then 'Invalid user_id'
  when nullif(trim(username), '') is null then 'Invalid username'
  when email is null or not regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') then 'Invalid email'
  when age is null or age <= 0 then 'Invalid age'
  when gender is null or gender not in ('M', 'F') then 'Invalid gender'
  when created_at is null then 'Missing timestamps' end as error
from (select event_id, case event_type when 'error' then 'PATCH' when 'view' then 'UPDATE' else 'INSERT' end as op,
    user_id, case when event_id % 37 = 0 then ' ' else 'u' || user_id end as username,
    case when event_id % 31 = 0 then 'no mail' else 'u' || user_id || '@example.org' end as email,
    event_id % 41 as age, case when event_id % 43 = 0 then 'X' when event_id % 2 = 0 then 'M' else 'F' end as gender,
    case when event_id % 47 <> 0 then ts end as created_at from events) x""",
)
def _(t: Tables):
    pushed = t.events.selectExpr(
        "event_id",
        "case event_type when 'error' then 'PATCH' when 'view' then 'UPDATE' else 'INSERT' end as operation",
        "user_id",
        "case when event_id % 37 = 0 then ' ' else concat('u', user_id) end as username",
        "case when event_id % 31 = 0 then 'no mail' else concat('u', user_id, '@example.org') end as email",
        "event_id % 41 as age",
        "case when event_id % 43 = 0 then 'X' when event_id % 2 = 0 then 'M' else 'F' end as gender",
        "case when event_id % 47 <> 0 then ts end as created_at",
        "ts as last_update_timestamp",
    )
    return pushed.select("event_id", clean.first_error(bike.user_push_checks()).alias("error"))


@check(
    "dq_station_push",
    """select source_row_number, case
  when op not in ('INSERT', 'UPDATE', 'DELETE') then 'Invalid operation'
  when source_city_code not in ('CHI', 'NYC') then 'Invalid source_city_code'
  when nullif(trim(short_name), '') is null then 'Invalid station''s short_name'
  when city_sk is null then 'Unknown source_city_code in NDS city' end as error
from (select r.*, case when c_custkey % 17 = 0 then 'MOVE' else 'UPDATE' end as op, c.city_sk
      from raw_stations r left join (select * from city where city_code = 'CHI') c on c.city_code = r.source_city_code) x""",
)
def _(t: Tables):
    ops = t.raw_stations.withColumn(
        "operation",
        F.when(F.floor((F.col("source_row_number") - 1) / 2) % 17 == 0, "MOVE").otherwise("UPDATE"),
    )
    known = lookup.lookup(ops, t.city.filter("city_code = 'CHI'"), {"source_city_code": "city_code"}, ["city_sk"])
    return known.select("source_row_number", clean.first_error(bike.station_push_checks()).alias("error"))


@check(
    "dq_constraints",
    """
select 'member_casual' as check_name, count(*) filter (member_casual not in ('member')) as bad_rows from resolved
union all select 'duration', count(*) filter (duration_minutes is null and ended_at >= started_at
  or duration_minutes is not null and ended_at is null or duration_minutes > 400) from resolved
union all select 'unique ride', count(*) - count(distinct (city_sk, ride_id)) from resolved
union all select 'unique line', count(*) - count(distinct (l_orderkey, l_linenumber)) from lineitem
union all select 'station city', count(*) filter (s.city_sk <> t.city_sk) from resolved t
  join stations s on s.station_sk = t.start_station_sk
union all select 'end station city', count(*) filter (s.city_sk <> t.city_sk) from resolved t
  join stations s on s.station_sk = t.end_station_sk
union all select 'other end city', count(*) filter (s.city_sk <> t.city_sk) from resolved t
  join stations s on s.station_sk = 2000 + t.end_station_sk % 1000
union all select 'recomputed duration', count(*) filter (ended_at >= started_at
  and abs(duration_minutes - (epoch_us(ended_at) - epoch_us(started_at)) / 60000000.0) > 0.0051) from resolved""",
)
def _(t: Tables):
    span = F.col("ended_at") >= F.col("started_at")
    minutes = F.col("duration_minutes")
    checks = {
        "member_casual": ~F.col("member_casual").isin("member"),
        "duration": (minutes.isNull() & span) | (minutes.isNotNull() & F.col("ended_at").isNull()) | (minutes > 400),
        "recomputed duration": span
        & (F.abs(minutes - F.expr("timestampdiff(MICROSECOND, started_at, ended_at)") / 60000000.0) > 0.0051),
    }
    same = F.col("d_city_sk") == F.col("city_sk")
    # Every end station taken for one of city 2: the check must see those of city 1.
    astray = t.resolved.withColumn("end_station_sk", F.lit(2000).cast("bigint") + F.col("end_station_sk") % 1000)
    return dedup.union_all(
        rules.check_constraints(t.resolved, checks),
        rules.check_unique(t.resolved, ["city_sk", "ride_id"], "unique ride"),
        rules.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"], "unique line"),
        rules.check_reference(t.resolved, t.stations, "start_station_sk", "station_sk", same, "station city"),
        rules.check_reference(t.resolved, t.stations, "end_station_sk", "station_sk", same, "end station city"),
        rules.check_reference(astray, t.stations, "end_station_sk", "station_sk", same, "other end city"),
    )


# ---- duplicates and windows ----

LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)


@check(
    "dd_first",
    f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, {ts('l_shipdate')} as l_shipdate from (select *,"
    f" row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) as rn from lineitem) x"
    " where rn = 1",
)
def _(t: Tables):
    first = dedup.dedup_first(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@check(
    "dd_best",
    f"select city_sk, {ts('observation_hour')} as observation_hour, report_type, {num('temperature_c')} as temperature_c,"
    " weather_category from weather",
)
def _(t: Tables):
    return t.weather.select("city_sk", "observation_hour", "report_type", "temperature_c", "weather_category")


@check(
    "dd_distinct",
    "select 'pairs' as what, count(distinct (l_orderkey, l_linenumber)) as n from lineitem union all"
    " select 'flags', count(*) from (select distinct l_returnflag, l_linestatus from lineitem) x",
)
def _(t: Tables):
    pairs = dedup.count_distinct(t.lineitem, ["l_orderkey", "l_linenumber"], "n")
    flags = dedup.count_distinct(t.lineitem, ["l_returnflag", "l_linestatus"], "n")
    return dedup.union_all(
        pairs.select(F.lit("pairs").alias("what"), "n"), flags.select(F.lit("flags").alias("what"), "n")
    )


@check(
    "wn_count",
    "select source_row_number, count(*) over (partition by source_city_code, ride_id) as key_count from raw_trips",
)
def _(t: Tables):
    counted = ordered.count_over(t.raw_trips, ["source_city_code", "ride_id"])
    return counted.select("source_row_number", "key_count")


@check(
    "wn_row_number",
    f"select l_suppkey, l_orderkey, l_linenumber, row_number() over (partition by l_suppkey order by l_shipdate,"
    f" l_orderkey, l_linenumber, {LINE_ORDER_SQL}) as row_num from lineitem",
)
def _(t: Tables):
    order = [F.col(c) for c in ["l_shipdate", "l_orderkey", "l_linenumber", *LINE_ORDER]]
    year = F.year("l_shipdate")
    ranked = ordered.rank_rows(t.lineitem, ["l_suppkey"], order, slice_by=year)
    return ranked.select("l_suppkey", "l_orderkey", "l_linenumber", "row_num")


# ---- sorts and sets ----


@check(
    "so_orderby",
    "select source_city_code, trip_month, n, row_number() over (partition by source_city_code order by case when"
    " trip_month = '2024-01' then 1 else 0 end, trip_month nulls first) as pos"
    " from (select source_city_code, trip_month, count(*) as n from raw_trips group by all) x",
)
def _(t: Tables):
    months = t.raw_trips.groupBy("source_city_code", "trip_month").agg(F.count(F.lit(1)).alias("n"))
    last = F.when(F.col("trip_month") == "2024-01", 1).otherwise(0)
    key = [last, F.asc_nulls_first("trip_month")]
    return ordered.rank_rows(months, ["source_city_code"], key, "pos").orderBy("source_city_code", *key)


@check(
    "so_limit",
    f"select event_id, event_type, {ts('ts')} as ts from events order by events.ts desc, event_id desc limit 10",
)
def _(t: Tables):
    return t.events.select("event_id", "event_type", "ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(10)


@check(
    "so_topcount",
    "select l_partkey, count(*) as n from lineitem group by 1 order by 2 desc, 1 limit 20",
)
def _(t: Tables):
    return dedup.top_count(t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")), "n", 20, ["l_partkey"])


@check(
    "set_union_all",
    f"select source, {day('d')} as d, count(*) as n from (select 'order' as source, o_orderdate as d from orders"
    " union all select 'line', l_shipdate from lineitem union all select 'event', ts::date from events) u group by all",
)
def _(t: Tables):
    frames = [
        t.orders.select(F.lit("order").alias("source"), F.to_date("o_orderdate").alias("d")),
        t.lineitem.select(F.lit("line").alias("source"), F.to_date("l_shipdate").alias("d")),
        t.events.select(F.lit("event").alias("source"), F.to_date("ts").alias("d")),
    ]
    return dedup.union_all(*frames).groupBy("source", "d").agg(F.count(F.lit(1)).alias("n"))


@check(
    "set_union",
    "select city_sk, start_station_id as station_id from trips where start_station_id is not null union"
    " select city_sk, end_station_id from trips where end_station_id is not null",
)
def _(t: Tables):
    a = t.trips.select("city_sk", F.col("start_station_id").alias("station_id"))
    b = t.trips.select("city_sk", F.col("end_station_id").alias("station_id"))
    return dedup.union_distinct(a, b).filter("station_id is not null")
