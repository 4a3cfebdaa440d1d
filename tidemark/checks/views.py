"""Bike-share shaped views over the benchmark tables, in Spark and as SQL text.

``Tables`` gives the Spark side; ``CTES`` the same definitions for the SQL side, which
``with_sql`` puts in front of a query as far as it needs them. Faults are planted by
modulus so that every rule fires.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.context import RunContext
from tidemark.functions import measures
from tidemark.operators import dims, flow, lookup
from tidemark.operators.dedup import dedup_best, union_distinct
from tidemark.session import materialize

from datetime import datetime

# End of the first load: later rows arrive with the second one.
FIRST_LOAD = datetime(2024, 1, 20)
SECOND_LOAD = datetime(2024, 2, 1)
CTX = RunContext("check", datetime(2024, 7, 1), cet=datetime(2024, 7, 1), lset=datetime(2024, 1, 4), lookback_days=3)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def trips(self) -> DataFrame:
        """Typed staged trips: events spread over five months."""
        return (
            self.events.selectExpr(
                "event_id",
                "cast(event_id as string) as ride_id",
                "case when user_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code",
                "cast(1 + user_id % 2 as int) as city_sk",
                "ts + make_ym_interval(0, cast(floor(event_id / 7) % 5 as int)) as started_at",
                "value",
                "event_type",
                "case when event_id % 29 = 0 then null else concat('S', user_id % 20) end as start_station_id",
                "case when event_id % 11 = 0 then null else concat('S', event_id % 25) end as end_station_id",
                "case when user_id % 3 = 0 then 'casual' else 'member' end as member_casual",
                "case when event_type in ('view', 'click') then 'electric_bike' else 'classic_bike' end as rideable_type",
                "ts as loaded_at",
            )
            .withColumn(
                "ended_at",
                F.expr(
                    "case when event_type = 'error' then null"
                    " when event_id % 53 = 0 then started_at - interval 90 seconds"
                    " else started_at + make_dt_interval(0, 0, 0, cast(floor(value * 60) as decimal(18,6))) end"
                ),
            )
            .withColumn("duration_minutes", measures.duration_minutes("started_at", "ended_at"))
            .drop("value", "event_type", "event_id")
        )

    @cached_property
    def stations(self) -> DataFrame:
        """Master of the used stations but two, whose trips have to wait."""
        starts = self.trips.select("city_sk", F.col("start_station_id").alias("source_station_id"))
        ends = self.trips.select("city_sk", F.col("end_station_id").alias("source_station_id"))
        ids = union_distinct(starts, ends).filter("source_station_id is not null")
        number = F.substring("source_station_id", 2, 10).cast("bigint")
        return ids.filter(~F.col("source_station_id").isin("S7", "S21")).select(
            (F.col("city_sk") * 1000 + number).cast("bigint").alias("station_sk"),
            "city_sk",
            "source_station_id",
            F.concat(F.lit("Station "), number.cast("string")).alias("station_name"),
            (number % 20 + 10).cast("int").alias("capacity"),
            F.lit("open").alias("station_status"),
            F.lit(True).alias("is_current"),
            F.lit("1900-01-01 00:00:00").cast("timestamp_ntz").alias("effective_from"),
            F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        )

    @cached_property
    def resolved(self) -> DataFrame:
        out = self.trips
        for end in ("start", "end"):
            keys = {"city_sk": "city_sk", f"{end}_station_id": "source_station_id"}
            out = lookup.lookup_best(out, self.stations, keys, {"station_sk": f"{end}_station_sk"})
        return out

    @cached_property
    def nds_trips(self) -> DataFrame:
        ready, _ = lookup.split_pending(
            self.resolved, {"start_station_id": "start_station_sk", "end_station_id": "end_station_sk"}
        )
        return ready

    @cached_property
    def city(self) -> DataFrame:
        found = dims.observed_codes([self.trips], "source_city_code", dims.CITIES, dims.CITY_ATTRIBUTES, "city_code")
        return found.withColumn("city_sk", F.when(F.col("city_code") == "CHI", 1).otherwise(2))

    @cached_property
    def stg_weather(self) -> DataFrame:
        return self.events.selectExpr(
            "case when event_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code",
            "cast(1 + event_id % 2 as int) as city_sk",
            "event_id",
            "ts + make_ym_interval(0, cast(floor(event_id / 7) % 5 as int)) as observation_ts",
            "case user_id % 4 when 0 then 'FM-15' when 1 then 'FM-16' when 2 then 'FM-12' else 'SOD' end as report_type",
            "cast(value as decimal(8,2)) as temperature_c",
            "cast(case when event_id % 5 = 0 then floor(value) / 100 else 0 end as decimal(10,2)) as precipitation_mm",
            "cast(event_id % 30 as decimal(8,2)) as wind_speed_ms",
            "case event_type when 'purchase' then 'sn' when 'error' then 'FG' when 'click' then '-RA'"
            " when 'signup' then 'TS' else '' end as present_weather",
        )

    @cached_property
    def weather(self) -> DataFrame:
        hours = self.stg_weather.withColumn("observation_hour", measures.hour_of("observation_ts"))
        best = dedup_best(
            hours, ["city_sk", "observation_hour"], measures.report_rank("report_type"), ["observation_ts", "event_id"]
        )
        return best.withColumn(
            "weather_category", measures.weather_category("present_weather", "precipitation_mm")
        ).drop("event_id", "source_city_code", "observation_ts")

    @cached_property
    def balance(self) -> DataFrame:
        return flow.station_hour_balance(self.nds_trips)

    @cached_property
    def dim_datetime(self) -> DataFrame:
        span = dims.date_span([(self.trips, "started_at"), (self.trips, "ended_at")])
        return dims.datetime_dim(span)

    @cached_property
    def dim_weather(self) -> DataFrame:
        return dims.weather_conditions(self.spark)

    @cached_property
    def fact(self) -> DataFrame:
        rows = flow.add_weather(self.balance, self.weather)
        rows = rows.withColumn("datetime_sk", measures.datetime_sk("date_hour"))
        rows = lookup.lookup(rows, self.dim_weather, ["weather_category"], ["weather_condition_sk"])
        rows = lookup.scd2_lookup(rows, self.stations, ["city_sk", "source_station_id"], "date_hour", ["station_sk"])
        return rows.drop("weather_category", "city_sk", "source_station_id", "date_hour")

    @cached_property
    def star(self) -> DataFrame:
        """Built from resolved trips and a master that are computed once and written."""
        from tidemark.plans.kpi import star_join

        once = Tables(self.spark, self.sf_dir)
        once.__dict__["stations"] = materialize(self.stations, "stations")
        once.__dict__["resolved"] = materialize(once.resolved, "resolved")
        once.__dict__["trips"] = once.resolved
        once.__dict__["fact"] = materialize(once.fact, "fact")
        return star_join(once.fact, once.dim_datetime, once.stations, once.city, once.dim_weather)

    @cached_property
    def raw_trips(self) -> DataFrame:
        base = self.events.selectExpr(
            "event_id",
            "case when event_id % 197 = 0 then null when event_id % 97 = 0 then '  '"
            " else concat(' ', event_id, case when event_id % 3 = 0 then ' ' else '' end) end as ride_id",
            "case when event_type in ('view', 'click') then 'electric_bike' else ' classic_bike ' end as rideable_type",
            "case when event_id % 89 = 0 then '2024/01/01' when event_id % 101 = 0 then '2024-13-01 00:00:00'"
            " else date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') end as started_at",
            "case when event_type = 'error' then '' else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end as ended_at",
            "case when event_id % 83 = 0 or event_id % 79 = 0 then '  ' else concat('S', user_id % 20)"
            " end as start_station_id",
            "case when event_id % 83 = 0 then null else concat('S', event_id % 25) end as end_station_id",
            "case when user_id % 3 = 0 then 'casual' else 'member' end as member_casual",
            "case when user_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code",
            "case when event_id % 73 = 0 then '2024-01' else date_format(ts, 'yyyyMM') end as trip_month",
            "concat('f', event_id % 7) as source_file",
            "event_id * 2 + 1 as source_row_number",
            "'check' as load_run_id",
        )
        again = base.filter("event_id % 50 = 0").withColumn("source_row_number", F.expr("event_id * 2 + 2"))
        empty = {c: F.lit(None).cast("string") for c in
                 ("start_station_name", "end_station_name", "start_lat", "start_lng", "end_lat", "end_lng")}
        return base.unionByName(again).drop("event_id").withColumns(empty)

    @cached_property
    def raw_weather(self) -> DataFrame:
        base = self.events.selectExpr(
            "event_id",
            "case when event_id % 97 = 0 then ' ' else concat('USW', event_id % 2) end as noaa_station_id",
            "case when event_id % 193 = 0 then null"
            " else replace(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' ', 'T') end as observation_ts",
            "case user_id % 5 when 0 then 'FM-15' when 1 then 'FM-16' when 2 then 'FM-12' when 3 then 'SOD'"
            " else null end as report_type",
            "case when event_id % 71 = 0 then 'T' else cast(cast(floor(value) as bigint) as string) end"
            " as hourly_dry_bulb_temperature",
            "case when event_id % 5 = 0 then concat('0.', event_id % 10) else null end as hourly_precipitation",
            "concat('-', event_id % 30) as hourly_wind_speed",
            "case event_type when 'purchase' then 'SN' when 'error' then 'FG' else '' end"
            " as hourly_present_weather_type",
            "case when event_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code",
            "'w1' as source_file",
            "event_id * 2 + 1 as source_row_number",
            "'check' as load_run_id",
        )
        again = base.filter("event_id % 50 = 0").withColumn("source_row_number", F.expr("event_id * 2 + 2"))
        return base.unionByName(again).drop("event_id")

    @cached_property
    def raw_stations(self) -> DataFrame:
        base = self.customer.selectExpr(
            "c_custkey",
            "case when c_custkey % 27 = 0 then ' ' else concat('g', c_custkey) end as gbfs_station_id",
            "c_name as station_name",
            "case when c_custkey % 9 = 0 then '' else concat('ST', c_custkey) end as short_name",
            "concat(c_custkey * 7 % 190, '.25') as longitude",
            "case when c_custkey % 31 = 0 then 'north' else concat(c_custkey % 97, '.5') end as latitude",
            "case when c_custkey % 7 = 0 then 'x12' when c_custkey % 13 = 0 then ' ' else cast(c_nationkey as string)"
            " end as capacity",
            "'classic' as station_type",
            "cast(c_nationkey as string) as region_id",
            "case when c_custkey % 2 = 0 then 'CHI' when c_custkey % 41 = 0 then ' ' else 'NYC' end as source_city_code",
            "'s1' as source_file",
            "c_custkey * 2 + 1 as source_row_number",
            "'check' as load_run_id",
        )
        again = base.filter("c_custkey % 10 = 0").withColumn("source_row_number", F.expr("c_custkey * 2 + 2"))
        return base.unionByName(again).drop("c_custkey")

    @cached_property
    def changes(self) -> DataFrame:
        """Change log with one row per customer and day."""
        return self.orders.groupBy("o_custkey", F.col("o_orderdate").alias("ts")).agg(
            F.max("o_orderpriority").alias("priority")
        )


CTES = {
    "trips": """
select e.*, case when ended_at >= started_at
    then ((epoch_us(ended_at) - epoch_us(started_at) + 300000) // 600000) / 100.0 end as duration_minutes
from (
  select b.*, case when event_type = 'error' then null
      when event_id % 53 = 0 then started_at - interval 90 seconds
      else started_at + to_seconds(floor(value * 60)::bigint) end as ended_at
  from (
    select event_id, value, event_type, cast(event_id as varchar) as ride_id,
      case when user_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code,
      1 + user_id % 2 as city_sk,
      ts + to_months(((event_id // 7) % 5)::int) as started_at,
      case when event_id % 29 = 0 then null else 'S' || (user_id % 20) end as start_station_id,
      case when event_id % 11 = 0 then null else 'S' || (event_id % 25) end as end_station_id,
      case when user_id % 3 = 0 then 'casual' else 'member' end as member_casual,
      case when event_type in ('view', 'click') then 'electric_bike' else 'classic_bike' end as rideable_type,
      ts as loaded_at
    from events) b) e""",
    "stations": """
select city_sk * 1000 + cast(substr(source_station_id, 2) as bigint) as station_sk, city_sk, source_station_id,
  'Station ' || substr(source_station_id, 2) as station_name,
  10 + cast(substr(source_station_id, 2) as bigint) % 20 as capacity, 'open' as station_status
from (select city_sk, start_station_id as source_station_id from trips
      union select city_sk, end_station_id from trips) u
where source_station_id is not null and source_station_id not in ('S7', 'S21')""",
    "resolved": """
select t.*, a.station_sk as start_station_sk, b.station_sk as end_station_sk
from trips t
left join stations a on a.city_sk = t.city_sk and a.source_station_id = t.start_station_id
left join stations b on b.city_sk = t.city_sk and b.source_station_id = t.end_station_id""",
    "nds_trips": """
select * from resolved
where not (start_station_id is not null and start_station_sk is null)
  and not (end_station_id is not null and end_station_sk is null)""",
    "city": """
select distinct source_city_code as city_code,
  case source_city_code when 'CHI' then 'Chicago' else 'New York City' end as city_name,
  case source_city_code when 'CHI' then 'America/Chicago' else 'America/New_York' end as timezone,
  case source_city_code when 'CHI' then 'USW00014819' else 'USW00094728' end as noaa_station_id,
  case source_city_code when 'CHI' then 'divvy' else 'citibike' end as gbfs_system_id,
  city_sk from trips""",
    "stg_weather": """
select case when event_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code, 1 + event_id % 2 as city_sk, event_id,
  ts + to_months(((event_id // 7) % 5)::int) as observation_ts,
  case user_id % 4 when 0 then 'FM-15' when 1 then 'FM-16' when 2 then 'FM-12' else 'SOD' end as report_type,
  value as temperature_c,
  case when event_id % 5 = 0 then floor(value) / 100 else 0.0 end as precipitation_mm,
  (event_id % 30)::double as wind_speed_ms,
  case event_type when 'purchase' then 'sn' when 'error' then 'FG' when 'click' then '-RA'
    when 'signup' then 'TS' else '' end as present_weather
from events""",
    "weather": """
select city_sk, observation_hour, report_type, temperature_c, precipitation_mm, wind_speed_ms, present_weather,
  case when present_weather = 'sn' then 'Snow' when present_weather = 'FG' then 'Fog'
    when present_weather in ('-RA', 'TS') or precipitation_mm > 0 then 'Rain' else 'Clear' end as weather_category
from (select *, date_trunc('hour', observation_ts) as observation_hour,
        row_number() over (partition by city_sk, date_trunc('hour', observation_ts)
          order by case report_type when 'FM-15' then 1 when 'FM-16' then 2 when 'FM-12' then 3 else 4 end,
            observation_ts, event_id) as rn
      from stg_weather) w where rn = 1""",
    "legs": """
select city_sk, start_station_id as source_station_id, date_trunc('hour', started_at) as date_hour, 1 as is_start,
  member_casual, rideable_type, duration_minutes
from nds_trips where start_station_sk is not null
union all
select city_sk, end_station_id, date_trunc('hour', ended_at), 0, member_casual, rideable_type, duration_minutes
from nds_trips where end_station_sk is not null and ended_at is not null""",
    "balance": """
select city_sk, source_station_id, date_hour, trips_started, trips_ended,
  trips_ended - trips_started as net_flow, abs(trips_ended - trips_started) as abs_imbalance,
  member_trip_count, casual_trip_count, electric_trip_count, classic_trip_count,
  ((2 * mc + member_trip_count) // nullif(2 * member_trip_count, 0)) / 100.0 as avg_duration_member_minutes,
  ((2 * cc + casual_trip_count) // nullif(2 * casual_trip_count, 0)) / 100.0 as avg_duration_casual_minutes
from (
  select city_sk, source_station_id, date_hour,
    count(*) filter (is_start = 1) as trips_started, count(*) filter (is_start = 0) as trips_ended,
    count(*) filter (is_start = 1 and member_casual = 'member') as member_trip_count,
    count(*) filter (is_start = 1 and member_casual = 'casual') as casual_trip_count,
    count(*) filter (is_start = 1 and rideable_type = 'electric_bike') as electric_trip_count,
    count(*) filter (is_start = 1 and rideable_type = 'classic_bike') as classic_trip_count,
    sum(round(duration_minutes * 100)::bigint) filter (is_start = 1 and member_casual = 'member') as mc,
    sum(round(duration_minutes * 100)::bigint) filter (is_start = 1 and member_casual = 'casual') as cc
  from legs group by all) g""",
    "span": """
select least(min(started_at), min(ended_at))::date as first_day,
  greatest(max(started_at), max(ended_at))::date as last_day from trips""",
    "dim_datetime": """
select year(d) * 1000000 + month(d) * 10000 + day(d) * 100 + h as datetime_sk, d::date as date, h as hour,
  isodow(d) as day_of_week, isodow(d) >= 6 as is_weekend, isodow(d) <= 5 and h in (7, 8, 17, 18) as is_peak_hour,
  year(d) as year, quarter(d) as quarter, month(d) as month, monthname(d) as month_name,
  case when month(d) in (12, 1, 2) then 'winter' when month(d) <= 5 then 'spring'
    when month(d) <= 8 then 'summer' else 'fall' end as season
from (select unnest(generate_series(first_day::timestamp, last_day::timestamp, interval 1 day)) as d from span) s,
  (select unnest(range(24)) as h) t""",
    "dim_weather": """
select * from (values (1, 'Clear', 'none'), (2, 'Rain', 'light_moderate'), (3, 'Snow', 'snow'), (4, 'Fog', 'none'))
  v(weather_condition_sk, weather_category, precipitation_band)""",
    "fact_rows": """
select b.*, coalesce(temperature_c, 0) as temperature, coalesce(precipitation_mm, 0) as precipitation,
  coalesce(wind_speed_ms, 0) as wind_speed, coalesce(weather_category, 'Clear') as weather_category
from balance b left join weather w on w.city_sk = b.city_sk and w.observation_hour = b.date_hour""",
    "star": """
select f.*, dt.*, s.station_sk, s.station_status, s.capacity, c.city_code, c.city_name, w.weather_condition_sk,
  w.precipitation_band
from fact_rows f
join dim_datetime dt on dt.datetime_sk = year(date_hour) * 1000000 + month(date_hour) * 10000
  + day(date_hour) * 100 + hour(date_hour)
join stations s on s.city_sk = f.city_sk and s.source_station_id = f.source_station_id
join city c on c.city_sk = f.city_sk
join dim_weather w on w.weather_category = f.weather_category""",
    "raw_trips1": """
select event_id, case when event_id % 197 = 0 then null when event_id % 97 = 0 then '  '
    else ' ' || event_id || case when event_id % 3 = 0 then ' ' else '' end end as ride_id,
  case when event_type in ('view', 'click') then 'electric_bike' else ' classic_bike ' end as rideable_type,
  case when event_id % 89 = 0 then '2024/01/01' when event_id % 101 = 0 then '2024-13-01 00:00:00'
    else strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as started_at,
  case when event_type = 'error' then '' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as ended_at,
  case when event_id % 83 = 0 or event_id % 79 = 0 then '  ' else 'S' || (user_id % 20) end as start_station_id,
  case when event_id % 83 = 0 then null else 'S' || (event_id % 25) end as end_station_id,
  case when user_id % 3 = 0 then 'casual' else 'member' end as member_casual,
  case when user_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code,
  case when event_id % 73 = 0 then '2024-01' else strftime(ts, '%Y%m') end as trip_month,
  'f' || (event_id % 7) as source_file
from events""",
    "raw_trips": """
select *, event_id * 2 + 1 as source_row_number from raw_trips1
union all select *, event_id * 2 + 2 from raw_trips1 where event_id % 50 = 0""",
    "raw_weather1": """
select event_id, case when event_id % 97 = 0 then ' ' else 'USW' || (event_id % 2) end as noaa_station_id,
  case when event_id % 193 = 0 then null else strftime(ts, '%Y-%m-%dT%H:%M:%S') end as observation_ts,
  case user_id % 5 when 0 then 'FM-15' when 1 then 'FM-16' when 2 then 'FM-12' when 3 then 'SOD' else null end
    as report_type,
  case when event_id % 71 = 0 then 'T' else floor(value)::bigint::varchar end as hourly_dry_bulb_temperature,
  case when event_id % 5 = 0 then '0.' || (event_id % 10) else null end as hourly_precipitation,
  '-' || (event_id % 30) as hourly_wind_speed,
  case event_type when 'purchase' then 'SN' when 'error' then 'FG' else '' end as hourly_present_weather_type,
  case when event_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code
from events""",
    "raw_weather": """
select *, event_id * 2 + 1 as source_row_number from raw_weather1
union all select *, event_id * 2 + 2 from raw_weather1 where event_id % 50 = 0""",
    "raw_stations1": """
select c_custkey, case when c_custkey % 27 = 0 then ' ' else 'g' || c_custkey end as gbfs_station_id,
  c_name as station_name, case when c_custkey % 9 = 0 then '' else 'ST' || c_custkey end as short_name,
  (c_custkey * 7 % 190) || '.25' as longitude,
  case when c_custkey % 31 = 0 then 'north' else (c_custkey % 97) || '.5' end as latitude,
  case when c_custkey % 7 = 0 then 'x12' when c_custkey % 13 = 0 then ' ' else c_nationkey::varchar end as capacity,
  'classic' as station_type, c_nationkey::varchar as region_id,
  case when c_custkey % 2 = 0 then 'CHI' when c_custkey % 41 = 0 then ' ' else 'NYC' end as source_city_code
from customer""",
    "raw_stations": """
select *, c_custkey * 2 + 1 as source_row_number from raw_stations1
union all select *, c_custkey * 2 + 2 from raw_stations1 where c_custkey % 10 = 0""",
    "changes": """
select o_custkey, o_orderdate as ts, max(o_orderpriority) as priority from orders group by all""",
    "versions": """
select o_custkey, priority, ts as effective_from,
  lead(ts) over (partition by o_custkey order by ts) as effective_to,
  row_number() over (partition by o_custkey order by ts) as version
from (select *, lag(priority) over (partition by o_custkey order by ts) as prev from changes) c
where prev is distinct from priority""",
}


def with_sql(sql: str, **extra: str) -> str:
    """Put the definitions a query refers to in front of it."""
    texts = {**CTES, **extra}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in texts:
            if name not in needed and re.search(rf"\b(?:from|join|,)\s+{name}\b", text):
                visit(texts[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    parts = ",\n".join(f"{n} as ({texts[n].strip()})" for n in needed)
    return f"with {parts}\n{sql.strip()}"


def present(df: DataFrame) -> DataFrame:
    """Uniform output types, so that both engines are compared by value."""
    shown = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.substring(c.cast("string"), 1, 19)  # no time zone involved
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        shown.append(c.alias(f.name))
    return df.select(*shown)


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def num(expr: str) -> str:
    return f"round(({expr})::double, 6)"
