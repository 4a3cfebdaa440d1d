"""Checks of joins, aggregations, upserts, dimensions, increments, matching and audits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.registry import check
from tidemark.checks.views import CTX, FIRST_LOAD, SECOND_LOAD, Tables, day, num, ts
from tidemark.functions import measures
from tidemark.operators import audit, cdc, dedup, dims, flow, incremental, keyindex, keys, leakage, lookup, match, reconcile, rules
from tidemark.operators import scd, snapshots, upsert
from tidemark.plans import bike, loads
from tidemark.session import materialize, scratch_path

GRAIN = flow.GRAIN
FIRST = "timestamp '2024-01-20 00:00:00'"
BEFORE = "loaded_at <= timestamp_ntz '2024-01-20 00:00:00'"
AFTER = "loaded_at > timestamp_ntz '2024-01-20 00:00:00'"

# ---- joins ----


@check("jn_lookup", "select ride_id, start_station_sk, end_station_sk from resolved")
def _(t: Tables):
    out = t.trips
    for end in ("start", "end"):
        ids = {"city_sk": "city_sk", f"{end}_station_id": "source_station_id"}
        out = lookup.lookup(out, t.stations, ids, {"station_sk": f"{end}_station_sk"}, salts=4)
    return out.select("ride_id", "start_station_sk", "end_station_sk")


def versions(t: Tables) -> DataFrame:
    return scd.scd2_from_changes(t.changes, ["o_custkey"], ["priority"], "ts", long_keys=True)


@check(
    "jn_lookup_current",
    "select c_custkey, priority, version from customer left join (select * from versions where effective_to is null) v"
    " on o_custkey = c_custkey",
)
def _(t: Tables):
    ids = {"c_custkey": "o_custkey"}
    return lookup.lookup_current(t.customer, versions(t), ids, ["priority", "version"]).select(
        "c_custkey", "priority", "version"
    )


@check(
    "jn_lookup_top1",
    "select l_orderkey, l_linenumber, l_partkey, priority from lineitem left join (select * from (select o_custkey,"
    " priority, row_number() over (partition by o_custkey order by (version = 2) desc, effective_from desc) as rn"
    " from versions) x where rn = 1) v on v.o_custkey = l_suppkey * 7",
)
def _(t: Tables):
    marked = versions(t).withColumn("is_current", F.col("version") == 2)
    lines = t.lineitem.withColumn("k", F.col("l_suppkey") * 7)
    return lookup.lookup_best(lines, marked, {"k": "o_custkey"}, ["priority"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "priority"
    )


ASOF = (
    "select l_orderkey, l_linenumber, l_partkey, version from (select l.*, o_custkey from lineitem l join orders on"
    " o_orderkey = l_orderkey) l left join versions v on v.o_custkey = l.o_custkey and l_shipdate >= effective_from"
    " and l_shipdate < coalesce(effective_to, timestamp '9999-12-31')"
)


def shipped(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_custkey"
    )


@check("jn_asof", ASOF)
def _(t: Tables):
    found = lookup.scd2_lookup(shipped(t), versions(t), ["o_custkey"], "l_shipdate", ["version"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "version")


@check("jn_asof_months", ASOF)
def _(t: Tables):
    """The same with versions repeated by month."""
    found = lookup.scd2_lookup(
        shipped(t), versions(t), ["o_custkey"], "l_shipdate", ["version"], slice_months=True, bounds=t.lineitem
    )
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "version")


@check("jn_asof_merge", ASOF)
def _(t: Tables):
    """The same by merging both sides in ranges of key and time."""
    found = lookup.merge_asof(shipped(t), materialize(versions(t), "versions"), ["o_custkey"], "l_shipdate", ["version"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "version")


@check(
    "jn_inner",
    f"select o_orderpriority, count(*) as n, {num('sum(l_quantity)')} as qty from lineitem join orders on"
    " l_orderkey = o_orderkey group by 1",
)
def _(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@check(
    "jn_left",
    f"select b.city_sk, source_station_id, {ts('date_hour')} as date_hour, trips_started, weather_category"
    " from balance b left join weather w on w.city_sk = b.city_sk and observation_hour = date_hour",
)
def _(t: Tables):
    return flow.add_weather(t.balance, t.weather, "unknown").select(
        *GRAIN, "trips_started", F.nullif("weather_category", F.lit("Unknown")).alias("weather_category")
    )


# Each supplier in two spellings, of which the smaller name matches nothing where the key is 2 modulo 9.
SPELLED = """
select case s_suppkey % 3 when 0 then cast(s_suppkey as varchar) when 1 then 'X' || s_suppkey
    else 'Y' || s_suppkey end as entity_id, s_nationkey as city,
  case when n = 1 then 'A none ' || s_suppkey when s_suppkey % 9 = 5 then null when s_suppkey % 9 = 8
    then 'none ' || s_suppkey else upper(s_name) || ' !' end as entity_name
from supplier, (values (0), (1)) v(n)"""
ENTITY_SQL = f"""
select entity_id, entity_name, city, id_key, id_name, name_key, name_name from ({SPELLED}) e
left join (select cast(s_suppkey as varchar) as mid, s_nationkey as mc, cast(s_suppkey as varchar) as id_key,
    s_name as id_name from supplier) a on a.mid = e.entity_id and a.mc = e.city
left join (select s_nationkey as nc, upper(s_name) as nk, min(cast(s_suppkey as varchar)) as name_key,
    s_name as name_name from supplier group by all) b on b.nc = e.city and b.nk || ' !' = e.entity_name"""


def suppliers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Named rows and a master; some master rows lack their key."""
    known = t.supplier.select(
        F.col("s_nationkey").alias("city"),
        F.col("s_suppkey").cast("string").alias("short_name"),
        F.concat(F.lit("feed"), "s_suppkey").alias("feed_id"),
        F.col("s_name").alias("station_name"),
    )
    master = known.unionByName(known.withColumns({"short_name": F.lit(None).cast("string"), "feed_id": F.lit(None).cast("string")}))
    named = t.supplier.selectExpr(
        "s_nationkey as city",
        "case s_suppkey % 3 when 0 then cast(s_suppkey as string) when 1 then concat('X', s_suppkey)"
        " else concat('Y', s_suppkey) end as id",
        "concat('A none ', s_suppkey) as one",
        "case when s_suppkey % 9 = 5 then null when s_suppkey % 9 = 8 then concat('none ', s_suppkey)"
        " else concat(upper(s_name), ' !') end as two",
    )
    found = match.entities(named, [{"id": "id", "name": "one"}, {"id": "id", "name": "two"}], ["city"])
    return found, master


def matched(t: Tables) -> DataFrame:
    """The best spelling of each entity."""
    return match.best_spelling(every_match(t), ["city"])


def every_match(t: Tables) -> DataFrame:
    found, master = suppliers(t)
    return match.match_entities(found, master, "city", ["short_name", "feed_id"], "short_name", "station_name")


EVERY_SQL = f"""
select city, entity_id, entity_name, coalesce(id_key, name_key) as candidate_master_key,
  coalesce(id_name, name_name) as candidate_master_name,
  case when id_key is not null then 'EXACT_ID' when name_key is not null then 'NORMALIZED_NAME' else 'UNMATCHED' end
    as match_method from ({ENTITY_SQL}) m"""
MATCH_SQL = f"""
select * exclude (rn) from (select *, row_number() over (partition by city, entity_id order by
    case match_method when 'EXACT_ID' then 1 when 'NORMALIZED_NAME' then 2 else 3 end, entity_name nulls last) as rn
  from ({EVERY_SQL}) e) r where rn = 1"""


@check("jn_left_lateral", EVERY_SQL)
def _(t: Tables):
    return every_match(t)


@check(
    "jn_cross",
    f"select {day('d')} as d, h, n from (select distinct o_orderdate::date as d from orders) a,"
    " (select hour(ts) as h, count(*) as n from events group by 1) b",
)
def _(t: Tables):
    days = t.orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    hours = t.events.groupBy(F.hour("ts").alias("h")).agg(F.count(F.lit(1)).alias("n"))  # at most 24 rows
    return days.crossJoin(hours)


@check(
    "jn_anti",
    "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)",
)
def _(t: Tables):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return upsert.delete_matching(t.orders, lines, ["o_orderkey"]).select("o_orderkey")


@check("jn_semi", "select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem)")
def _(t: Tables):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return upsert.matching(t.orders, lines, ["o_orderkey"]).select("o_orderkey")


@check(
    "jn_lateral_unpivot",
    "select name, n from (select count(*) filter (l_returnflag = 'A') as a, count(*) filter (l_linestatus = 'F') as f,"
    " count(*) filter (l_tax > 0.05) as t from lineitem) m, lateral (values ('returned', a), ('filled', f),"
    " ('taxed', t)) v(name, n)",
)
def _(t: Tables):
    row = t.lineitem.agg(
        F.count_if(F.col("l_returnflag") == "A").alias("returned"),
        F.count_if(F.col("l_linestatus") == "F").alias("filled"),
        F.count_if(F.col("l_tax") > 0.05).alias("taxed"),
    )
    return row.unpivot([], ["returned", "filled", "taxed"], "name", "n")


STAR_COLUMNS = "datetime_sk, station_sk, city_code, weather_category, trips_started, net_flow, is_peak_hour, month"


@check("jn_star", f"select {STAR_COLUMNS} from star")
def _(t: Tables):
    return t.star.select(*STAR_COLUMNS.split(", "))


@check(
    "jn_dashboard",
    "select city_name, month_name, precipitation_band, sum(trips_started)::bigint as trips_started from star"
    " group by all",
)
def _(t: Tables):
    return t.star.groupBy("city_name", "month_name", "precipitation_band").agg(
        F.sum("trips_started").alias("trips_started")
    )


# ---- aggregations ----


@check(
    "ag_count_filter",
    "select l_suppkey, count(*) as n, count(*) filter (l_returnflag = 'R') as returned,"
    " count(*) filter (l_quantity > 25) as large from lineitem group by 1",
)
def _(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_quantity") > 25).alias("large"),
    )


BALANCE = (
    "trips_started, trips_ended, net_flow, abs_imbalance, member_trip_count, casual_trip_count, electric_trip_count,"
    " classic_trip_count, round(avg_duration_member_minutes, 6) as avg_duration_member_minutes,"
    " round(avg_duration_casual_minutes, 6) as avg_duration_casual_minutes"
)


@check("ag_flow", f"select city_sk, source_station_id, {ts('date_hour')} as date_hour, {BALANCE} from balance")
def _(t: Tables):
    return t.balance


@check(
    "ag_flow_weather",
    f"select city_sk, source_station_id, {ts('date_hour')} as date_hour, {BALANCE}, {num('temperature')} as temperature,"
    f" {num('precipitation')} as precipitation, {num('wind_speed')} as wind_speed, weather_category from fact_rows",
)
def _(t: Tables):
    return flow.add_weather(t.balance, t.weather)


@check(
    "ag_sum_filter",
    "select l_shipmonth, round(r / nullif(a, 0), 6) as share from (select strftime(l_shipdate, '%Y-%m') as l_shipmonth,"
    " sum(l_quantity) filter (l_returnflag = 'R') as r, sum(l_quantity) filter (l_returnflag = 'A') as a from lineitem"
    " group by 1) x",
)
def _(t: Tables):
    def total(flag):
        return F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))

    return t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("l_shipmonth")).agg(
        measures.ratio(total("R"), total("A")).alias("share")
    )


@check(
    "ag_avg_filter",
    "select l_suppkey, round(avg(l_quantity) filter (l_returnflag = 'R') - avg(l_quantity) filter (l_returnflag = 'A'),"
    " 6) as diff from lineitem group by 1",
)
def _(t: Tables):
    def mean(flag):
        return F.avg(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))

    return t.lineitem.groupBy("l_suppkey").agg((mean("R") - mean("A")).alias("diff"))


@check(
    "ag_having",
    "select l_orderkey, count(*) filter (l_discount > 0.05) as n from lineitem group by 1 having"
    " count(*) filter (l_discount > 0.05) > 3",
)
def _(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(F.count_if(F.col("l_discount") > 0.05).alias("n")).filter("n > 3")


@check(
    "ag_minmax",
    "select count(*) as n, count(avg_duration_member_minutes) as members,"
    " round(min(avg_duration_member_minutes), 6) as lo, round(max(avg_duration_casual_minutes), 6) as hi from balance",
)
def _(t: Tables):
    return t.balance.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("avg_duration_member_minutes").alias("members"),
        F.min("avg_duration_member_minutes").alias("lo"),
        F.max("avg_duration_casual_minutes").alias("hi"),
    )


FILE_COUNTS = (
    "select source_file as source_name, count(*) as total_rows_count, count(*) filter (length(trip_month) = 6)"
    " as success_rows_count, count(*) filter (length(trip_month) <> 6) as failed_rows_count from raw_trips group by 1"
)


def file_counts(t: Tables) -> DataFrame:
    good = F.length("trip_month") == 6
    return t.raw_trips.groupBy(F.col("source_file").alias("source_name")).agg(
        F.count(F.lit(1)).alias("total_rows_count"),
        F.count_if(good).alias("success_rows_count"),
        F.count_if(~good).alias("failed_rows_count"),
    )


@check(
    "ag_group_sum",
    "select sum(total_rows_count)::bigint as total_rows_count, sum(success_rows_count)::bigint as success_rows_count,"
    f" sum(failed_rows_count)::bigint as failed_rows_count from ({FILE_COUNTS}) f",
)
def _(t: Tables):
    return audit.sum_counts(file_counts(t))


@check(
    "ag_grouping_sets",
    "select coalesce(m, 'YTD') as period, count(*) as n, round(avg(l_quantity), 6) as avg_qty from (select *,"
    " strftime(l_shipdate, '%Y-%m') as m from lineitem) x group by grouping sets ((m), ())",
)
def _(t: Tables):
    m = t.lineitem.withColumn("m", F.date_format("l_shipdate", "yyyy-MM"))
    out = m.groupingSets([[F.col("m")], []], "m").agg(
        F.grouping("m").alias("g"), F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("avg_qty")
    )
    return out.select(F.when(F.col("g") == 1, "YTD").otherwise(F.col("m")).alias("period"), "n", "avg_qty")


@check(
    "ag_total_rows",
    "select 'customer' as table_name, count(*) as row_count from customer union all select 'orders', count(*) from"
    " orders union all select 'lineitem', count(*) from lineitem union all select 'balance', count(*) from balance",
)
def _(t: Tables):
    return audit.total_rows(
        {"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem, "balance": t.balance}
    )


def hash_sql(rel: str, group: str, pairs: list[tuple[str, str]]) -> str:
    """Fingerprint per group; pairs give column name and its JSON text."""
    fields = " || ',' || ".join(f"'\"{n}\":' || coalesce({e}, 'null')" for n, e in pairs)
    sums = " || ':' || ".join(f"sum(('0x' || substr(h, {at}, 11))::bigint::hugeint)::varchar" for at in (1, 12, 23))
    return (
        f"select {group}, count(*) as row_count, md5(count(*)::varchar || ':' || {sums}) as fingerprint"
        f" from (select *, md5('{{' || {fields} || '}}') as h from {rel}) x group by 1"
    )


@check(
    "ag_hash_sum",
    hash_sql(
        "lineitem",
        "l_returnflag",
        [("l_orderkey", "l_orderkey::varchar"), ("l_linenumber", "l_linenumber::varchar"),
         ("l_linestatus", "'\"' || l_linestatus || '\"'")],
    ),
)
def _(t: Tables):
    cols = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_linestatus")
    return cdc.fingerprint(cols, ["l_returnflag"])


# ---- upserts and keys ----


def two_loads(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Trips of the first load, and a second load that repeats, changes and adds trips."""
    cols = ["city_sk", "ride_id", "rideable_type", "start_station_id", "loaded_at"]
    first = t.trips.filter(BEFORE).select(*cols)
    late = F.col("loaded_at") > F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    second = t.trips.filter(late).select(
        "city_sk",
        "ride_id",
        F.when(F.col("member_casual") == "casual", "cargo_bike").otherwise(F.col("rideable_type")).alias("rideable_type"),
        "start_station_id",
        F.lit(str(SECOND_LOAD)).cast("timestamp_ntz").alias("loaded_at"),
    )
    order = ["loaded_at", "rideable_type", "start_station_id"]
    return upsert.one_per_key(first, TRIP_KEY, order), upsert.one_per_key(second, TRIP_KEY, order)


LOADS = {
    "first_load": f"select city_sk, ride_id, rideable_type, start_station_id, loaded_at from trips"
    f" where loaded_at <= {FIRST}",
    "second_load": "select city_sk, ride_id, case when member_casual = 'casual' then 'cargo_bike' else rideable_type end"
    " as rideable_type, start_station_id, timestamp '2024-02-01' as loaded_at from trips"
    " where loaded_at > timestamp '2024-01-15'",
}
TRIP_KEY = ["city_sk", "ride_id"]


@check(
    "up_upsert",
    f"""select coalesce(a.city_sk, b.city_sk) as city_sk, coalesce(a.ride_id, b.ride_id) as ride_id,
  case when b.ride_id is null then a.rideable_type else b.rideable_type end as rideable_type,
  case when b.ride_id is null then a.start_station_id else b.start_station_id end as start_station_id,
  {ts('case when b.ride_id is null then a.loaded_at else b.loaded_at end')} as loaded_at
from first_load a full join second_load b on a.city_sk = b.city_sk and a.ride_id = b.ride_id""",
    **LOADS,
)
def _(t: Tables):
    first, second = two_loads(t)
    return upsert.upsert(first, second, TRIP_KEY)


@check(
    "up_upsert_stats",
    """select case when a.ride_id is null then 'insert' when b.ride_id is null then 'kept'
    when a.rideable_type is distinct from b.rideable_type then 'update' else 'unchanged' end as action,
  count(*) as n_rows from first_load a full join second_load b on a.city_sk = b.city_sk and a.ride_id = b.ride_id
group by 1""",
    **LOADS,
)
def _(t: Tables):
    first, second = two_loads(t)
    return upsert.upsert_stats(first, second, TRIP_KEY, insert_only=["loaded_at"])


@check(
    "up_insert_only_col",
    f"""select coalesce(a.city_sk, b.city_sk) as city_sk, coalesce(a.ride_id, b.ride_id) as ride_id,
  coalesce(b.rideable_type, a.rideable_type) as rideable_type,
  {ts('coalesce(a.loaded_at, b.loaded_at)')} as loaded_at
from first_load a full join second_load b on a.city_sk = b.city_sk and a.ride_id = b.ride_id""",
    **LOADS,
)
def _(t: Tables):
    first, second = two_loads(t)
    return upsert.upsert(first, second, TRIP_KEY, insert_only=["loaded_at"]).drop("start_station_id")


@check(
    "up_delete_keys",
    "select ride_id from trips where not exists (select 1 from nds_trips n where n.city_sk = trips.city_sk"
    " and n.ride_id = trips.ride_id)",
)
def _(t: Tables):
    staged = t.trips.drop("city_sk")
    return loads.cleanup_staged(staged, t.nds_trips, t.city).select("ride_id")


@check(
    "sk_allocate",
    "select c_custkey, case when c_acctbal < 5000 then c_custkey + 1 else (select max(c_custkey) + 1 from customer"
    " where c_acctbal < 5000) + row_number() over (partition by c_acctbal >= 5000"
    " order by substr(md5(c_custkey::varchar), 1, 3), c_custkey) end as customer_sk from customer",
)
def _(t: Tables):
    old = t.customer.filter("c_acctbal < 5000").select((F.col("c_custkey") + 1).alias("customer_sk"), "c_custkey")
    new = t.customer.filter("c_acctbal >= 5000").select("c_custkey")
    return old.unionByName(keys.allocate_keys(new, old, "customer_sk", ["c_custkey"]))


# ---- slowly changing dimensions ----


def half_year(t: Tables, cond: str) -> DataFrame:
    return t.changes.filter(cond).groupBy("o_custkey").agg(
        F.max_by("priority", "ts").alias("priority"), F.max("ts").alias("ts")
    )


EARLY = "ts < timestamp_ntz '2000-01-01 00:00:00'"
LATE = "ts >= timestamp_ntz '2000-01-01 00:00:00'"
HALVES = {
    "early": "select o_custkey, max_by(priority, ts) as priority, max(ts) as ts from changes"
    " where ts < timestamp '2000-01-01' group by 1",
    "late": "select o_custkey, max_by(priority, ts) as priority, max(ts) as ts from changes"
    " where ts >= timestamp '2000-01-01' group by 1",
}


@check(
    "scd1",
    f"select coalesce(b.o_custkey, a.o_custkey) as o_custkey, coalesce(b.priority, a.priority) as priority,"
    f" {ts('coalesce(a.ts, b.ts)')} as ts from early a full join late b on a.o_custkey = b.o_custkey",
    **HALVES,
)
def _(t: Tables):
    return scd.scd1(half_year(t, EARLY), half_year(t, LATE), ["o_custkey"], ["priority"])


@check(
    "scd_type3",
    "select coalesce(b.o_custkey, a.o_custkey) as o_custkey, coalesce(b.priority, a.priority) as priority,"
    " case when a.priority <> b.priority then a.priority end as prev_priority from early a full join late b"
    " on a.o_custkey = b.o_custkey",
    **HALVES,
)
def _(t: Tables):
    dim = half_year(t, EARLY).select("o_custkey", "priority", F.lit(None).cast("string").alias("prev_priority"))
    return scd.scd3(dim, half_year(t, LATE), ["o_custkey"], "priority")


VERSION_SQL = f"""
select o_custkey, priority, {ts('effective_from')} as effective_from, {ts('effective_to')} as effective_to,
  effective_to is null as is_current, version from versions"""


@check("scd2_rebuild", VERSION_SQL)
def _(t: Tables):
    return versions(t)


SCD2_APPLIED = """
select a.o_custkey, a.priority, timestamp '1900-01-01' as effective_from,
  case when b.priority <> a.priority then b.ts end as effective_to, b.priority is null or b.priority = a.priority
    as is_current, 1 as version from early a left join late b on a.o_custkey = b.o_custkey
union all
select b.o_custkey, b.priority, case when a.o_custkey is null then timestamp '1900-01-01' else b.ts end, null, true,
  case when a.o_custkey is null then 1 else 2 end from late b left join early a on a.o_custkey = b.o_custkey
where a.priority is distinct from b.priority"""


def empty_versions(t: Tables) -> DataFrame:
    schema = (
        "o_custkey bigint, priority string, effective_from timestamp_ntz, effective_to timestamp_ntz,"
        " is_current boolean, version bigint"
    )
    return t.spark.createDataFrame([], schema)


def applied(t: Tables) -> DataFrame:
    def load(dim: DataFrame, cond: str) -> DataFrame:
        return scd.scd2_apply(dim, half_year(t, cond), ["o_custkey"], ["priority"], "ts", scd.FIRST_FROM)

    return load(materialize(load(empty_versions(t), EARLY), "dim"), LATE)


@check(
    "scd2_apply",
    f"select o_custkey, priority, {ts('effective_from')} as effective_from, {ts('effective_to')} as effective_to,"
    f" is_current, version from ({SCD2_APPLIED}) v",
    **HALVES,
)
def _(t: Tables):
    return applied(t)


ERA = "case when year(o_orderdate) < 1997 then 1 when year(o_orderdate) < 1999 then 2 else 3 end"


@check(
    "scd2_late_change",
    f"""select o_custkey, priority, {ts('ts')} as effective_from, {ts('lead(ts) over w')} as effective_to,
  lead(ts) over w is null as is_current, row_number() over w as version
from (select o_custkey, 'era ' || era as priority, min(o_orderdate) as ts
  from (select *, {ERA} as era from orders) o group by o_custkey, era) c
window w as (partition by o_custkey order by ts)""",
)
def _(t: Tables):
    """The middle change arrives first, then the newest, then the oldest."""
    eras = t.orders.withColumn("era", F.expr(ERA)).groupBy("o_custkey", "era").agg(F.min("o_orderdate").alias("ts"))
    eras = eras.withColumn("priority", F.concat(F.lit("era "), F.col("era").cast("string")))
    dim = empty_versions(t)
    for era in (2, 3, 1):
        dim = materialize(scd.scd2_apply(dim, eras.filter(F.col("era") == era), ["o_custkey"], ["priority"], "ts"), "dim")
    return dim


@check(
    "scd2_keys",
    f"""select o_custkey, case era when 2 then 'era 2 fixed' else 'era ' || era end as priority,
  case era when 1 then 'third load' when 2 then 'first load' else 'second load' end as sk, {ts('ts')} as effective_from,
  {ts('lead(ts) over w')} as effective_to, row_number() over w as version
from (select *, min(o_orderdate) over (partition by o_custkey, era) as ts from (select *, {ERA} as era from orders) o)
  c group by o_custkey, era, ts
window w as (partition by o_custkey order by ts)""",
)
def _(t: Tables):
    """Newer, older and correcting changes: every version keeps the key of the load that brought it."""
    eras = t.orders.withColumn("era", F.expr(ERA)).groupBy("o_custkey", "era").agg(F.min("o_orderdate").alias("ts"))
    eras = materialize(eras.withColumn("priority", F.concat(F.lit("era "), F.col("era").cast("string"))), "eras")
    dim = empty_versions(t).withColumn("sk", F.lit(None).cast("string"))
    fixed = eras.withColumn("priority", F.concat("priority", F.lit(" fixed")))
    for load, era, changes in (("first", 2, eras), ("second", 3, eras), ("third", 1, eras), ("fourth", 2, fixed)):
        dim = scd.scd2_apply(dim, changes.filter(F.col("era") == era), ["o_custkey"], ["priority"], "ts", extra=["sk"])
        dim = materialize(dim.withColumn("sk", F.coalesce("sk", F.lit(f"{load} load"))), "dim")
    return dim.drop("is_current")


@check(
    "scd2_softclose",
    f"""select v.o_custkey, priority, case when is_current and g.o_custkey is not null then {ts("timestamp '2001-09-01'")}
    else {ts('effective_to')} end as effective_to, is_current and g.o_custkey is null as is_current, version
from ({SCD2_APPLIED}) v left join (select c_custkey as o_custkey from customer where c_mktsegment = 'MACHINERY') g
  on g.o_custkey = v.o_custkey""",
    **HALVES,
)
def _(t: Tables):
    # The customers of one segment leave.
    gone = t.customer.filter("c_mktsegment = 'MACHINERY'").select(
        F.col("c_custkey").alias("o_custkey"),
        F.lit("deleted").alias("row_status"),
        F.lit(False).alias("is_current"),
        F.lit("2001-09-01 00:00:00").cast("timestamp_ntz").alias("effective_to"),
    )
    others = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("o_custkey"),
        F.lit("active").alias("row_status"),
        F.lit(True).alias("is_current"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
    )
    closed = scd.scd2_close(applied(t), scd.deleted_only(gone.unionByName(others), ["o_custkey"]), ["o_custkey"])
    return closed.drop("effective_from")


@check(
    "scd_soft_delete",
    """select c.c_custkey, case when op <> 'DELETE' then c_mktsegment || ' new' else c_mktsegment end as segment,
  case when op = 'DELETE' then 'deleted' else 'active' end as row_status, op <> 'DELETE' as is_current,
  case when op = 'DELETE' then '2024-02-01 00:00:00' end as effective_to
from (select *, c_nationkey < 15 as known, case when c_acctbal < 2000 then 'DELETE' when c_acctbal < 6000 then 'UPDATE'
        else 'INSERT' end as op from customer) c where known or op <> 'DELETE'""",
)
def _(t: Tables):
    master = t.customer.filter("c_nationkey < 15").select(
        "c_custkey",
        F.col("c_mktsegment").alias("segment"),
        F.lit("active").alias("row_status"),
        F.lit(True).alias("is_current"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
    )
    kind = F.when(F.col("c_acctbal") < 2000, "DELETE").when(F.col("c_acctbal") < 6000, "UPDATE").otherwise("INSERT")
    ops = t.customer.select(
        "c_custkey",
        F.concat("c_mktsegment", F.lit(" new")).alias("segment"),
        kind.alias("operation"),
        F.lit(str(SECOND_LOAD)).cast("timestamp_ntz").alias("now"),
    )
    return scd.apply_operations(master, ops, ["c_custkey"], ["segment"], "now").drop("effective_from")


@check(
    "scd_late_skeleton",
    "select city_sk, source_station_id, station_name, false as is_skeleton from stations union all"
    " select city_sk, id, null, true from (select city_sk, start_station_id as id from trips union"
    " select city_sk, end_station_id from trips) u where id in ('S7', 'S21')",
)
def _(t: Tables):
    used = dedup.union_all(
        *[t.trips.select("city_sk", F.col(f"{e}_station_id").alias("source_station_id")) for e in ("start", "end")]
    )
    full = scd.add_skeletons(t.stations, used, ["city_sk", "source_station_id"])
    return full.select("city_sk", "source_station_id", "station_name", "is_skeleton")


PENDING = (
    "(start_station_id is not null and start_station_sk is null or end_station_id is not null"
    " and end_station_sk is null)"
)


@check("late_pending", f"select ride_id, {PENDING} as is_pending from resolved")
def _(t: Tables):
    ready, backlog = lookup.split_pending(t.resolved, loads.ID_TO_SK)
    return dedup.union_all(
        ready.select("ride_id", F.lit(False).alias("is_pending")),
        backlog.select("ride_id", F.lit(True).alias("is_pending")),
    )


@check(
    "late_reprocess",
    """select 'trip' as what, city_sk, ride_id as id, null as date_hour from resolved
where start_station_id = 'S7' or end_station_id = 'S7'
union all
select 'grain', city_sk, id, strftime(h, '%Y-%m-%d %H:%M:%S') from (
  select distinct city_sk, start_station_id as id, date_trunc('hour', started_at) as h from resolved
  where (start_station_id = 'S7' or end_station_id = 'S7') and start_station_id is not null and start_station_id <> 'S21'
  union
  select distinct city_sk, end_station_id, date_trunc('hour', ended_at) from resolved
  where (start_station_id = 'S7' or end_station_id = 'S7') and end_station_id is not null and end_station_id <> 'S21'
    and ended_at is not null) g""",
)
def _(t: Tables):
    # Station S7 arrives late; S21 is still unknown.
    s7 = t.trips.filter("start_station_id = 'S7' or end_station_id = 'S7'").select("city_sk").distinct().select(
        (F.col("city_sk") * 1000 + 7).cast("bigint").alias("station_sk"),
        "city_sk",
        F.lit("S7").alias("source_station_id"),
        F.lit(True).alias("is_current"),
        F.lit("2024-06-01 00:00:00").cast("timestamp_ntz").alias("effective_from"),
    )
    master = t.stations.unionByName(s7, allowMissingColumns=True)
    stored = t.resolved.withColumn("updated_at", F.col("loaded_at"))
    updates, grains = loads.reresolve(stored, master, CTX)
    a = updates.select(
        F.lit("trip").alias("what"), "city_sk", F.col("ride_id").alias("id"),
        F.lit(None).cast("timestamp_ntz").alias("date_hour"),
    )
    b = grains.select(F.lit("grain").alias("what"), "city_sk", F.col("source_station_id").alias("id"), "date_hour")
    return a.unionByName(b)


# ---- increments and change detection ----


@check(
    "inc_watermark",
    f"select event_type as source_name, {ts('max(ts)')} as lset, 3 as lookback_days from events group by 1",
)
def _(t: Tables):
    control = t.events.groupBy(F.col("event_type").alias("source_name")).agg(
        F.lit("events").alias("table_name"), F.max("ts").alias("lset"), F.lit(3).alias("lookback_days")
    )
    return incremental.watermarks(control).select("source_name", "lset", "lookback_days")


@check(
    "inc_window",
    "select event_id, 'open' as w from events where ts > timestamp '2024-01-10' and ts <= timestamp '2024-01-20'"
    " union all select event_id, 'back' from events where ts >= timestamp '2024-01-07' and"
    " ts <= timestamp '2024-01-20'",
)
def _(t: Tables):
    span = (datetime(2024, 1, 10), FIRST_LOAD)
    strict = incremental.incremental(t.events, "ts", *span)
    back = incremental.incremental(t.events, "ts", *span, lookback_days=3)
    return dedup.union_all(
        strict.select("event_id", F.lit("open").alias("w")), back.select("event_id", F.lit("back").alias("w"))
    )


@check(
    "inc_advance",
    f"""select event_type as source_name, 'events' as table_name,
  {ts("case when event_type = 'error' then timestamp '2024-01-01' else max(ts) end")} as lset, {ts('max(ts)')} as cet,
  case when event_type = 'error' then 'FAILED' else 'SUCCESS' end as status, count(*) as row_count
from events group by event_type""",
)
def _(t: Tables):
    by_type = t.events.groupBy(F.col("event_type").alias("source_name"))
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    control = by_type.agg(
        F.lit("events").alias("table_name"), stamp.alias("lset"), stamp.alias("cet"),
        F.lit("SUCCESS").alias("status"), F.lit(0).cast("bigint").alias("row_count"),
    )
    runs = by_type.agg(
        F.lit("events").alias("table_name"),
        F.max("ts").alias("cet"),
        F.when(F.max("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return incremental.advance_watermark(control, runs)


@check(
    "inc_affected_grain",
    f"select city_sk, source_station_id, {ts('date_hour')} as date_hour, {BALANCE} from balance",
)
def _(t: Tables):
    """The first load as a full build, then the touched grains only: equals a full build."""
    legs = materialize(flow.trip_legs(t.nds_trips, ["loaded_at"]), "legs")
    fact = flow.balance_legs(legs.filter(BEFORE))
    grains = materialize(legs.filter(AFTER).select(*GRAIN).distinct(), "grains")
    fresh = flow.balance_legs(legs.join(grains, GRAIN, "left_semi"))
    return incremental.replace_grains(fact, fresh, grains)


@check(
    "inc_refresh_fact",
    f"select city_sk, source_station_id, {ts('date_hour')} as date_hour, {BALANCE} from balance",
)
def _(t: Tables):
    """The same from trips, as the operators take them."""
    fact = flow.station_hour_balance(t.nds_trips.filter(BEFORE))
    grains = materialize(incremental.affected_grains(t.nds_trips.filter(AFTER)), "grains")
    return incremental.refresh_fact(fact, t.nds_trips, grains)


MONTH = "strftime(started_at, '%Y%m')"


@check(
    "ix_months_holding",
    f"select {MONTH} as trip_month, count(*) as rides from trips where {MONTH} in (select {MONTH} from trips"
    " where event_id % 397 = 5) group by 1",
)
def _(t: Tables):
    """The months that hold some of the given rides, named by the key index, and their rides."""
    stored = materialize(t.trips.select("city_sk", "ride_id", F.date_format("started_at", "yyyyMM").alias("trip_month")), "trips")
    index = materialize(keyindex.key_index(stored, ["city_sk", "ride_id"], ["trip_month"]), "keys")
    wanted = t.trips.filter("cast(ride_id as bigint) % 397 = 5")
    months = keyindex.parts_holding(index, wanted, ["city_sk", "ride_id"], ["trip_month"])
    return stored.join(months, "trip_month", "left_semi").groupBy("trip_month").agg(F.count(F.lit(1)).alias("rides"))


@check("ix_stored_versions", "select city_sk, ride_id from trips where event_id % 397 = 5")
def _(t: Tables):
    """Stored rows of rides whose new version says another month, read from the named months only."""
    stored = materialize(t.trips.select("city_sk", "ride_id", F.date_format("started_at", "yyyyMM").alias("trip_month")), "trips")
    index = keyindex.key_index(stored, ["city_sk", "ride_id"], ["trip_month"], 64)
    moved = t.trips.filter("cast(ride_id as bigint) % 397 = 5").select("city_sk", "ride_id")
    never = moved.select("city_sk", F.concat(F.lit("new"), "ride_id").alias("ride_id"))
    source = materialize(moved.unionByName(never), "source")
    months = keyindex.parts_holding(index, source, ["city_sk", "ride_id"], ["trip_month"], 64)
    return stored.join(months, "trip_month", "left_semi").join(source, ["city_sk", "ride_id"], "left_semi").drop("trip_month")


@check(
    "inc_upsert_fact",
    f"select city_sk, source_station_id, {ts('date_hour')} as date_hour, trips_started, trips_ended, net_flow,"
    f" case when new_legs > 0 then '2024-02-01 00:00:00' else '2024-01-20 00:00:00' end as seen_at from balance"
    " join (select city_sk as c, source_station_id as s, date_hour as h, count(*) filter (late) as new_legs from ("
    f" select city_sk, start_station_id as source_station_id, date_trunc('hour', started_at) as date_hour,"
    f" loaded_at > {FIRST} as late from nds_trips where start_station_sk is not null union all"
    f" select city_sk, end_station_id, date_trunc('hour', ended_at), loaded_at > {FIRST} from nds_trips"
    " where end_station_sk is not null and ended_at is not null) l group by 1, 2, 3) n"
    " on c = city_sk and s = source_station_id and h = date_hour",
)
def _(t: Tables):
    cols = [*GRAIN, "trips_started", "trips_ended", "net_flow", "seen_at"]

    def seen(df, at):
        return df.withColumn("seen_at", F.lit(str(at)).cast("timestamp_ntz")).select(*cols)

    legs = materialize(flow.trip_legs(t.nds_trips, ["loaded_at"]), "legs")
    fact = seen(flow.balance_legs(legs.filter(BEFORE)), FIRST_LOAD)
    grains = materialize(legs.filter(AFTER).select(*flow.GRAIN).distinct(), "grains")
    fresh = seen(flow.balance_legs(legs.join(grains, flow.GRAIN, "left_semi")), SECOND_LOAD)
    return upsert.upsert(fact, fresh, GRAIN)


PRINT_COLUMNS = ["source_file", "ride_id", "started_at", "start_station_id", "end_station_id", "trip_month"]


def quoted(c: str) -> str:
    return f"'\"' || {c} || '\"'"


PRINT_SQL = hash_sql("raw_trips", "source_file", [(c, quoted(c)) for c in PRINT_COLUMNS[1:]])
OLD_SQL = PRINT_SQL.replace(
    "from raw_trips", "from raw_trips where source_file <> 'f6' and (source_file <> 'f2' or started_at < '2024-01-20')"
)


def prints(df: DataFrame) -> DataFrame:
    return cdc.fingerprint(df.select(*PRINT_COLUMNS), ["source_file"])


def old_snapshot(t: Tables) -> DataFrame:
    """File f6 did not exist yet, file f2 has grown since."""
    return t.raw_trips.filter("source_file <> 'f6' and (source_file <> 'f2' or started_at < '2024-01-20')")


@check("cdc_fingerprint", PRINT_SQL)
def _(t: Tables):
    return prints(t.raw_trips)


CHANGE = (
    "case when o.fingerprint is null then 'NEW' when o.fingerprint = n.fingerprint then 'UNCHANGED' else 'CHANGED' end"
)


@check(
    "cdc_classify",
    f"select n.source_file, n.row_count, {CHANGE} as change_type from ({PRINT_SQL}) n left join ({OLD_SQL}) o"
    " on o.source_file = n.source_file",
)
def _(t: Tables):
    out = cdc.classify_change(prints(t.raw_trips), prints(old_snapshot(t)), ["source_file"])
    return out.select("source_file", "row_count", "change_type")


@check(
    "cdc_manifest",
    f"select 'manifest' as kind, source_file, fingerprint, '' as change_type, 1 as times from ({PRINT_SQL}) m"
    f" union all select 'log', n.source_file, n.fingerprint, {CHANGE}, 1 from ({PRINT_SQL}) n"
    f" left join ({OLD_SQL}) o on o.source_file = n.source_file"
    f" union all select 'log', source_file, fingerprint, 'NEW', 1 from ({OLD_SQL}) f",
)
def _(t: Tables):
    """Two loads: the manifest holds the last print of each file, the log every classified one."""
    from tidemark.session import scratch_path
    from tidemark.sources.sinks import write_append

    log, manifest = scratch_path(t.spark, "changes"), prints(t.raw_trips.limit(0))
    for snapshot in (old_snapshot(t), t.raw_trips):
        classified = materialize(cdc.classify_change(prints(snapshot), manifest, ["source_file"]), "classified")
        write_append(classified, log)
        manifest = materialize(cdc.update_manifest(manifest, classified, ["source_file"]), "manifest")
    shown = ["source_file", "fingerprint", "change_type"]
    kept = manifest.withColumn("change_type", F.lit("")).select(F.lit("manifest").alias("kind"), *shown)
    logged = t.spark.read.parquet(log).select(F.lit("log").alias("kind"), *shown)
    return dedup.union_all(kept, logged).groupBy("kind", *shown).agg(F.count(F.lit(1)).alias("times"))


@check(
    "cdc_deleted",
    "select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where"
    " l_shipdate >= timestamp '1998-01-01')",
)
def _(t: Tables):
    source = t.lineitem.filter("l_shipdate >= timestamp_ntz '1998-01-01 00:00:00'").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return cdc.detect_deleted(source, t.orders, ["o_orderkey"]).select("o_orderkey", "o_custkey")


ROW_DIFF = """select coalesce(a.ride_id, b.ride_id) as ride_id, coalesce(a.city_sk, b.city_sk) as city_sk,
  case when a.ride_id is null then 'INSERTED' when b.ride_id is null then 'DELETED' else 'CHANGED' end as change_type,
  case when a.ride_id is null or b.ride_id is null then '' else 'rideable_type' end as changed_columns
from first_load a full join second_load b on a.city_sk = b.city_sk and a.ride_id = b.ride_id
where a.ride_id is null or b.ride_id is null or a.rideable_type is distinct from b.rideable_type"""


@check(
    "cdc_row_hash",
    ROW_DIFF,
    **LOADS,
)
def _(t: Tables):
    first, second = two_loads(t)
    return cdc.diff_rows(first, second, TRIP_KEY, ["rideable_type", "start_station_id"])


@check("cdc_snapshot_diff", ROW_DIFF, **LOADS)
def _(t: Tables):
    """The same between stored snapshots, by the buckets whose digests differ."""
    stored = [
        snapshots.write_snapshot(load.select(*TRIP_KEY, "rideable_type", "start_station_id"), scratch_path(t.spark, "snapshot"), TRIP_KEY, 64)
        for load in two_loads(t)
    ]
    return snapshots.diff_snapshots(*stored, ["rideable_type", "start_station_id"])


@check("cdc_snapshot_deleted", "select o_orderkey, o_custkey from orders where o_orderkey % 911 = 7")
def _(t: Tables):
    """Rows that the second snapshot lacks."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    old = snapshots.write_snapshot(orders, scratch_path(t.spark, "snapshot"), ["o_orderkey"], 64)
    left = orders.filter("o_orderkey % 911 <> 7").orderBy(F.desc("o_custkey"))
    new = snapshots.write_snapshot(left, scratch_path(t.spark, "snapshot"), ["o_orderkey"], 64)
    return snapshots.deleted_rows(old, new)


@check(
    "cdc_schema_drift",
    "select 'ts' as column_name, 'RETYPED' as problem, 'timestamp -> timestamp_ntz' as detail, count(*) as row_count"
    " from events union all select 'country', 'MISSING', 'string', count(*) from events"
    " union all select 'props', 'EXTRA', 'string', count(*) from events",
)
def _(t: Tables):
    from pyspark.sql.types import StructType

    declared = StructType.fromDDL(
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, country string"
    )
    drift = cdc.schema_drift(t.events.schema, declared)
    found = t.spark.createDataFrame(drift, "column_name string, problem string, detail string")
    return found.crossJoin(t.events.agg(F.count(F.lit(1)).alias("row_count")))  # one row


# ---- matching ----


@check(
    "em_entities",
    """select distinct city, entity_id, name as entity_name from (
  select source_city_code as city, start_station_id as entity_id, 'Stop ' || (event_id % 4) as name from trips
  union all select source_city_code, end_station_id, 'Halt ' || (event_id % 4) from trips) x
where entity_id is not null""",
)
def _(t: Tables):
    four = (F.col("ride_id").cast("bigint") % 4).cast("string")
    named = t.trips.select(
        F.col("source_city_code").alias("city"),
        "start_station_id",
        "end_station_id",
        F.concat(F.lit("Stop "), four).alias("start_station_name"),
        F.concat(F.lit("Halt "), four).alias("end_station_name"),
    )
    legs = [{"id": f"{e}_station_id", "name": f"{e}_station_name"} for e in ("start", "end")]
    return match.entities(named, legs, ["city"])


@check("em_match", MATCH_SQL)
def _(t: Tables):
    return matched(t)


@check(
    "em_score",
    f"select city, entity_id, match_method, case match_method when 'EXACT_ID' then 1.0 when 'NORMALIZED_NAME' then 0.75"
    f" else 0.0 end::double as confidence, match_method <> 'EXACT_ID' as requires_review from ({MATCH_SQL}) s",
)
def _(t: Tables):
    return match.score_match(matched(t)).select("city", "entity_id", "match_method", "confidence", "requires_review")


PART_NAMES = "select distinct p_size, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') as name from part"


@check(
    "em_fuzzy",
    f"select l.p_size, l.name as left_name, r.name as right_name, levenshtein(l.name, r.name) as distance from"
    f" ({PART_NAMES}) l join ({PART_NAMES}) r on l.p_size = r.p_size where levenshtein(l.name, r.name) <= 2",
)
def _(t: Tables):
    return match.fuzzy_match(t.part, t.part, "p_size", "p_name", "p_name", max_distance=2)


LONG_NAMES = (
    "select distinct p_size, regexp_replace(lower(case when p_partkey % 3 = 1 then 'z' else '' end || repeat(p_name, 9)"
    " || case when p_partkey % 4 = 2 then 'y' else '' end), '[^a-z0-9]+', '', 'g') as name from part"
)


@check(
    "em_fuzzy_long",
    f"select l.p_size, l.name as left_name, r.name as right_name, levenshtein(l.name, r.name) as distance from"
    f" ({LONG_NAMES}) l join ({LONG_NAMES}) r on l.p_size = r.p_size where levenshtein(l.name, r.name) <= 2",
)
def _(t: Tables):
    """Names of sixty to a hundred characters, some matched by deletions, some by segments, some by both."""
    edge = lambda n, k, c: F.when(F.col("p_partkey") % n == k, c).otherwise("")
    parts = t.part.select("p_size", F.concat(edge(3, 1, "z"), F.repeat("p_name", 9), edge(4, 2, "y")).alias("long_name"))
    return match.fuzzy_match(parts, parts, "p_size", "long_name", "long_name", max_distance=2)


# ---- leakage, reconciliation, audit ----

TRAIN_END, VALID_END, TEST_END = datetime(2024, 3, 1), datetime(2024, 4, 1), datetime(2024, 5, 1)
FUTURE_SQL = (
    "select 'trips' as source_name, 'FUTURE_RECORD_AFTER_ETL_CUTOFF' as rule_code, 'reject' as severity,"
    " count(*) as checked_count, count(*) filter (started_at > timestamp '2024-05-01') as leak_count from trips"
)
CROSS_SQL = (
    "select 'trips' as source_name, 'TRIP_END_CROSSES_TRAIN_CUTOFF' as rule_code, 'warning' as severity,"
    " count(*) as checked_count, count(*) filter (started_at <= timestamp '2024-03-01' and"
    " ended_at > timestamp '2024-03-01') as leak_count from trips"
)
SPLIT_SQL = (
    "select 'mining_split' as source_name, 'TEMPORAL_SPLIT_ORDER' as rule_code, 'reject' as severity,"
    " count(*) as checked_count, count(*) filter (not (a < b and b < c)) as leak_count from"
    " (select o_custkey, min(o_orderdate) as a, max(o_orderdate) as c,"
    " min(o_orderdate) + interval 2 years as b from orders group by o_custkey) s"
)


@check("lk_future", FUTURE_SQL)
def _(t: Tables):
    return leakage.leak_future(t.trips, "started_at", TEST_END, "trips")


@check("lk_crosses_train", CROSS_SQL)
def _(t: Tables):
    return leakage.leak_crosses(t.trips, "started_at", "ended_at", TRAIN_END, "trips")


@check("lk_split_order", SPLIT_SQL)
def _(t: Tables):
    cutoffs = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("train_end"),
        (F.min("o_orderdate") + F.expr("interval 2 years")).alias("valid_end"),
        F.max("o_orderdate").alias("test_end"),
    )
    return leakage.leak_split_order(cutoffs)


@check(
    "lk_status",
    "select *, case when leak_count = 0 then 'PASS' when severity = 'warning' then 'WARNING' else 'FAIL' end as status"
    f" from ({FUTURE_SQL} union all {CROSS_SQL} union all {FUTURE_SQL.replace('2024-05-01', '2025-05-01')}) r",
)
def _(t: Tables):
    report = dedup.union_all(
        leakage.leak_future(t.trips, "started_at", TEST_END, "trips"),
        leakage.leak_crosses(t.trips, "started_at", "ended_at", TRAIN_END, "trips"),
        leakage.leak_future(t.trips, "started_at", datetime(2025, 5, 1), "trips"),
    )
    return leakage.leak_status(report)


@check(
    "lk_temporal_split",
    """select ride_id, split from (select ride_id, ended_at, case when started_at <= timestamp '2024-03-01' then 'train'
    when started_at <= timestamp '2024-04-01' then 'valid' when started_at <= timestamp '2024-05-01' then 'test' end
    as split, case when started_at <= timestamp '2024-03-01' then timestamp '2024-03-01' when started_at <=
    timestamp '2024-04-01' then timestamp '2024-04-01' else timestamp '2024-05-01' end as lim from trips) x
where split is not null and (ended_at is null or ended_at <= lim)""",
)
def _(t: Tables):
    cuts = {"train": TRAIN_END, "valid": VALID_END, "test": TEST_END}
    return leakage.temporal_split(t.trips, "started_at", "ended_at", cuts).select("ride_id", "split")


@check(
    "rc_totals",
    """select measure, l as left_total, r as right_total, abs(l - r) as difference,
  case when l = r then 'OK' else 'LEAK' end as status from (
  select 'started' as measure, (select count(*) from nds_trips where start_station_sk is not null) as l,
    (select sum(trips_started)::bigint from balance) as r
  union all select 'ended', (select count(*) from nds_trips where end_station_id is not null and ended_at is not null),
    (select sum(trips_ended)::bigint from balance)
  union all select 'all', (select count(*) from nds_trips), (select sum(trips_started)::bigint from balance)) x""",
)
def _(t: Tables):
    started, ended = F.col("start_station_sk").isNotNull(), F.col("end_station_sk").isNotNull()
    return reconcile.reconcile_totals(
        t.nds_trips,
        t.balance,
        {
            "started": (F.count_if(started), F.sum("trips_started")),
            "ended": (F.count_if(ended & F.col("ended_at").isNotNull()), F.sum("trips_ended")),
            "all": (F.count(F.lit(1)), F.sum("trips_started")),
        },
    )


@check(
    "rc_missing",
    f"select distinct city_sk, source_station_id, {ts('date_hour')} as date_hour from legs where not exists (select 1"
    f" from nds_trips n where n.loaded_at <= {FIRST} and n.city_sk = legs.city_sk and (n.start_station_id ="
    " legs.source_station_id and date_trunc('hour', n.started_at) = legs.date_hour or n.end_station_id ="
    " legs.source_station_id and n.ended_at is not null and date_trunc('hour', n.ended_at) = legs.date_hour))",
)
def _(t: Tables):
    partial = flow.station_hour_balance(t.nds_trips.filter(BEFORE))
    return reconcile.missing_rows(flow.trip_legs(t.nds_trips), partial, GRAIN)


@check(
    "rc_cube",
    "select month, city_code, weather_category, c_trips_started, b_trips_started from (select month, city_code,"
    " weather_category, sum(trips_started)::bigint as b_trips_started, sum(trips_started) filter"
    " (trips_ended = 0)::bigint as c_trips_started from star group by 1, 2, 3) x"
    " where c_trips_started is distinct from b_trips_started",
)
def _(t: Tables):
    # A cube built from a part of the rows must be reported cell by cell.
    keys_ = ["month", "city_code", "weather_category"]
    partial = t.star.groupBy(*keys_).agg(
        F.sum(F.when(F.col("trips_ended") == 0, F.col("trips_started"))).alias("trips_started")
    )
    return reconcile.reconcile_cube(partial, t.star, keys_, ["trips_started"])


@check(
    "rc_fact_identity",
    "select 'net_flow' as check_name, count(*) filter (net_flow <> trips_ended - trips_started) as bad_rows from star"
    " union all select 'null key', 0 from (select count(*) from star) x union all select 'negative flow',"
    " count(*) filter (net_flow < 0) from star",
)
def _(t: Tables):
    keys_null = F.col("station_sk").isNull() | F.col("datetime_sk").isNull() | F.col("weather_condition_sk").isNull()
    return rules.check_constraints(
        t.fact,
        {
            "net_flow": F.col("net_flow") != F.col("trips_ended") - F.col("trips_started"),
            "null key": keys_null,
            "negative flow": F.col("net_flow") < 0,
        },
    )


@check(
    "au_load_counts",
    """select 'citibike_trips' as source_name, 'stg_trips' as table_name, a as total_rows_count, b as success_rows_count,
  greatest(a - b, 0) as failed_rows_count, case when a > 0 and b = 0 then 'FAILED' else 'SUCCESS' end as status
from (select count(*) filter (ok) as a, count(distinct case when ok and nullif(trim(ride_id), '') is not null
    and regexp_matches(trip_month, '^[0-9]{6}$') and not (nullif(trim(start_station_id), '') is null
    and nullif(trim(end_station_id), '') is null) then (source_city_code, trim(ride_id)) end) as b
  from (select *, coalesce(regexp_matches(started_at, '^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}')
    and try_cast(started_at as timestamp) >= timestamp '2024-01-01'
    and try_cast(started_at as timestamp) <= timestamp '2024-07-01', false) as ok from raw_trips) r) x""",
)
def _(t: Tables):
    from tidemark.functions import clean

    staged = bike.stage_trips(t.raw_trips, bike.trip_rules("CITI", "citibike_trips"), CTX)
    raw = t.raw_trips.withColumn("__ts", clean.ts_seconds("started_at"))
    in_run = incremental.in_window("__ts", CTX.lset, CTX.cet, CTX.lookback_days)
    return audit.load_counts(raw, staged, "citibike_trips", "stg_trips", raw_cond=F.coalesce(in_run, F.lit(False)))


@check(
    "au_candidates",
    """select *, city + calendar + station + weather + trip as total_rows_count,
  city + calendar + station + weather + trip - pending_rows as success_rows_count
from (select (select count(*) from city) as city, (select last_day - first_day + 1 from span) as calendar,
  (select count(*) from stations) as station, (select count(*) from weather) as weather,
  (select count(distinct (city_sk, ride_id)) from trips) as trip,
  (select count(*) from resolved) - (select count(*) from nds_trips) as pending_rows) x""",
)
def _(t: Tables):
    _, pending = lookup.split_pending(t.resolved, loads.ID_TO_SK)
    return audit.candidate_counts(
        {
            "city": t.city,
            "calendar": dims.calendar([(t.trips, "started_at"), (t.trips, "ended_at")]),
            "station": t.stations,
            "weather": t.weather,
            "trip": t.trips.select("city_sk", "ride_id").distinct(),
        },
        pending,
    )


@check(
    "au_job_log",
    "select 'check' as load_run_id, 'stage trips' as job_name, source_name, '2024-07-01 00:00:00' as started_at,"
    " '2024-07-01 00:05:00' as finished_at, case when failed_rows_count > 20 then 'FAILED' else 'SUCCESS' end"
    f" as status, total_rows_count, success_rows_count, failed_rows_count from ({FILE_COUNTS}) f",
)
def _(t: Tables):
    status = F.when(F.col("failed_rows_count") > 20, "FAILED").otherwise("SUCCESS")
    return audit.job_log(file_counts(t), CTX, "stage trips", status, finished_at=datetime(2024, 7, 1, 0, 5))


@check(
    "au_freshness",
    f"select source_city_code as source_name, {ts('max(loaded_at)')} as last_success from trips"
    " where rideable_type = 'classic_bike' group by 1",
)
def _(t: Tables):
    runs = t.trips.select(
        F.col("source_city_code").alias("source_name"),
        F.col("loaded_at").alias("cet"),
        F.when(F.col("rideable_type") == "classic_bike", "SUCCESS").otherwise("FAILED").alias("status"),
    )
    return audit.freshness(runs)


# ---- dimensions ----

CALENDAR_SQL = f"""
select {day('d')} as calendar_date, isodow(d) as day_of_week, isodow(d) >= 6 as is_weekend, month(d) as month,
  case when month(d) in (12, 1, 2) then 'winter' when month(d) <= 5 then 'spring' when month(d) <= 8 then 'summer'
    else 'fall' end as season
from (select unnest(generate_series(lo::timestamp, hi::timestamp, interval 1 day)) as d from (
  select least((select min(o_orderdate) from orders), (select min(l_shipdate) from lineitem))::date as lo,
    greatest((select max(o_orderdate) from orders), (select max(l_shipdate) from lineitem))::date as hi) s) x"""


@check("dm_calendar", CALENDAR_SQL)
def _(t: Tables):
    return dims.calendar([(t.orders, "o_orderdate"), (t.lineitem, "l_shipdate")])


@check("dm_datetime", "select * replace (strftime(date, '%Y-%m-%d') as date) from dim_datetime")
def _(t: Tables):
    return t.dim_datetime


@check("dm_city", "select * exclude (city_sk) from city")
def _(t: Tables):
    return dims.observed_codes([t.trips, t.stg_weather], "source_city_code", dims.CITIES, dims.CITY_ATTRIBUTES, "city_code")


@check(
    "dm_weather",
    "select d.weather_condition_sk, d.weather_category, precipitation_band, count(w.city_sk) as hours from dim_weather d"
    " left join weather w on w.weather_category = d.weather_category group by 1, 2, 3",
)
def _(t: Tables):
    hours = t.weather.groupBy("weather_category").agg(F.count(F.lit(1)).alias("hours"))
    return t.dim_weather.join(hours, "weather_category", "left").withColumn("hours", F.coalesce("hours", F.lit(0)))


@check(
    "dm_registry",
    "select v.source_name, layer, n from (values ('click', 'web'), ('view', 'web'), ('signup', 'app'),"
    " ('purchase', 'shop'), ('error', 'app')) v(source_name, layer) left join (select event_type, count(*) as n"
    " from events group by 1) e on e.event_type = v.source_name",
)
def _(t: Tables):
    registry = dims.static_dim(
        t.spark,
        [("click", "web"), ("view", "web"), ("signup", "app"), ("purchase", "shop"), ("error", "app")],
        "source_name string, layer string",
    )
    counts = t.events.groupBy(F.col("event_type").alias("source_name")).agg(F.count(F.lit(1)).alias("n"))
    return registry.join(counts, "source_name", "left")


@check(
    "dm_holiday",
    f"select {day('d')} as calendar_date, name, trips from (values (date '2024-01-01', 'New Year'),"
    " (date '2024-02-19', 'Presidents Day'), (date '2024-05-27', 'Memorial Day')) v(d, name) left join"
    " (select started_at::date as day, count(*) as trips from trips group by 1) t on t.day = d",
)
def _(t: Tables):
    holidays = dims.static_dim(
        t.spark,
        [("2024-01-01", "New Year"), ("2024-02-19", "Presidents Day"), ("2024-05-27", "Memorial Day")],
        "day string, name string",
    ).select(F.to_date("day").alias("calendar_date"), "name")
    trips = t.trips.groupBy(F.to_date("started_at").alias("calendar_date")).agg(F.count(F.lit(1)).alias("trips"))
    return holidays.join(trips, "calendar_date", "left")
