"""Checks of sources, sinks and streams: data is written to the shared work folder,
processed from there, and compared with what the tables say directly."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.registry import check
from tidemark.checks.rows import (
    ACCEPT_TRIPS,
    CAP_BAD,
    COORD_BAD,
    ODD_HOURS,
    ODD_STARTS,
    REPORT_BAD,
    STATION_ID,
    SUMMARY_SQL,
    TRIP_RULES,
    WEATHER_ID,
    WEATHER_NUM,
)
from tidemark.checks.tables import AFTER, BALANCE, BEFORE, FIRST, GRAIN, PENDING
from tidemark.checks.views import CTX, FIRST_LOAD, Tables, num, ts
from tidemark.context import RunContext
from tidemark.functions import clean
from tidemark.operators import audit, cdc, dedup, flow, incremental, lookup, rules, upsert
from tidemark.plans import bike, landing
from tidemark.session import materialize, scratch_path
from tidemark.sources import files, jsonarray, sinks
from tidemark.streaming import changes, rides, state, trips

# ---- sources ----

# Orders in a JSON document: some 260 MB, several ranges of the default size.
DOCUMENT_ORDERS = 2_000_000


@check(
    "src_csv_glob",
    "select trim(ride_id) as ride_id, nullif(trim(start_station_id), '') as start_station_id, started_at,"
    " source_row_number::varchar as line from raw_trips where trim(ride_id) <> ''",
)
def _(t: Tables):
    path = scratch_path(t.spark, "csv")
    cols = ["ride_id", "started_at", "start_station_id", "source_row_number"]
    sinks.export_csv(t.raw_trips.select(*cols), f"{path}/2024/trips")
    # Not to be read: files of another kind in the same folder tree, and a folder beside it.
    sinks.export_jsonl(t.events.select("event_id"), f"{path}/2024/events")
    sinks.export_csv(t.events.select("event_id"), f"{path}/other/events.csv.d")
    back = files.read_csv_dir(t.spark, f"{path}/2024", files.text_schema(cols), r"^part-.*\.csv$")
    return back.select(
        clean.blank_to_null("ride_id").alias("ride_id"),
        clean.blank_to_null("start_station_id").alias("start_station_id"),
        "started_at",
        F.col("source_row_number").alias("line"),
    ).filter("ride_id is not null")


@check(
    "src_csv_wide",
    "select l_orderkey::varchar as order_key, l_linenumber::varchar as line, l_returnflag as flag from lineitem",
)
def _(t: Tables):
    path = scratch_path(t.spark, "wide")
    sinks.export_csv(t.lineitem, path)
    return files.read_csv_positional(
        t.spark, path, len(t.lineitem.columns), {0: "order_key", 3: "line", 8: "flag"}
    ).drop("source_file")


@check(
    "src_json_feed",
    f"select s_suppkey::varchar as station_id, s_name as name, s_nationkey as capacity, {num('s_acctbal')} as lat"
    " from supplier",
)
def _(t: Tables):
    path = scratch_path(t.spark, "feed")
    station = F.struct(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("lat"),
        F.col("s_nationkey").alias("capacity"),
    )
    # One document with at most 500 stations per folder.
    feed = t.supplier.groupBy(F.floor(F.col("s_suppkey") / 500).alias("part")).agg(F.collect_list(station).alias("s"))
    document = F.to_json(F.struct(F.lit(1).alias("last_updated"), F.struct(F.col("s").alias("stations")).alias("data")))
    feed.select("part", document.alias("value")).write.partitionBy("part").text(path)
    return files.read_json_feed(t.spark, path).select("station_id", "name", "capacity", "lat")


@check(
    "src_json_array",
    f"select o_orderkey as order_key, o_orderpriority as priority, {num('o_totalprice')} as price, o_custkey as customer from orders",
)
def _(t: Tables):
    """All orders in the array of a document, read by ranges; the priorities end in a brace and a quote there.

    A task writes a document while it reads: up to two million orders give one, more give several.
    """
    path = scratch_path(t.spark, "document")
    order = F.struct(
        F.col("o_orderkey").alias("order_key"),
        F.concat(F.col("o_orderpriority"), F.lit('}{"')).alias("priority"),
        F.struct(F.col("o_totalprice").cast("double").alias("price"), F.struct(F.col("o_custkey").alias("id")).alias("by")).alias("sold"),
    )

    def document(batches):
        lead = '{"orders": [{"order_key": 0}], "data": {"count": 1, "orders": ['
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"value": [lead + batch["value"].iloc[0], *("," + batch["value"].iloc[1:])]})
                lead = ","
        yield pd.DataFrame({"value": [("" if lead == "," else lead) + "]}}"]})

    number = max(1, -(-t.orders.count() // DOCUMENT_ORDERS))
    documents = t.orders.select(F.to_json(order).alias("value")).coalesce(number).mapInPandas(document, "value string")
    documents.write.text(path)
    schema = "order_key bigint, priority string, sold struct<price: double, by: struct<id: bigint>>"
    found = jsonarray.read_json_array(t.spark, path, schema, "data.orders")
    return found.select(
        "order_key",
        F.regexp_replace("priority", r'\}\{"$', "").alias("priority"),
        F.col("sold.price").alias("price"),
        F.col("sold.by.id").alias("customer"),
    )


@check(
    "src_jsonl",
    "select event_id::varchar as event_id, event_type, json_extract_string(props, '$.k') as k,"
    " '[\"' || event_type || '\",\"' || user_id || '\"]' as tags from events",
)
def _(t: Tables):
    path = scratch_path(t.spark, "jsonl")
    tags = F.array(F.col("event_type"), F.col("user_id").cast("string"))
    sinks.export_jsonl(t.events.select("event_id", "event_type", "props", tags.alias("tags")), path)
    paths = {"event_id": "$.event_id", "event_type": "$.event_type", "props": "$.props", "tags": "$.tags"}
    back = files.read_json_lines(t.spark, path, paths)
    return back.select("event_id", "event_type", *files.json_fields(F.col("props"), {"k": "$.k"}), "tags")


@check(
    "src_exported_csv",
    "select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey, o_orderpriority from orders",
)
def _(t: Tables):
    path = scratch_path(t.spark, "csv")
    cols = ["o_orderkey", "o_custkey", "o_orderpriority"]
    sinks.export_csv(t.orders.select(*cols), path)
    return files.read_csv_text(t.spark, path, cols)


@check("src_table", "select o_orderkey, o_orderstatus from orders where o_totalprice > 100000")
def _(t: Tables):
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    return files.read_table(t.spark, f"{t.sf_dir}/orders.parquet", cols).filter("o_totalprice > 100000").drop(
        "o_totalprice"
    )


@check(
    "src_doc_window",
    f"select event_id, event_type, {ts('ts')} as ts from events where ts > timestamp '2024-01-10' and"
    " ts <= timestamp '2024-01-20'",
)
def _(t: Tables):
    path = scratch_path(t.spark, "docs")
    sinks.export_jsonl(t.events.select("event_id", "event_type", "ts"), path)
    schema = "event_id bigint, event_type string, ts timestamp_ntz"
    return files.read_documents(t.spark, path, schema, "ts", datetime(2024, 1, 10), FIRST_LOAD)


@check(
    "src_params",
    "select '20240701T000000' as load_run_id, '2024-07-01 00:00:00' as started_at, '2026-01-01 00:00:00' as lset,"
    f" {ts('max(ts)')} as cet, 3 as lookback_days, count(*) as pending_rows from events",
)
def _(t: Tables):
    ctx = RunContext.start(datetime(2024, 7, 1))
    seen = t.events.agg(F.max("ts").alias("cet"), F.count(F.lit(1)).alias("pending_rows"))
    return clean.with_constants(seen, load_run_id=ctx.load_run_id, lookback_days=ctx.lookback_days).withColumns(
        {
            "started_at": F.lit(str(ctx.started_at)).cast("timestamp_ntz"),
            "lset": F.lit(str(ctx.lset)).cast("timestamp_ntz"),
        }
    )


@check(
    "src_period_filter",
    "select source_row_number, started_at from raw_trips where substr(trim(started_at), 1, 10) between '2024-01-05'"
    " and '2024-01-10'",
)
def _(t: Tables):
    return incremental.period_filter(t.raw_trips, "started_at", "2024-01-05", "2024-01-10").select(
        "source_row_number", "started_at"
    )


@check("sc_row_number_in_file", "select count(*) as total_rows, count(*) as in_order from events")
def _(t: Tables):
    """Files hold consecutive ids, so id minus row number is one value per file."""
    path = scratch_path(t.spark, "numbered")
    sorted_rows = t.events.select("event_id", "event_type", "props").repartitionByRange(4, "event_id")
    sinks.export_csv(sorted_rows.sortWithinPartitions("event_id"), path)
    schema = files.text_schema(["event_id", "event_type", "props"])
    back = files.read_csv_dir(t.spark, path, schema, number_rows=True)
    back = back.withColumn("id", F.col("event_id").cast("bigint"))
    first = back.groupBy("source_file").agg(F.min("id").alias("first_id"))
    return back.join(first, "source_file").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("id") - F.col("first_id") + 1 == F.col("source_row_number")).alias("in_order"),
    )


# ---- sinks ----


@check("snk_replace", "select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'F'")
def _(t: Tables):
    path = scratch_path(t.spark, "replace")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    sinks.write_replace(orders, path)
    sinks.write_replace(orders.filter("o_orderstatus <> 'F'"), path)
    return t.spark.read.parquet(path)


@check("snk_append", "select o_orderkey, o_orderstatus from orders union all select o_orderkey, 'again' from orders")
def _(t: Tables):
    path = scratch_path(t.spark, "append")
    sinks.write_append(t.orders.select("o_orderkey", "o_orderstatus"), path)
    sinks.write_append(t.orders.select("o_orderkey", F.lit("again").alias("o_orderstatus")), path)
    return t.spark.read.parquet(path)


@check("snk_csv", "select c_custkey, c_name, c_mktsegment from customer")
def _(t: Tables):
    path = scratch_path(t.spark, "csv")
    sinks.export_csv(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    schema = "c_custkey bigint, c_name string, c_mktsegment string"
    return t.spark.read.schema(schema).option("header", True).csv(path)


@check("snk_jsonl", "select p_partkey, p_name, p_size from part")
def _(t: Tables):
    path = scratch_path(t.spark, "jsonl")
    document = F.to_json(F.struct("p_partkey", "p_name", "p_size"))
    sinks.export_jsonl(t.part.select(document.alias("doc")), path, "doc")
    return t.spark.read.schema("p_partkey bigint, p_name string, p_size int").json(path)


@check(
    "snk_log",
    "select source_file as source_name, 'ERROR' as log_level, count(*) as bad_rows from raw_trips"
    " where trim(coalesce(ride_id, '')) = '' group by 1",
)
def _(t: Tables):
    path = scratch_path(t.spark, "log")
    found = t.raw_trips.filter(clean.is_blank("ride_id")).groupBy(F.col("source_file").alias("source_name")).agg(
        F.count(F.lit(1)).alias("bad_rows")
    )
    sinks.log_rows(found, path)
    return t.spark.read.parquet(path).drop("logged_at")


@check(
    "dq_reset",
    "select 'run1' as load_run_id, event_type, count(*) as n from events where value > 10 group by 2 union all"
    " select 'run2', event_type, count(*) from events group by 2",
)
def _(t: Tables):
    path = scratch_path(t.spark, "runs")

    def result(df: DataFrame, run: str) -> DataFrame:
        return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("load_run_id", F.lit(run))

    sinks.replace_run(result(t.events, "run1"), path)
    sinks.replace_run(result(t.events, "run2"), path)
    sinks.replace_run(result(t.events.filter("value > 10"), "run1"), path)
    return t.spark.read.parquet(path)


@check(
    "up_truncate",
    "select 'before' as table_name, count(*) as row_count from raw_trips union all select 'after', 0",
)
def _(t: Tables):
    path = scratch_path(t.spark, "raw")
    sinks.write_replace(t.raw_trips, path)
    before = materialize(audit.total_rows({"before": t.spark.read.parquet(path)}), "before")
    schema = t.raw_trips.schema
    sinks.truncate(t.spark, path, schema)
    return before.unionByName(audit.total_rows({"after": t.spark.read.schema(schema).parquet(path)}))


@check(
    "up_partitions",
    f"select city_sk, source_station_id, {ts('date_hour')} as date_hour, trips_started, trips_ended from balance",
)
def _(t: Tables):
    """The second load rewrites the months it touches; the result is the full build."""
    path = scratch_path(t.spark, "fact")
    cols = [*GRAIN, "trips_started", "trips_ended", "month"]

    def monthly(df: DataFrame) -> DataFrame:
        return df.withColumn("month", F.date_format("date_hour", "yyyyMM")).select(*cols)

    sinks.replace_partitions(monthly(flow.station_hour_balance(t.nds_trips.filter(BEFORE))), path, ["month"])
    grains = materialize(incremental.affected_grains(t.nds_trips.filter(AFTER)), "grains")
    fresh = monthly(incremental.reaggregate(t.nds_trips, grains))
    stored = t.spark.read.schema(fresh.schema).parquet(path)
    touched = upsert.upsert_partitions(stored, fresh, GRAIN, ["month"])
    sinks.replace_partitions(materialize(touched.select(*cols), "months"), path, ["month"])
    return t.spark.read.parquet(path).drop("month")


# ---- streams ----

WAVE = "timestamp_ntz '2024-03-15 00:00:00'"


def two_waves(t: Tables, df: DataFrame, first, second, start) -> None:
    """Drop the first files, run the stream, drop the rest, run it again."""
    path = scratch_path(t.spark, "wave")
    checkpoint = scratch_path(t.spark, "checkpoint")
    for rows in (df.filter(first), df.filter(second)):
        rows.write.mode("append").parquet(path)
        stream = t.spark.readStream.schema(df.schema).parquet(path)
        start(stream, checkpoint).awaitTermination()


def pushed(t: Tables) -> DataFrame:
    return t.events.select(
        F.expr(
            "case when event_id % 67 = 0 then 'MOVE' when event_type = 'error' then 'delete'"
            " when event_type = 'view' then 'update' else 'INSERT' end"
        ).alias("operation"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("sent_at"),
        F.struct(
            F.expr("case when event_id % 61 = 0 then 'BOS' when user_id % 2 = 0 then 'CHI' else 'NYC' end").alias(
                "source_city_code"
            ),
            F.concat(F.lit("g"), "event_id").alias("gbfs_station_id"),
            F.expr("case when event_id % 59 = 0 then ' ' else concat('S', user_id % 30) end").alias("short_name"),
            F.concat(F.lit("name "), "event_id").alias("station_name"),
            F.col("value").alias("latitude"),
            (F.col("value") / -2).alias("longitude"),
            F.col("user_id").cast("int").alias("capacity"),
            F.lit("classic").alias("station_type"),
            F.lit("1").alias("region_id"),
            F.expr("case when event_id % 3 = 0 then 'closed' end").alias("station_status"),
        ).alias("data"),
    )


JUDGED = {
    "judged": """
select e.*, case when op = 'MOVE' or source_city_code = 'BOS' or short_name = ' ' then 400
    when op = 'DELETE' and s.station_sk is null then 404 else 200 end as http_status,
  case when op = 'MOVE' then 'Invalid operation' when source_city_code = 'BOS' then 'Invalid source_city_code'
    when short_name = ' ' then 'Invalid station''s short_name'
    when op = 'DELETE' and s.station_sk is null then 'Station not found in NDS' else 'ACCEPTED' end as message,
  case when op = 'DELETE' then 'DELETE' when s.station_sk is not null then 'UPDATE' else 'INSERT' end as real_op
from (select event_id, ts, case when event_id % 67 = 0 then 'MOVE' when event_type = 'error' then 'DELETE'
      when event_type = 'view' then 'UPDATE' else 'INSERT' end as op,
    case when event_id % 61 = 0 then 'BOS' when user_id % 2 = 0 then 'CHI' else 'NYC' end as source_city_code,
    case when event_id % 59 = 0 then ' ' else 'S' || (user_id % 30) end as short_name, user_id,
    case when event_id % 3 = 0 then 'closed' else 'open' end as station_status,
    1 + user_id % 2 as city_sk from events) e
left join stations s on s.city_sk = e.city_sk and s.source_station_id = e.short_name"""
}


def run_changes(t: Tables) -> str:
    """Two waves of JSON files through the change stream; gives the output folder."""
    inbox, out = scratch_path(t.spark, "inbox"), scratch_path(t.spark, "out")
    checkpoint = scratch_path(t.spark, "checkpoint")
    stations, city = materialize(t.stations, "stations"), materialize(t.city, "city")
    cut = FIRST_LOAD.strftime("%Y-%m-%d")
    for cond in (f"sent_at <= '{cut}'", f"sent_at > '{cut}'"):
        pushed(t).filter(cond).write.mode("append").json(inbox)
        for query in changes.change_stream(t.spark, inbox, out, checkpoint, stations, city):
            query.awaitTermination()
    return out


@check(
    "st_mdm_apply",
    "select source_city_code, short_name, 'name ' || event_id as station_name, user_id as capacity, station_status,"
    " real_op as operation from (select *, row_number() over (partition by source_city_code, short_name order by ts"
    " desc) as rn from judged where http_status = 200) j where rn = 1",
    **JUDGED,
)
def _(t: Tables):
    cols = ["source_city_code", "short_name", "station_name", "capacity", "station_status", "operation"]
    return changes.latest_staging(t.spark, run_changes(t)).select(*cols)


@check(
    "st_mdm_responses",
    "select source_city_code, short_name, http_status, message, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as sent_at"
    " from judged",
    **JUDGED,
)
def _(t: Tables):
    out = run_changes(t)
    return t.spark.read.parquet(f"{out}/responses").select(
        "source_city_code", "short_name", "http_status", "message", "sent_at"
    )


@check(
    "st_hourly_flow",
    f"""select city_sk, source_station_id, {ts('h')} as date_hour, sum(s)::bigint as trips_started,
  sum(1 - s)::bigint as trips_ended, sum(1 - 2 * s)::bigint as net_flow
from (select city_sk, start_station_id as source_station_id, date_trunc('hour', started_at) as h, 1 as s from trips
  union all select city_sk, end_station_id, date_trunc('hour', ended_at), 0 from trips where ended_at is not null) l
where source_station_id is not null group by 1, 2, 3""",
)
def _(t: Tables):
    out = scratch_path(t.spark, "flow")
    cols = t.trips.select("city_sk", "start_station_id", "end_station_id", "started_at", "ended_at")

    def start(stream, checkpoint):
        return trips.run_once(trips.hourly_flow(stream), trips.store_by_batch(out), checkpoint, "update")

    two_waves(t, cols, f"started_at <= {WAVE}", f"started_at > {WAVE}", start)
    return trips.latest_by_key(t.spark, out, GRAIN)


@check("st_dedup", f"select ride_id, city_sk, {ts('started_at')} as started_at from trips")
def _(t: Tables):
    """The second wave repeats the last hours of the first one."""
    out = scratch_path(t.spark, "dedup")
    cols = t.trips.select("ride_id", "city_sk", "started_at")
    twice = cols.unionByName(cols.filter("city_sk = 1"))

    def start(stream, checkpoint):
        kept = trips.dedup_stream(stream, ["city_sk", "ride_id"], "started_at")
        return trips.run_once(kept, trips.store_by_batch(out), checkpoint, "append")

    two_waves(t, twice, f"started_at <= {WAVE}", f"started_at > {WAVE} - interval 36 hours", start)
    return t.spark.read.parquet(out).drop("batch_id")


@check("st_dedup_forever", f"select ride_id, city_sk, {ts('started_at')} as started_at from trips")
def _(t: Tables):
    """The second wave repeats every ride of the first one, thirty days later."""
    out = scratch_path(t.spark, "dedup")
    rows = t.trips.select("ride_id", "city_sk", "started_at", F.expr(f"started_at > {WAVE}").alias("second"))
    again = rows.filter("not second").withColumns({"started_at": F.expr("started_at + interval 30 days"), "second": F.lit(True)})

    def start(stream, checkpoint):
        kept = trips.dedup_stream(stream, ["city_sk", "ride_id"], "started_at", None)
        writer = kept.writeStream.foreachBatch(trips.store_by_batch(out)).option("checkpointLocation", checkpoint)
        return state.on_rocksdb(writer)

    two_waves(t, rows.unionByName(again), "not second", "second", start)
    return t.spark.read.parquet(out).drop("batch_id", "second")


@check(
    "st_late_backlog",
    f"""select ride_id, start_station_sk, end_station_sk, {PENDING} as waits from (select ride_id, start_station_id,
    end_station_id, case when start_station_id = 'S7' then city_sk * 1000 + 7 else start_station_sk end
      as start_station_sk, case when end_station_id = 'S7' then city_sk * 1000 + 7 else end_station_sk end
      as end_station_sk from resolved) r""",
)
def _(t: Tables):
    """Station S7 arrives between the waves and releases its waiting trips."""
    out, master = scratch_path(t.spark, "late"), scratch_path(t.spark, "master")
    cols = ["ride_id", "city_sk", "start_station_id", "end_station_id", "loaded_at"]
    staged = t.trips.select(*cols)
    keys = ["station_sk", "city_sk", "source_station_id", "is_current", "effective_from"]
    sinks.write_append(t.stations.select(*keys), master)
    s7 = t.trips.select("city_sk").distinct().select(
        (F.col("city_sk") * 1000 + 7).cast("bigint").alias("station_sk"),
        "city_sk",
        F.lit("S7").alias("source_station_id"),
        F.lit(True).alias("is_current"),
        F.lit("2024-01-20 00:00:00").cast("timestamp_ntz").alias("effective_from"),
    )
    waves = {"n": 0}

    def resolve(rows: DataFrame) -> DataFrame:
        dim = rows.sparkSession.read.schema(t.stations.select(*keys).schema).parquet(master)
        for end in ("start", "end"):
            ids = {"city_sk": "city_sk", f"{end}_station_id": "source_station_id"}
            rows = lookup.lookup_best(rows, dim, ids, {"station_sk": f"{end}_station_sk"})
        return rows

    id_to_sk = {"start_station_id": "start_station_sk", "end_station_id": "end_station_sk"}

    def start(stream, checkpoint):
        waves["n"] += 1
        if waves["n"] == 2:
            sinks.write_append(s7, master)
        store = trips.backlog_store(out, resolve, id_to_sk, staged.schema)
        return trips.run_once(stream, store, checkpoint, "append")

    two_waves(t, staged, BEFORE, AFTER, start)
    ready = t.spark.read.parquet(f"{out}/ready")
    backlog = resolve(t.spark.read.parquet(f"{out}/backlog/snapshot=1"))
    shown = ["ride_id", "start_station_sk", "end_station_sk"]
    return dedup.union_all(
        ready.select(*shown, F.lit(False).alias("waits")), backlog.select(*shown, F.lit(True).alias("waits"))
    )


NDS_COLUMNS = [
    "city_sk",
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_id",
    "end_station_id",
    "start_station_sk",
    "end_station_sk",
    "member_casual",
    "duration_minutes",
    "loaded_at",
]


def refreshed(t: Tables, after_wave=None) -> str:
    """Folder of the streamed fact after both waves; ``after_wave`` is called with it after each.

    The second wave repeats rides of the first one, some as they were and some that were
    stored with another hour, station and rider.
    """
    root, inbox = scratch_path(t.spark, "rides"), scratch_path(t.spark, "wave")
    rows = t.nds_trips.select(*NDS_COLUMNS)
    moved = F.col("ride_id").cast("bigint") % 10 == 3
    earlier = {
        "started_at": F.col("started_at") - F.expr("interval 3 hours"),
        "start_station_id": F.concat(F.col("start_station_id"), F.lit("x")),
        "member_casual": F.lit("casual"),
        "loaded_at": F.col("loaded_at") - F.expr("interval 1 second"),
    }
    wrong = rows.withColumns({c: F.when(moved, e).otherwise(F.col(c)) for c, e in earlier.items()})
    again = rows.filter("cast(ride_id as bigint) % 5 = 3")
    for wave in (wrong.filter(BEFORE), again.filter(BEFORE).unionByName(rows.filter(AFTER))):
        wave.write.mode("append").parquet(inbox)
        rides.refresh(t.spark.readStream.schema(rows.schema).parquet(inbox), root)
        if after_wave is not None:
            after_wave(root)
    return root


@check(
    "st_affected_grain",
    f"select city_sk, source_station_id, {ts('date_hour')} as date_hour, {BALANCE} from balance",
)
def _(t: Tables):
    return rides.fact(t.spark, refreshed(t), t.nds_trips)


@check(
    "st_async_delay",
    f"""select 1 as wave, count(*) as grains, sum(s)::bigint as trips_started, sum(e)::bigint as trips_ended from (
  select count(*) filter (f = 1) as s, count(*) filter (f = 0) as e from (
    select city_sk, start_station_id || case when event_id % 10 = 3 then 'x' else '' end as id, date_trunc('hour',
      started_at - case when event_id % 10 = 3 then interval 3 hours else interval 0 hours end) as h, 1 as f from nds_trips
    where start_station_sk is not null and loaded_at <= {FIRST}
    union all select city_sk, end_station_id, date_trunc('hour', ended_at), 0 from nds_trips
    where end_station_sk is not null and ended_at is not null and loaded_at <= {FIRST}) l group by city_sk, id, h) g
union all select 2, count(*), sum(trips_started)::bigint, sum(trips_ended)::bigint from balance""",
)
def _(t: Tables):
    """Totals of the fact after each wave: the delay shows, and the end equals a full build."""
    states: list[DataFrame] = []

    def note(root: str) -> None:
        now = rides.fact(t.spark, root, t.nds_trips).agg(
            F.lit(len(states) + 1).alias("wave"),
            F.count(F.lit(1)).alias("grains"),
            F.sum("trips_started").alias("trips_started"),
            F.sum("trips_ended").alias("trips_ended"),
        )
        states.append(materialize(now, "totals"))

    refreshed(t, note)
    return dedup.union_all(*states)


ODD_TRIPS = f"(select * replace ({ODD_STARTS} as started_at) from raw_trips)"
ODD_WEATHER = f"(select * replace ({ODD_HOURS} as observation_ts) from raw_weather)"
START = "try_strptime(substr(trim(started_at), 1, 19), '%Y-%m-%d %H:%M:%S')"
HOUR_TEXT = "replace(trim(observation_ts), 'T', ' ')"
HOUR = (
    f"try_strptime(case when length({HOUR_TEXT}) < 19 then {HOUR_TEXT} || ':00' else substr({HOUR_TEXT}, 1, 19) end,"
    " '%Y-%m-%d %H:%M:%S')"
)


def odd_trips(t: Tables) -> DataFrame:
    return t.raw_trips.withColumn("started_at", F.expr(ODD_STARTS))


def odd_weather(t: Tables) -> DataFrame:
    return t.raw_weather.withColumn("observation_ts", F.expr(ODD_HOURS))


@check(
    "stage_trips",
    f"""select source_city_code, ride_id, {ts('started')} as started_at, {ts('ended_at')} as ended_at,
  start_station_id, end_station_id, rideable_type, source_file from (
  select source_city_code, trim(ride_id) as ride_id, {START} as started,
    try_cast(nullif(ended_at, '') as timestamp) as ended_at,
    nullif(trim(start_station_id), '') as start_station_id, end_station_id, trim(rideable_type) as rideable_type,
    source_file, row_number() over (partition by source_city_code, trim(ride_id) order by source_file,
      source_row_number) as rn
  from {ODD_TRIPS} r where {ACCEPT_TRIPS} and {START} between timestamp '2024-01-01' and timestamp '2024-07-01') x
where rn = 1""",
)
def _(t: Tables):
    staged = bike.stage_trips(odd_trips(t), bike.trip_rules("CITI", "citibike_trips"), CTX)
    return staged.select(
        "source_city_code", "ride_id", "started_at", "ended_at", "start_station_id", "end_station_id",
        "rideable_type", "source_file",
    )


def balance_sql(source: str, rel: str, accepted: str, inside: str, key: str) -> str:
    return f"""select '{source}' as source_name, count(*) as raw_rows, count(distinct case when a and i then k end) as staged_rows,
  count(*) filter (a and i) - count(distinct case when a and i then k end) as duplicate_rows,
  count(*) filter (not a) as rejected_rows, count(*) filter (a and not i) as outside_rows, 0 as difference
from (select coalesce({accepted}, false) as a, coalesce({inside}, false) as i, {key} as k from {rel} r) x"""


IN_RUN = "between timestamp '2024-01-01' and timestamp '2024-07-01'"


STAGE_BALANCE = (
    balance_sql("citibike_trips", ODD_TRIPS, ACCEPT_TRIPS, f"{START} {IN_RUN}", "(trim(source_city_code), trim(ride_id))")
    + " union all "
    + balance_sql(
        "noaa_lcd",
        ODD_WEATHER,
        f"{WEATHER_ID} and nullif(trim(source_city_code), '') is not null and {HOUR} is not null"
        f" and not coalesce({WEATHER_NUM}, false) and not coalesce({REPORT_BAD}, false)",
        f"{HOUR} {IN_RUN}",
        f"(source_city_code, {HOUR})",
    )
    + " union all "
    + balance_sql(
        "gbfs_station",
        "raw_stations",
        f"{STATION_ID} and not coalesce({CAP_BAD}, false) and not coalesce({COORD_BAD}, false)",
        "true",
        "(source_city_code, coalesce(nullif(trim(short_name), ''), nullif(trim(gbfs_station_id), '')))",
    )
)


@check("stage_balance", STAGE_BALANCE)
def _(t: Tables):
    """Every raw row of every source is staged, a duplicate, rejected or outside the window."""
    trip_rules, weather_rules, station_rules = bike.trip_rules("CITI", "citibike_trips"), bike.weather_rules(), bike.station_rules()
    trips_in, hours, stations = odd_trips(t), odd_weather(t), t.raw_stations
    return dedup.union_all(
        bike.stage_balance(trips_in, bike.stage_trips(trips_in, trip_rules, CTX), trip_rules, "trips", CTX),
        bike.stage_balance(hours, bike.stage_weather(hours, CTX, weather_rules), weather_rules, "weather", CTX),
        bike.stage_balance(stations, bike.stage_stations(stations, CTX, station_rules), station_rules, "stations", CTX),
    )


def feeds(t: Tables):
    yield odd_trips(t), "trips", bike.trip_rules("CITI", "citibike_trips")
    yield odd_weather(t), "weather", bike.weather_rules()
    yield t.raw_stations, "stations", bike.station_rules()


@check("stage_balance_measured", STAGE_BALANCE)
def _(t: Tables):
    """The same from counts taken while the rows are staged."""
    done = [(bike.stage_measured(raw, kind, rule_set, CTX), rule_set) for raw, kind, rule_set in feeds(t)]
    return dedup.union_all(*[bike.measured_balance(staged, rule_set) for staged, rule_set in done])


@check("dq_summary_measured", SUMMARY_SQL)
def _(t: Tables):
    """The summary of a staging run, without a pass of its own."""
    rule_set = TRIP_RULES("CITI", "citibike_trips")
    staged = bike.stage_measured(t.raw_trips, "trips", rule_set, CTX)
    return rules.dq_summary(t.raw_trips, rule_set, "run", staged.counts, staged.repeated()).drop("source_name", "load_run_id")


@check(
    "cdc_fingerprint_measured",
    f"select coalesce(f, '(unknown)') as source_file, n as row_count, true as same"
    f" from (select source_file as f, count(*) as n from {ODD_TRIPS} r group by source_file) g",
)
def _(t: Tables):
    """Files of a staging run: their fingerprints are those of a pass of their own."""
    raw, kind, rule_set = next(iter(feeds(t)))
    mine = bike.stage_measured(raw, kind, rule_set, CTX).fingerprints()
    own = cdc.fingerprint(raw, ["source_file"], bike.LINEAGE_COLUMNS)
    both = mine.join(own.withColumnsRenamed({"row_count": "n", "fingerprint": "print"}), "source_file", "full")
    same = F.coalesce((F.col("fingerprint") == F.col("print")) & (F.col("row_count") == F.col("n")), F.lit(False))
    return both.select("source_file", "row_count", same.alias("same"))


@check(
    "land_trips",
    "select nullif(trim(ride_id), '') as ride_id, nullif(trim(started_at), '') as started_at,"
    " nullif(trim(start_station_id), '') as start_station_id, case when regexp_matches(started_at,"
    " '^20[0-9]{2}-(0[1-9]|1[0-2])') then substr(started_at, 1, 4) || substr(started_at, 6, 2) end as trip_month,"
    " 'CHI' as source_city_code, 'land' as load_run_id, count(*) as n from raw_trips group by all",
)
def _(t: Tables):
    """Trips go out as files and are landed again; every row has a place of its own in its file."""
    path = scratch_path(t.spark, "land")
    sinks.export_csv(t.raw_trips.select(*bike.TRIP_FIELDS), path)
    sinks.export_jsonl(t.events.select("event_id"), f"{path}/other")
    raw = landing.land_trips(t.spark, path, r"\.csv$", "CHI", RunContext("land", CTX.started_at, cet=CTX.cet))
    raw = raw.dropDuplicates(["source_file", "source_row_number"])
    shown = [clean.blank_to_null(c).alias(c) for c in ("ride_id", "started_at", "start_station_id")]
    keys = ["ride_id", "started_at", "start_station_id", "trip_month", "source_city_code", "load_run_id"]
    return raw.select(*shown, *keys[3:]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@check(
    "land_practice",
    f"""select '2024/07/0' || b || ' 00:00:00' as batch_id, o_custkey as user_id, count(*) as n,
  {num('sum(o_totalprice)')} as rating, {ts('max(o_orderdate)')} as rated_at
from orders, (values (1), (2)) v(b) where b = 2 or o_orderkey % 2 = 0 group by all""",
)
def _(t: Tables):
    """Two batches of exported ratings; the second one runs twice."""
    target, stamp = scratch_path(t.spark, "practice"), F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss.SSS")
    for number, cond in ((1, "o_orderkey % 2 = 0"), (2, "true"), (2, "true")):
        path = scratch_path(t.spark, "ratings")
        exported = t.orders.filter(cond).select(
            F.col("o_orderkey").alias("rating_id"),
            F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("user_id"),
            F.col("o_orderpriority").alias("movie_id"),
            F.col("o_totalprice").alias("rating"),
            stamp.alias("rated_at"),
            stamp.alias("last_update_timestamp"),
        )
        sinks.export_csv(exported, path)
        landing.load_exports(t.spark, {"ratings": path}, target, RunContext("b", datetime(2024, 7, number), cet=CTX.cet))
    rows = t.spark.read.parquet(f"{target}/stg_ratings")
    return rows.groupBy("batch_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("rating"), F.max("rated_at").alias("rated_at")
    )
