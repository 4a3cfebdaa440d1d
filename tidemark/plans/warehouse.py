"""The daily run: sources -> staging -> normalised layer -> star, as plain calls.

Small tables are written as one snapshot per run, read from the previous run's. The trip
and the fact table lie by run and month: a run writes the months it touches, and a small
index says which run holds the current rows of a month and from when to when they reach.
No run writes over another's files, so one that is repeated, wherever it stopped, starts
from the same tables and gives the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.functions import measures
from tidemark.operators import audit, cdc, dims, flow, incremental, keyindex, leakage, lookup, match, reconcile, rules, scd, upsert
from tidemark.operators.dedup import union_all
from tidemark.plans import bike, loads
from tidemark.session import delete, materialize, run_folder
from tidemark.sources.sinks import replace_run, write_replace

SCHEMAS = {
    "control": "source_name string, table_name string, lset timestamp_ntz, cet timestamp_ntz, lookback_days int,"
    " status string, row_count bigint",
    "manifest": "source_name string, source_file string, row_count bigint, fingerprint string",
    "city": "city_sk bigint, city_code string, city_name string, timezone string, noaa_station_id string,"
    " gbfs_system_id string",
    "calendar_day": "calendar_date date, day_of_week int, is_weekend boolean, month int, season string",
    "station": "station_sk bigint, city_sk bigint, source_station_id string, station_name string,"
    " latitude decimal(12,8), longitude decimal(12,8), capacity int, station_status string, row_status string,"
    " is_current boolean, effective_from timestamp_ntz, effective_to timestamp_ntz, loaded_at timestamp_ntz",
    "weather": "city_sk bigint, observation_hour timestamp_ntz, report_type string, temperature_c decimal(8,2),"
    " precipitation_mm decimal(10,2), wind_speed_ms decimal(8,2), present_weather string, weather_category string,"
    " loaded_at timestamp_ntz",
    "backlog": "source_city_code string, ride_id string, rideable_type string, start_station_name string,"
    " start_station_id string, end_station_name string, end_station_id string, started_at timestamp_ntz,"
    " ended_at timestamp_ntz, start_lat decimal(12,8), start_lng decimal(12,8), end_lat decimal(12,8),"
    " end_lng decimal(12,8), member_casual string, trip_month string, source_file string, loaded_at timestamp_ntz",
    "trip": "city_sk bigint, ride_id string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz,"
    " start_station_id string, end_station_id string, start_station_sk bigint, end_station_sk bigint,"
    " start_lat decimal(12,8), start_lng decimal(12,8), end_lat decimal(12,8), end_lng decimal(12,8),"
    " member_casual string, duration_minutes decimal(10,2), loaded_at timestamp_ntz, updated_at timestamp_ntz,"
    " trip_month string",
    "dim_station": "station_sk bigint, city_sk bigint, source_station_id string, station_name string,"
    " latitude decimal(12,8), longitude decimal(12,8), capacity int, station_status string,"
    " effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, version bigint",
    "fact": "station_sk bigint, datetime_sk int, weather_condition_sk int, trips_started bigint, trips_ended bigint,"
    " net_flow bigint, abs_imbalance bigint, member_trip_count bigint, casual_trip_count bigint,"
    " electric_trip_count bigint, classic_trip_count bigint, avg_duration_member_minutes decimal(10,2),"
    " avg_duration_casual_minutes decimal(10,2), temperature decimal(8,2), precipitation decimal(10,2),"
    " wind_speed decimal(8,2), loaded_at timestamp_ntz, month string",
    "grains": "city_sk bigint, source_station_id string, date_hour timestamp_ntz",
}
MONTHLY = {"trip": "trip_month", "fact": "month"}
# Key indexes beside a monthly table, by kind: the rows that are indexed, and the key.
INDEXED = {
    "trip": {
        "ride": [("true", {c: c for c in loads.TRIP_KEY})],
        "open": [
            (f"{sk} is null and {source_id} is not null", {"city_sk": "city_sk", source_id: "source_station_id"})
            for source_id, sk in loads.ID_TO_SK.items()
        ],
    }
}
# The hours that the rows of a month reach; a trip may end in a later month. NULL times are passed over.
REACH = {
    "trip": ("least(started_at, ended_at)", "greatest(started_at, ended_at)"),
    "fact": ("to_timestamp_ntz(cast(datetime_sk as string), 'yyyyMMddHH')",) * 2,
}
INDEX = "month string, run string, low timestamp_ntz, high timestamp_ntz"


@dataclass(frozen=True)
class Warehouse:
    """Tables below ``root``; ``previous`` is the run whose tables are read."""

    spark: SparkSession
    root: str
    run: str
    previous: str | None = None

    def _empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], SCHEMAS[name])

    def path(self, name: str, run: str | None = None) -> str:
        return f"{self.root}/{name}/run-{run or self.run}"

    def index(self, name: str, run: str | None) -> DataFrame:
        """One row per month that the run left: which run holds it, and the hours it reaches."""
        if run is None:
            return self.spark.createDataFrame([], INDEX)
        return self.spark.read.schema(INDEX).parquet(self.path(f"{name}_months", run))

    def _monthly(self, name: str, index: DataFrame, side: str = "", schema: str | None = None) -> DataFrame:
        """The indexed months of a table, or of what lies beside it."""
        col, base, schema = MONTHLY[name], f"{self.root}/{name}{side}", schema or SCHEMAS[name]
        paths = [f"{base}/run={r['run']}/{col}={r['month']}" for r in index.collect()]  # months only
        empty = self.spark.createDataFrame([], schema)
        if not paths:
            return empty
        every = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return every.select(*empty.columns)

    def _of(self, name: str, run: str | None, hours: DataFrame | None) -> DataFrame:
        index = self.index(name, run)
        if hours is not None:  # the column date_hour
            days = hours.select(F.to_date("date_hour").alias("__day")).distinct()
            index = index.join(days, F.col("__day").between(F.to_date("low"), F.to_date("high")), "left_semi")
        return self._monthly(name, index)

    def before(self, name: str, hours: DataFrame | None = None) -> DataFrame:
        """The table as the run found it; a monthly one, only the months that reach ``hours``."""
        if name in MONTHLY:
            return self._of(name, self.previous, hours)
        if self.previous is None:
            return self._empty(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name, self.previous))

    def now(self, name: str, hours: DataFrame | None = None) -> DataFrame:
        """The table as the run left it; a monthly one, only the months that reach ``hours``."""
        if name in MONTHLY:
            return self._of(name, self.run, hours)
        reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
        return reader.parquet(self.path(name))

    def months(self, name: str, months: DataFrame) -> DataFrame:
        """The given months of a monthly table as the run found it."""
        return self._monthly(name, self.index(name, self.previous).join(months.toDF("month"), "month", "left_semi"))

    def spanning(self, name: str, spans: DataFrame) -> DataFrame:
        """Months of the table as the run found it that reach into ``low`` to ``high`` (NULL: open) of some span."""
        s = spans.agg(F.min("low").alias("__low"), F.max(F.coalesce("high", F.lit(lookup.END_OF_TIME).cast("timestamp_ntz"))).alias("__high"))
        found = self.index(name, self.previous).crossJoin(s)  # one row
        return found.filter("high >= __low and low < __high").select("month")

    def months_holding(self, name: str, kind: str, wanted: DataFrame) -> DataFrame:
        """Months of the table as the run found it that may hold a key of ``wanted``, by the index alone."""
        keys, col = list(INDEXED[name][kind][0][1].values()), MONTHLY[name]
        schema = f"kind string, {keyindex.SCHEMA}, {col} string"
        stored = self._monthly(name, self.index(name, self.previous), "_keys", schema).filter(F.col("kind") == kind)
        found = keyindex.parts_holding(stored, wanted.select(*keys), keys, [col])
        return materialize(found.withColumnRenamed(col, "month"), f"{name}-months")

    def _write_keys(self, name: str, written: DataFrame) -> None:
        """The key indexes of the months that the run wrote."""
        col, every = MONTHLY[name], []
        for kind, sources in INDEXED[name].items():
            rows = [written.filter(cond).select(col, *[F.col(c).alias(a) for c, a in keys.items()]) for cond, keys in sources]
            index = keyindex.key_index(union_all(*rows), list(sources[0][1].values()), [col])
            every.append(index.withColumn("kind", F.lit(kind)))
        write_replace(union_all(*every), f"{self.root}/{name}_keys/run={self.run}", [col])

    def write(self, name: str, df: DataFrame) -> DataFrame:
        if name in SCHEMAS:
            want = self._empty(name).schema
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want])
        write_replace(df, self.path(name))
        return self.now(name)

    def replace_months(self, name: str, rows: DataFrame, touched: DataFrame) -> None:
        """``rows`` become the whole content of the touched months; a month left without rows is gone."""
        col = MONTHLY[name]
        want = self._empty(name).schema
        out = f"{self.root}/{name}/run={self.run}"
        write_replace(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want]), out, [col])
        low, high = REACH[name]
        written = self.spark.read.schema(SCHEMAS[name]).parquet(out)
        new = written.groupBy(F.col(col).alias("month")).agg(F.min(F.expr(low)).alias("low"), F.max(F.expr(high)).alias("high"))
        new = new.withColumn("run", F.lit(self.run)).select("month", "run", "low", "high")
        if name in INDEXED:
            self._write_keys(name, written)
        kept = self.index(name, self.previous).join(touched.toDF("month"), "month", "left_anti")
        write_replace(kept.unionByName(new), self.path(f"{name}_months"))


def stage(wh: Warehouse, raw: Mapping[str, DataFrame], ctx: RunContext, pushes: DataFrame | None = None) -> None:
    """Check, type and stage the landed rows; write findings, counts and file changes.

    ``raw`` holds ``trips:<source name>:<rule prefix>`` entries, ``weather`` and ``stations``.
    ``pushes``: accepted master operations, as ``changes.latest_staging`` gives them.
    """
    control = wh.before("control")
    staged_trips, runs, prints, summaries, balances = [], [], [], [], []
    for entry, landed in raw.items():
        kind, _, rest = entry.partition(":")
        source, _, prefix = rest.partition(":")
        if kind == "trips":
            rule_set = bike.trip_rules(prefix, source, trimmed_keys=prefix == "DIVVY")
        else:
            rule_set = bike.weather_rules() if kind == "weather" else bike.station_rules()
        table = f"stg_{rule_set.source_name}"
        days = 0 if kind == "stations" else ctx.lookback_days
        window = incremental.read_watermark(control, rule_set.source_name, table, ctx)
        window = window.with_watermark(min(window.lset, window.cet), days)
        staged = bike.stage_measured(landed, kind, rule_set, window)
        if kind == "trips":
            staged_trips.append(staged.rows)
        else:
            pushed = kind == "stations" and pushes is not None
            wh.write(f"stg_{kind}", bike.with_pushes(staged.rows, pushes, window) if pushed else staged.rows)
        # The third and last pass over the landed rows.
        findings = rules.dq_details(landed, rule_set, repeated=staged.repeated())
        replace_run(findings, f"{wh.root}/dq_details/{rule_set.source_name}")
        summaries.append(rules.dq_summary(landed, rule_set, ctx.load_run_id, staged.counts, staged.repeated()))
        runs.append(audit.load_counts(staged.counts["offered"], staged.rows, rule_set.source_name, table))
        balances.append(bike.measured_balance(staged, rule_set))
        prints.append(staged.fingerprints().withColumn("source_name", F.lit(rule_set.source_name)))
    # Trips that wait for their master are offered again; a newer version wins.
    fresh = union_all(*staged_trips)
    waiting = wh.before("backlog").join(fresh, ["source_city_code", "ride_id"], "left_anti")
    wh.write("stg_trips", fresh.unionByName(waiting.select(*fresh.columns)))
    summary = materialize(union_all(*summaries), "summary")
    replace_run(summary, f"{wh.root}/dq_summary")
    replace_run(rules.dq_rollup(summary), f"{wh.root}/dq_rollup")
    wh.write("stage_balance", union_all(*balances))
    counts = materialize(union_all(*runs), "counts")
    replace_run(audit.job_log(counts, ctx, "stage"), f"{wh.root}/job_log/stage")
    stamp = F.lit(str(ctx.cet)).cast("timestamp_ntz")
    state = counts.select("source_name", "table_name", stamp.alias("cet"), "status",
                          F.col("success_rows_count").alias("row_count"), F.lit(ctx.lookback_days).alias("lookback_days"))
    wh.write("control", incremental.advance_watermark(control, state))
    classified = cdc.classify_change(union_all(*prints), wh.before("manifest"), ["source_name", "source_file"])
    wh.write("changes", classified)
    wh.write("manifest", cdc.update_manifest(wh.before("manifest"), wh.now("changes"), ["source_name", "source_file"]))


def normalise(wh: Warehouse, ctx: RunContext) -> None:
    """Masters first, then trips: pending ones go to the backlog, touched months are rewritten."""
    rules.dq_gate(wh.now("control"))
    trips, stations, hours = (wh.now(n) for n in ("stg_trips", "stg_stations", "stg_weather"))
    city = wh.write("city", loads.load_city(wh.before("city"), [trips, stations, hours]))
    frames = [(trips, "started_at"), (trips, "ended_at"), (hours, "observation_ts")]
    wh.write("calendar_day", loads.load_calendar(wh.before("calendar_day"), frames))
    station = wh.write("station", loads.load_stations(wh.before("station"), stations, city, ctx))
    weather = wh.write("weather", loads.load_weather(wh.before("weather"), hours, city, ctx))
    resolved = materialize(loads.resolve_trips([trips], city, station, ctx), "resolved")

    # Rows to write: this run's trips, and stored trips whose station arrived in this run.
    arrived = station.select(*loads.STATION_KEY).join(wh.before("station"), loads.STATION_KEY, "left_anti").distinct()
    arrived = materialize(arrived, "arrived")
    ready, pending = lookup.split_pending(resolved, loads.ID_TO_SK)
    source = ready.select(*loads.TRIP_COLUMNS)
    if not arrived.isEmpty():
        waiting = wh.months("trip", wh.months_holding("trip", "open", arrived))
        late, _ = loads.reresolve(waiting, station.join(arrived, loads.STATION_KEY, "left_semi"), ctx)
        late = late.join(ready.select(*loads.TRIP_KEY), loads.TRIP_KEY, "left_anti")
        source = source.unionByName(late.select(*loads.TRIP_COLUMNS))
    source = materialize(source, "source")
    # A ride may lie in another month than its new version: the months that the key index names are read.
    stored = wh.months("trip", wh.months_holding("trip", "ride", source))
    old = stored.join(source.select(*loads.TRIP_KEY), loads.TRIP_KEY, "left_semi")
    old = materialize(old, "old")
    touched = materialize(union_all(source.select("trip_month"), old.select("trip_month")).distinct(), "months")
    after, _ = loads.load_trips(wh.months("trip", touched), source, ctx)
    after = materialize(after, "after")
    changed = after.filter(F.col("updated_at") == F.lit(str(ctx.cet)).cast("timestamp_ntz"))
    gone = old.join(changed.select(*loads.TRIP_KEY), loads.TRIP_KEY, "left_semi")
    grains = incremental.affected_grains(changed, gone)
    acts = upsert.upsert_actions(wh.before("weather"), weather, ["city_sk", "observation_hour"], null_keys=False,
                                 insert_only=["loaded_at"])
    wet = acts.filter("action in ('insert', 'update')").select("city_sk", "observation_hour")
    wet = materialize(wet, "weather-changes")
    wh.write("grains", grains.unionByName(incremental.weather_grains(fact_grains(wh, wet), wet)).distinct())
    wh.write("backlog", upsert.matching(trips, pending, ["source_city_code", "ride_id"]))
    wh.replace_months("trip", after, touched)
    parts = {"city": city, "station": station, "weather": weather, "trip": source}
    log_counts(wh, ctx, "normalise", audit.candidate_counts(parts, pending))


def log_counts(wh: Warehouse, ctx: RunContext, job: str, counts: DataFrame) -> None:
    """Candidate counts of a layer and its line in the job log."""
    counts = wh.write(f"candidates_{job}", counts)
    line = counts.select(
        F.lit(job).alias("source_name"),
        F.lit("SUCCESS").alias("status"),
        "total_rows_count",
        "success_rows_count",
        (F.col("total_rows_count") - F.col("success_rows_count")).alias("failed_rows_count"),
    )
    replace_run(audit.job_log(line, ctx, job), f"{wh.root}/job_log/{job}")


def fact_grains(wh: Warehouse, wet: DataFrame) -> DataFrame:
    """Station-hours of the stored fact in the months of the given city-hours."""
    fact = wh.before("fact", wet.withColumnRenamed("observation_hour", "date_hour"))
    hours = fact.select("station_sk", F.expr(REACH["fact"][0]).alias("date_hour"))
    return hours.join(wh.before("dim_station").select("station_sk", *loads.STATION_KEY), "station_sk")


def moved_grains(wh: Warehouse, dim: DataFrame) -> DataFrame:
    """Station-hours of the stored fact for which another version of the station is valid now."""
    before = wh.before("dim_station")
    spans = materialize(scd.gained_intervals(before, dim, loads.STATION_KEY, "station_sk"), "gained")
    fact = wh.months("fact", wh.spanning("fact", spans)).select("station_sk", F.expr(REACH["fact"][0]).alias("date_hour"))
    hours = fact.join(before.select("station_sk", *loads.STATION_KEY), "station_sk")
    inside = (F.col("date_hour") >= F.col("low")) & (F.col("high").isNull() | (F.col("date_hour") < F.col("high")))
    return hours.join(spans, loads.STATION_KEY).filter(inside).select("city_sk", "source_station_id", "date_hour")


def publish(wh: Warehouse, ctx: RunContext, missing_weather: str = "zero") -> DataFrame:
    """Dimensions and the touched part of the fact; gives the reconciliation report."""
    city, station, weather = (wh.now(n) for n in ("city", "station", "weather"))
    wh.write("dim_city", upsert.upsert(wh.before("city"), city, ["city_code"]))
    # The star has a watermark of its own: it takes up what changed since its last success.
    own = incremental.read_watermark(wh.before("control"), *STAR, ctx)
    dim = wh.write("dim_station", loads.load_dim_station(wh.before("dim_station"), station, min(own.lset, ctx.lset), ctx.cet))
    grains = wh.now("grains").unionByName(moved_grains(wh, dim)).distinct()
    grains = materialize(grains, "grains")
    trips = wh.now("trip", grains)
    days = wh.now("calendar_day").agg(
        F.min("calendar_date").alias("first_day"), F.max("calendar_date").alias("last_day")
    )
    hours = wh.write("dim_datetime", dims.datetime_dim(days))
    classes = wh.write("dim_weather", dims.weather_conditions(wh.spark))
    balance = incremental.reaggregate(trips, grains)
    rows = loads.to_fact(balance, weather, loads.Star(dim, hours, classes), ctx, missing_weather)
    month = F.substring(F.col("datetime_sk").cast("string"), 1, 6)
    rows = materialize(rows.withColumn("month", month), "fact-rows")

    # A touched grain without legs any more leaves the fact, and so does the key of a version no longer valid then.
    hourly = grains.withColumn("datetime_sk", measures.datetime_sk("date_hour"))
    keyed = union_all(
        *[
            lookup.scd2_lookup(hourly, d, loads.STATION_KEY, "date_hour", ["station_sk"]).select(*loads.FACT_KEY)
            for d in (dim, wh.before("dim_station"))
        ]
    )
    keyed = materialize(keyed.filter("station_sk is not null").distinct(), "touched-keys")
    touched = materialize(keyed.select(month.alias("month")).distinct(), "fact-months")
    target = wh.months("fact", touched)
    emptied = keyed.join(rows.select(*loads.FACT_KEY), loads.FACT_KEY, "left_anti")
    target = upsert.delete_matching(target, emptied, loads.FACT_KEY)
    wh.replace_months("fact", loads.load_fact(target, rows), touched)
    log_counts(wh, ctx, "publish", audit.candidate_counts({"grain": grains, "fact": rows}, emptied))
    verify(wh, touched)
    report = reconcile_window(wh, ctx)
    advance_star(wh, ctx, rows)
    return report


def advance_star(wh: Warehouse, ctx: RunContext, rows: DataFrame) -> None:
    """The last step of a run: the star's watermark moves to its extraction time."""
    control = materialize(wh.now("control"), "control")
    stamp = F.lit(str(ctx.cet)).cast("timestamp_ntz")
    done = rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(STAR[0]).alias("source_name"),
        F.lit(STAR[1]).alias("table_name"),
        stamp.alias("cet"),
        F.lit("SUCCESS").alias("status"),
        "row_count",
        F.lit(ctx.lookback_days).alias("lookback_days"),
    )
    wh.write("control", incremental.advance_watermark(control, done))


def reconcile_window(wh: Warehouse, ctx: RunContext) -> DataFrame:
    """Totals of trips and fact over the whole load window, and the station-hours that the fact lacks.

    The window runs from ``lset`` less the lookback to ``cet``, whatever the run touched.
    """
    low = ctx.lset - timedelta(days=ctx.lookback_days)
    day = F.explode(F.sequence(F.lit(str(low)).cast("timestamp_ntz"), F.lit(str(ctx.cet)).cast("timestamp_ntz"), F.expr("interval 1 day")))
    window = wh.spark.range(1).select(day.alias("date_hour"))
    inside = incremental.in_window("date_hour", low, ctx.cet, 0)
    legs = flow.trip_legs(wh.now("trip", window)).filter(inside)
    fact = wh.now("fact", window).withColumn("date_hour", F.expr(REACH["fact"][0])).filter(inside)
    report = reconcile.reconcile_totals(
        legs,
        fact,
        {
            "started": (F.count_if("is_start"), F.sum("trips_started")),
            "ended": (F.count_if(~F.col("is_start")), F.sum("trips_ended")),
        },
    )
    grains = legs.select(*flow.GRAIN).distinct().withColumn("datetime_sk", measures.datetime_sk("date_hour"))
    keyed = lookup.scd2_lookup(grains, wh.now("dim_station"), loads.STATION_KEY, "date_hour", ["station_sk"])
    wh.write("missing_hours", reconcile.missing_rows(keyed.select(*loads.FACT_KEY), fact, loads.FACT_KEY))
    return wh.write("reconciliation", report)


def cleanup(wh: Warehouse) -> None:
    """Staging of the run is freed; trips that wait for their master stay, as the backlog."""
    for name in ("stg_trips", "stg_weather", "stg_stations"):
        delete(wh.spark, wh.path(name))


def assess(wh: Warehouse, ctx: RunContext) -> None:
    """Match the station names of the staged trips with the master, and check for leakage.

    Rows from the future are looked for always; trips across the end of training, and the
    order of the periods, where the context names these.
    """
    trips = wh.now("stg_trips")
    legs = [{"id": f"{end}_station_id", "name": f"{end}_station_name"} for end in ("start", "end")]
    found = match.entities(trips, legs, ["source_city_code"])
    masters = wh.now("stg_stations")
    every = match.match_entities(found, masters, "source_city_code", ["short_name", "gbfs_station_id"], "short_name", "station_name")
    wh.write("entity_matches", match.score_match(match.best_spelling(every, ["source_city_code"])))
    checks = [
        leakage.leak_future(trips, "started_at", ctx.cet, "trips"),
        leakage.leak_future(wh.now("stg_weather"), "observation_ts", ctx.cet, "weather"),
    ]
    if ctx.splits is not None:
        ends = ("train_end", "valid_end", "test_end")
        cutoffs = wh.spark.range(1).select(*[F.lit(str(t)).cast("timestamp_ntz").alias(n) for n, t in zip(ends, ctx.splits)])
        checks.append(leakage.leak_crosses(trips, "started_at", "ended_at", ctx.splits[0], "trips"))
        checks.append(leakage.leak_split_order(cutoffs))
    wh.write("leakage", leakage.leak_status(union_all(*checks)))


def verify(wh: Warehouse, months: DataFrame) -> DataFrame:
    """Identities of the fact in the months that the run wrote: check_name, bad_rows."""
    fact = wh._monthly("fact", wh.index("fact", wh.run).join(months.toDF("month"), "month", "left_semi"))
    counts = ("trips_started", "trips_ended", "member_trip_count", "casual_trip_count", "electric_trip_count", "classic_trip_count")
    negative = F.lit(False)
    for c in counts:
        negative = negative | (F.col(c) < 0)
    known = F.col("member_trip_count") + F.col("casual_trip_count")
    rows = rules.check_constraints(
        fact,
        {
            "null key": F.col("station_sk").isNull() | F.col("datetime_sk").isNull() | F.col("weather_condition_sk").isNull(),
            "net flow": F.col("net_flow") != F.col("trips_ended") - F.col("trips_started"),
            "imbalance": F.col("abs_imbalance") != F.abs("net_flow"),
            "riders": known > F.col("trips_started"),
            "negative count": negative,
            "average without trips": (F.col("member_trip_count") == 0) & F.col("avg_duration_member_minutes").isNotNull()
            | (F.col("casual_trip_count") == 0) & F.col("avg_duration_casual_minutes").isNotNull(),
        },
    )
    return wh.write("fact_checks", rows.unionByName(rules.check_unique(fact, loads.FACT_KEY, "repeated key")))


STAR = ("star", "fact")


def daily_run(
    wh: Warehouse, raw: Mapping[str, DataFrame], ctx: RunContext, pushes: DataFrame | None = None
) -> DataFrame:
    """All steps; what they leave behind for each other is deleted at the end."""
    with run_folder(wh.spark):
        stage(wh, raw, ctx, pushes)
        assess(wh, ctx)
        normalise(wh, ctx)
        report = publish(wh, ctx)
        cleanup(wh)
    return report


def star(wh: Warehouse) -> DataFrame:
    """The star join of the published tables, the base of the cube and the KPIs."""
    from tidemark.plans.kpi import star_join

    return star_join(
        wh.now("fact").drop("month"), wh.now("dim_datetime"), wh.now("dim_station"), wh.now("city"), wh.now("dim_weather")
    )


def tables(names: Sequence[str], wh: Warehouse) -> DataFrame:
    """Row counts of published tables."""
    return audit.total_rows({n: wh.now(n) for n in names})
