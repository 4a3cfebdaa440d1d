"""Default configuration: the bike-share sources, their rules and staging casts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.functions import clean, measures
from tidemark.operators import profile, skew
from tidemark.operators.dedup import dedup_first
from tidemark.operators.incremental import in_window
from tidemark.operators.rules import DuplicateRule, Rule, RuleSet, accept_rows, accepted, summary_metrics
from tidemark.session import materialize

TRIP_FIELDS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
]
WEATHER_FIELDS = [
    "noaa_station_id",
    "observation_ts",
    "report_type",
    "hourly_dry_bulb_temperature",
    "hourly_precipitation",
    "hourly_wind_speed",
    "hourly_present_weather_type",
]
STATION_FIELDS = [
    "gbfs_station_id",
    "station_name",
    "short_name",
    "longitude",
    "latitude",
    "capacity",
    "station_type",
    "region_id",
]


def _filled(c: str) -> Column:
    return ~clean.is_blank(c)


def _bad(c: str, pattern: str) -> Column:
    """Present and not of the wanted form."""
    return F.col(c).isNotNull() & clean.not_matching(c, pattern)


def trip_rules(prefix: str, source_name: str, trimmed_keys: bool = False) -> RuleSet:
    """Six rules for a trip feed.

    ``trimmed_keys``: the duplicate details look the trimmed key up in the raw groups;
    otherwise both are raw. The summary always groups raw keys, NULL included.
    """
    # The text must begin like a timestamp, and that timestamp must exist.
    bad_ts = clean.not_matching("started_at", clean.TS_PREFIX) | clean.ts_seconds("started_at").isNull()
    bad_month = F.col("trip_month").isNull() | clean.not_matching("trip_month", clean.YEAR_MONTH)
    has_id, has_start = _filled("ride_id"), _filled("started_at")
    sound = has_id & has_start & ~bad_ts & ~F.coalesce(bad_month, F.lit(True))
    no_start, no_end = clean.is_blank("start_station_id"), clean.is_blank("end_station_id")
    raw_keys = [F.col("source_city_code"), F.col("ride_id")]
    shown = [clean.blank_to_null(k) for k in raw_keys] if trimmed_keys else raw_keys
    return RuleSet(
        source_name=source_name,
        source_table=f"raw_{source_name}",
        key=clean.business_key("ride_id"),
        payload=[*TRIP_FIELDS, "source_city_code", "trip_month"],
        rules=[
            Rule(
                f"{prefix}_NULL_REQUIRED",
                "null",
                "reject",
                "Required field(s) null or blank: ride_id/started_at/source_city_code",
                ~has_id | ~has_start | clean.is_blank("source_city_code"),
            ),
            Rule(
                f"{prefix}_DATATYPE_TIMESTAMP",
                "datatype",
                "reject",
                "started_at is not a timestamp",
                has_id & has_start & bad_ts,
            ),
            Rule(
                f"{prefix}_FORMAT_TRIP_MONTH",
                "format",
                "reject",
                "trip_month is not YYYYMM",
                bad_month,
                guard=has_id,
            ),
            Rule(
                f"{prefix}_REJECT_BOTH_STATION_ID",
                "null",
                "reject",
                "Both start_station_id and end_station_id are null",
                no_start & no_end,
                guard=sound,
                guard_summary=True,
            ),
            Rule(
                f"{prefix}_WARN_STATION_ID",
                "null",
                "warning",
                "Exactly one of start_station_id / end_station_id is null",
                no_start != no_end,
                guard=sound,
                guard_summary=True,
            ),
        ],
        duplicate=DuplicateRule(
            f"{prefix}_DUPLICATE_RIDE",
            "Duplicate (source_city_code, ride_id) in this load run",
            keys=shown,
            group_keys=raw_keys,
            summary_keys=raw_keys,
        ),
    )


def weather_rules() -> RuleSet:
    numeric = ["hourly_dry_bulb_temperature", "hourly_precipitation", "hourly_wind_speed"]
    not_numeric = F.lit(False)
    for c in numeric:
        not_numeric = not_numeric | _bad(c, clean.NUMERIC)
    identified = _filled("noaa_station_id") & _filled("observation_ts")
    keys = [F.col("source_city_code"), F.col("observation_ts")]
    return RuleSet(
        source_name="noaa_lcd",
        source_table="raw_noaa_weather",
        key=clean.business_key("noaa_station_id", "observation_ts"),
        payload=[*WEATHER_FIELDS, "source_city_code"],
        rules=[
            Rule(
                "NOAA_NULL_REQUIRED",
                "null",
                "reject",
                "Required field(s) null or blank: noaa_station_id/observation_ts/source_city_code",
                ~identified | clean.is_blank("source_city_code"),
            ),
            Rule(
                "NOAA_DATATYPE_TIMESTAMP",
                "datatype",
                "reject",
                "observation_ts is not a timestamp",
                identified & clean.ts_iso("observation_ts").isNull(),
            ),
            Rule(
                "NOAA_DATATYPE_NUMERIC",
                "datatype",
                "reject",
                "One or more numeric weather fields contain non-numeric text",
                not_numeric,
                guard=identified,
            ),
            Rule(
                "NOAA_FORMAT_REPORT_TYPE",
                "format",
                "reject",
                "report_type null or not in (FM-15, FM-16, FM-12)",
                clean.is_blank("report_type") | ~F.col("report_type").isin(*measures.REPORT_TYPES),
                guard=identified,
            ),
        ],
        duplicate=DuplicateRule(
            "NOAA_DUPLICATE_HOUR",
            "Duplicate (source_city_code, observation_ts) in this load run",
            keys=keys,
            summary_keys=keys,
        ),
    )


def _outside(c: str, limit: int) -> Column:
    text = F.trim(F.col(c))
    value = F.when(text.rlike(clean.NUMERIC), text.try_cast("decimal(38,10)"))
    return clean.is_blank(c) | value.isNull() | ~value.between(-limit, limit)


def station_rules() -> RuleSet:
    known = _filled("source_city_code") & (_filled("short_name") | _filled("gbfs_station_id"))
    bad_capacity = _filled("capacity") & clean.not_matching(F.trim("capacity"), clean.INTEGER)
    keys = [F.col("source_city_code"), clean.blank_to_null("short_name")]
    return RuleSet(
        source_name="gbfs_station",
        source_table="raw_gbfs_station",
        key=clean.business_key(clean.first_filled("short_name", "gbfs_station_id")),
        payload=[*STATION_FIELDS, "source_city_code"],
        rules=[
            Rule(
                "GBFS_NULL_REQUIRED",
                "null",
                "reject",
                "Required field(s) null or blank: source_city_code and short_name/gbfs_station_id",
                ~known,
            ),
            Rule(
                "GBFS_DATATYPE_CAPACITY",
                "datatype",
                "reject",
                "capacity contains non-integer text",
                bad_capacity,
                guard=known,
            ),
            Rule(
                "GBFS_FORMAT_COORDINATE",
                "format",
                "reject",
                "latitude or longitude missing, non-numeric, or out of coordinate range",
                _outside("latitude", 90) | _outside("longitude", 180),
                guard=known & ~F.coalesce(bad_capacity, F.lit(False)),
            ),
        ],
        duplicate=DuplicateRule(
            "GBFS_DUPLICATE_STATION",
            "Duplicate (source_city_code, short_name) in this load run",
            keys=keys,
            summary_keys=keys,
            summary_skips_null=True,
        ),
    )


def user_push_checks() -> list[tuple[Column, str]]:
    """Checks of a pushed user in order; the first failing one is the answer."""
    email = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"

    def no(cond: Column) -> Column:
        return ~F.coalesce(cond, F.lit(False))

    return [
        (no(F.col("operation").isin("INSERT", "UPDATE", "DELETE")), "Invalid operation"),
        (no(F.col("user_id") > 0), "Invalid user_id"),
        (clean.is_blank("username"), "Invalid username"),
        (no(F.col("email").rlike(email)), "Invalid email"),
        (no(F.col("age") > 0), "Invalid age"),
        (no(F.col("gender").isin("M", "F")), "Invalid gender"),
        (F.col("created_at").isNull() | F.col("last_update_timestamp").isNull(), "Missing timestamps"),
    ]


def station_push_checks(city_codes: tuple = ("CHI", "NYC")) -> list[tuple[Column, str]]:
    """Checks of a pushed station; ``city_sk`` is the looked-up key."""

    def no(cond: Column) -> Column:
        return ~F.coalesce(cond, F.lit(False))

    return [
        (no(F.col("operation").isin("INSERT", "UPDATE", "DELETE")), "Invalid operation"),
        (no(F.col("source_city_code").isin(*city_codes)), "Invalid source_city_code"),
        (clean.is_blank("short_name"), "Invalid station's short_name"),
        (F.col("city_sk").isNull(), "Unknown source_city_code in NDS city"),
    ]


def stage_trips(raw: DataFrame, rules: RuleSet, ctx: RunContext) -> DataFrame:
    """Accepted, typed trips of the pull window, one per (city, ride)."""
    typed = (
        accept_rows(raw, rules)
        .withColumn("__started", clean.ts_seconds("started_at"))
        .filter(in_window("__started", ctx.lset, ctx.cet, ctx.lookback_days))
    )
    if ctx.month != "ALL":
        typed = typed.filter(F.col("trip_month") == ctx.month)
    text = ["rideable_type", "start_station_name", "start_station_id", "end_station_name", "end_station_id"]
    cast = typed.select(
        clean.blank_to_null("source_city_code").alias("source_city_code"),
        clean.blank_to_null("ride_id").alias("ride_id"),
        *[clean.blank_to_null(c).alias(c) for c in text],
        F.col("__started").alias("started_at"),
        clean.ts_seconds("ended_at").alias("ended_at"),
        *[clean.number(c).alias(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")],
        clean.blank_to_null("member_casual").alias("member_casual"),
        clean.blank_to_null("trip_month").alias("trip_month"),
        "source_file",
        "source_row_number",
    )
    first = dedup_first(cast, ["source_city_code", "ride_id"], ["source_file", "source_row_number"])
    return first.drop("source_row_number").withColumn("loaded_at", F.lit(str(ctx.cet)).cast("timestamp_ntz"))


def window_balance(raw: DataFrame, staged: DataFrame, rules: RuleSet, ts: Column | None, keys: list[Column], ctx: RunContext) -> DataFrame:
    """One row that accounts for every raw row of a load.

    ``raw_rows`` = staged + duplicates + rejected + outside the window; ``difference`` is
    what is left, 0 unless a step lost rows. Duplicates are the further rows of a key.
    """
    accepted = accept_rows(raw, rules).withColumn("__ts", F.lit(None).cast("timestamp_ntz") if ts is None else ts)
    inside = F.lit(True) if ts is None else F.coalesce(in_window("__ts", ctx.lset, ctx.cet, ctx.lookback_days), F.lit(False))
    if ts is not None and ctx.month != "ALL":
        inside = inside & (F.col("trip_month") == ctx.month)
    per_key = accepted.withColumn("__in", inside).groupBy("__in", F.struct(*keys).alias("__k")).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("accepted_rows"),
        F.coalesce(F.sum(F.when(~F.col("__in"), F.col("n"))), F.lit(0)).alias("outside_rows"),
        F.coalesce(F.sum(F.when(F.col("__in"), F.col("n") - 1)), F.lit(0)).alias("duplicate_rows"),
    )
    one = raw.agg(F.count(F.lit(1)).alias("raw_rows")).crossJoin(counts)  # one row each
    one = one.crossJoin(staged.agg(F.count(F.lit(1)).alias("staged_rows")))
    out = one.select(
        F.lit(rules.source_name).alias("source_name"),
        "raw_rows",
        "staged_rows",
        "duplicate_rows",
        (F.col("raw_rows") - F.col("accepted_rows")).alias("rejected_rows"),
        "outside_rows",
    )
    parts = F.col("staged_rows") + F.col("duplicate_rows") + F.col("rejected_rows") + F.col("outside_rows")
    return out.withColumn("difference", F.col("raw_rows") - parts)


def balance_inputs(rules: RuleSet, kind: str, ctx: RunContext) -> tuple[Column, Column, Column]:
    """Of a feed (``trips``, ``weather`` or ``stations``): whether a row is in the window, whether it is accepted, its key.

    The window is judged by the column ``__ts``, as ``timed`` adds it.
    """
    if kind == "stations":
        inside = F.lit(True)
    else:
        inside = F.coalesce(in_window("__ts", ctx.lset, ctx.cet, ctx.lookback_days), F.lit(False))
        if kind == "trips" and ctx.month != "ALL":
            inside = inside & F.coalesce(F.col("trip_month") == ctx.month, F.lit(False))
    return inside, accepted(rules), F.struct(*_stage_key(kind))


def timed(raw: DataFrame, kind: str) -> DataFrame:
    """``raw`` with the time that decides the window as ``__ts``."""
    if kind == "stations":
        return raw
    return raw.withColumn("__ts", clean.ts_seconds("started_at") if kind == "trips" else clean.ts_iso("observation_ts"))


def _stage_key(kind: str) -> list[Column]:
    city = clean.blank_to_null("source_city_code")
    if kind == "trips":
        return [city, clean.blank_to_null("ride_id")]
    if kind == "weather":
        return [city, clean.ts_iso("observation_ts")]
    return [city, clean.first_filled("short_name", "gbfs_station_id")]


def stage_balance(raw: DataFrame, staged: DataFrame, rules: RuleSet, kind: str, ctx: RunContext) -> DataFrame:
    """``window_balance`` of a feed: ``trips``, ``weather`` or ``stations``."""
    ts = {"trips": clean.ts_seconds("started_at"), "weather": clean.ts_iso("observation_ts")}.get(kind)
    return window_balance(raw, staged, rules, ts, _stage_key(kind), ctx)


@dataclass(frozen=True)
class Staged:
    """Staged rows, the counts taken while they were written, and the profile of what was landed."""

    rows: DataFrame
    counts: Mapping[str, int]
    profile: DataFrame

    def repeated(self) -> DataFrame:
        """The repeated keys of the duplicate rule."""
        return profile.repeated(self.profile, "copies")

    def fingerprints(self) -> DataFrame:
        return profile.fingerprints(self.profile)


def stage_measured(landed: DataFrame, kind: str, rules: RuleSet, ctx: RunContext) -> Staged:
    """Stage a feed (``trips``, ``weather`` or ``stations``) and measure it, in two passes over the landed rows.

    The first pass writes the staged rows and counts, on its way, what summary, load counts
    and balance need. The second groups keys and files. Only the findings need a third.
    """
    if kind == "trips":
        load = lambda df: stage_trips(df, rules, ctx)
    else:
        load = lambda df: (stage_weather if kind == "weather" else stage_stations)(df, ctx, rules)
    inside, fine, key = balance_inputs(rules, kind, ctx)
    offered = F.lit(True) if kind == "stations" else in_window("__ts", ctx.lset, ctx.cet, ctx.lookback_days)
    timed_rows = timed(landed, kind)
    metrics = {
        **summary_metrics(rules),
        "offered": F.count_if(F.coalesce(offered, F.lit(False))),
        "accepted_rows": F.count_if(fine),
        "outside_rows": F.count_if(fine & ~inside),
    }
    rows, counts = profile.measured(timed_rows, metrics, lambda df: materialize(load(df), f"staged-{kind}"))
    dup = rules.duplicate
    keys = {"copies": skew.struct_key(dup.keys if dup.group_keys is None else dup.group_keys), "staged": F.when(fine & inside, key)}
    lineage = [c for c in (*LINEAGE_COLUMNS, "__ts") if c in timed_rows.columns]
    return Staged(rows, {**counts, "raw_rows": counts["__total"]}, materialize(profile.profile(timed_rows, keys, lineage), "profile"))


# What a landed row says of its load, not of its source.
LINEAGE_COLUMNS = ("raw_loaded_at", "load_run_id", "source_row_number")


def measured_balance(staged: Staged, rules: RuleSet) -> DataFrame:
    """``window_balance`` of a measured load; duplicates come from the repeated keys of accepted rows in the window."""
    repeated = profile.repeated(staged.profile, "staged")
    spare = repeated.agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("duplicate_rows"))
    one = spare.crossJoin(staged.rows.agg(F.count(F.lit(1)).alias("staged_rows")))  # one row each
    known = {c: F.lit(staged.counts[c]).cast("bigint") for c in ("raw_rows", "accepted_rows", "outside_rows")}
    out = one.withColumns(known).select(
        F.lit(rules.source_name).alias("source_name"),
        "raw_rows",
        "staged_rows",
        "duplicate_rows",
        (F.col("raw_rows") - F.col("accepted_rows")).alias("rejected_rows"),
        "outside_rows",
    )
    parts = F.col("staged_rows") + F.col("duplicate_rows") + F.col("rejected_rows") + F.col("outside_rows")
    return out.withColumn("difference", F.col("raw_rows") - parts)


def stage_weather(raw: DataFrame, ctx: RunContext, rules: RuleSet | None = None) -> DataFrame:
    """Accepted, typed weather rows of the window, one per (city, observation time)."""
    typed = accept_rows(raw, rules or weather_rules()).withColumn("__ts", clean.ts_iso("observation_ts"))
    cast = typed.filter(in_window("__ts", ctx.lset, ctx.cet, ctx.lookback_days)).select(
        clean.blank_to_null("source_city_code").alias("source_city_code"),
        clean.blank_to_null("noaa_station_id").alias("noaa_station_id"),
        F.col("__ts").alias("observation_ts"),
        clean.blank_to_null("report_type").alias("report_type"),
        clean.dirty_number("hourly_dry_bulb_temperature", "decimal(8,2)").alias("hourly_dry_bulb_temperature"),
        clean.dirty_number("hourly_precipitation", "decimal(10,2)").alias("hourly_precipitation"),
        clean.dirty_number("hourly_wind_speed", "decimal(8,2)").alias("hourly_wind_speed"),
        clean.blank_to_null("hourly_present_weather_type").alias("hourly_present_weather_type"),
        "source_file",
        "source_row_number",
    )
    first = dedup_first(cast, ["source_city_code", "observation_ts"], ["source_file", "source_row_number"])
    return first.drop("source_file", "source_row_number").withColumn(
        "loaded_at", F.lit(str(ctx.cet)).cast("timestamp_ntz")
    )


def stage_stations(raw: DataFrame, ctx: RunContext, rules: RuleSet | None = None) -> DataFrame:
    """Accepted, typed stations; a missing short name falls back to the feed id."""
    cast = accept_rows(raw, rules or station_rules()).select(
        clean.blank_to_null("source_city_code").alias("source_city_code"),
        clean.blank_to_null("gbfs_station_id").alias("gbfs_station_id"),
        clean.first_filled("short_name", "gbfs_station_id").alias("short_name"),
        clean.blank_to_null("station_name").alias("station_name"),
        clean.number("latitude").alias("latitude"),
        clean.number("longitude").alias("longitude"),
        clean.integer("capacity").alias("capacity"),
        clean.blank_to_null("station_type").alias("station_type"),
        clean.blank_to_null("region_id").alias("region_id"),
        F.lit("open").alias("station_status"),
        F.lit("UPDATE").alias("operation"),
        "source_file",
        "source_row_number",
    )
    first = dedup_first(cast, ["source_city_code", "short_name"], ["source_file", "source_row_number"])
    return first.drop("source_file", "source_row_number").withColumn(
        "loaded_at", F.lit(str(ctx.cet)).cast("timestamp_ntz")
    )


def with_pushes(staged: DataFrame, pushes: DataFrame, ctx: RunContext) -> DataFrame:
    """Staged stations with the accepted pushed operations of the window in place of their feed rows."""
    fresh = pushes.filter(in_window("sent_at", ctx.lset, ctx.cet, 0)).withColumn(
        "loaded_at", F.lit(str(ctx.cet)).cast("timestamp_ntz")
    )
    typed = fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in staged.schema])
    key = ["source_city_code", "short_name"]
    return staged.join(typed.select(*key), key, "left_anti").unionByName(typed)
