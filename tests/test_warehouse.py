"""Whole runs on the hand-checked trips: first load, rerun, and late or changed rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.operators import flow
from tidemark.plans import bike, kpi, loads, warehouse
from tidemark.session import list_names, scratch_path, work_dir

TRIPS = [
    ("CHI_RIDE_001", "classic_bike", "08:05", "08:20", "CHI10001", "CHI10002", "member", "CHI"),
    ("CHI_RIDE_002", "electric_bike", "08:12", "08:35", "CHI10002", "CHI10001", "casual", "CHI"),
    ("CHI_RIDE_003", "electric_bike", "14:10", "14:25", "CHI10001", "CHI10001", "member", "CHI"),
    ("CHI_RIDE_004", "classic_bike", "14:30", "14:48", "CHI10002", "CHI10002", "casual", "CHI"),
    ("NYC_RIDE_001", "electric_bike", "08:15", "08:30", "6602.05", "5514.01", "member", "NYC"),
    ("NYC_RIDE_002", "classic_bike", "08:40", "09:05", "5514.01", "6602.05", "casual", "NYC"),
    ("NYC_RIDE_003", "classic_bike", "14:05", "14:15", "6602.05", "6602.05", "member", "NYC"),
    ("NYC_RIDE_004", "electric_bike", "14:22", "14:42", "5514.01", "5514.01", "casual", "NYC"),
]
STATIONS = [("CHI10001", "CHI"), ("CHI10002", "CHI"), ("6602.05", "NYC"), ("5514.01", "NYC")]
WEATHER = [("CHI", "08", "", "0"), ("CHI", "14", "-RA", "1.5"), ("NYC", "08", "SN", "0.5"), ("NYC", "14", "", "0")]


def frame(spark, fields, data):
    full = [*fields, "source_city_code", "load_run_id", "source_file", "source_row_number"]
    typed = ", ".join(f"{f} {'bigint' if f == 'source_row_number' else 'string'}" for f in [*full, "trip_month"])
    return spark.createDataFrame([tuple(d.get(f) for f in [*full, "trip_month"]) for d in data], typed)


def raw(spark, trips=TRIPS, stations=STATIONS, weather=WEATHER, day="2026-02-15", run="r"):
    rides = [
        dict(ride_id=r, rideable_type=kind, started_at=f"{day} {a}:00.123", ended_at=f"{day} {b}:00.123",
             start_station_id=s, end_station_id=e, member_casual=who, source_city_code=city, trip_month="202602",
             source_file="trips.csv", source_row_number=i, load_run_id=run)
        for i, (r, kind, a, b, s, e, who, city) in enumerate(trips)
    ]
    masters = [
        dict(gbfs_station_id=f"g{s}", short_name=s, station_name=f"Stop {s}", latitude="41.5", longitude="-87.5",
             capacity="15", source_city_code=c, source_file="feed.json", source_row_number=i, load_run_id=run)
        for i, (s, c) in enumerate(stations)
    ]
    hours = [
        dict(noaa_station_id="w", observation_ts=f"{day}T{h}:51:00", report_type="FM-15", source_city_code=c,
             hourly_dry_bulb_temperature="1.5", hourly_precipitation=p, hourly_wind_speed="3",
             hourly_present_weather_type=code, source_file="lcd.csv", source_row_number=i, load_run_id=run)
        for i, (c, h, code, p) in enumerate(weather)
    ]
    return {
        "trips:citibike_trips:CITI": frame(spark, bike.TRIP_FIELDS, rides),
        "weather": frame(spark, bike.WEATHER_FIELDS, hours),
        "stations": frame(spark, bike.STATION_FIELDS, masters),
    }


def ctx(day: int) -> RunContext:
    at = datetime(2026, 2, 15 + day)
    return RunContext(f"r{day}", at, cet=at, lset=datetime(2026, 1, 1))


def fact_rows(wh):
    dim = wh.now("dim_station").select("station_sk", "source_station_id")
    classes = wh.now("dim_weather").select("weather_condition_sk", "weather_category")
    got = wh.now("fact").join(dim, "station_sk").join(classes, "weather_condition_sk")
    cols = ["source_station_id", "datetime_sk", "trips_started", "trips_ended", "net_flow", "member_trip_count",
            "casual_trip_count", "weather_category"]
    return {(r[0], r[1]): tuple(r[2:]) for r in got.select(*cols).collect()}


def rebuilt(wh):
    """The fact measures of a full build from all stored trips."""
    cols = ["source_station_id", "trips_started", "trips_ended", "net_flow"]
    full = flow.station_hour_balance(wh.now("trip"))
    hour = F.date_format("date_hour", "yyyyMMddHH").cast("int")
    return {(r[0], r[4]): tuple(r[1:4]) for r in full.select(*cols, hour).collect()}


@pytest.fixture(scope="module")
def first(spark):
    wh = warehouse.Warehouse(spark, scratch_path(spark, "wh"), "r1")
    report = warehouse.daily_run(wh, raw(spark), ctx(1))
    return wh, report


def test_first_load_gives_the_hand_computed_fact(first):
    wh, report = first
    got = fact_rows(wh)
    assert len(got) == 9
    assert got["6602.05", 2026021508] == (1, 0, -1, 1, 0, "Snow")
    assert got["5514.01", 2026021508] == (1, 1, 0, 0, 1, "Snow")
    assert got["6602.05", 2026021509] == (0, 1, 1, 0, 0, "Clear")
    assert all(v[2] == 0 for (s, _), v in got.items() if s.startswith("CHI"))
    assert got["CHI10001", 2026021514][5] == "Rain"
    assert sum(v[3] + v[4] for v in got.values()) == 8
    assert {r["status"] for r in report.collect()} == {"OK"}
    empty = wh.now("fact").filter("datetime_sk = 2026021509").first()
    assert empty["avg_duration_member_minutes"] is None and empty["avg_duration_casual_minutes"] is None
    assert float(empty["temperature"]) == 0.0
    assert {r["status"] for r in wh.now("control").collect()} == {"SUCCESS"}
    assert {r["change_type"] for r in wh.now("changes").collect()} == {"NEW"}
    checks = {r["check_name"]: r["bad_rows"] for r in wh.now("fact_checks").collect()}
    assert len(checks) == 7 and set(checks.values()) == {0}
    star = wh.now("control").filter("source_name = 'star'").first()
    assert (star["lset"], star["cet"], star["row_count"]) == (datetime(2026, 2, 16), datetime(2026, 2, 16), 9)


def test_a_run_leaves_no_scratch(spark, first):
    """Staging and intermediate results of the first run are gone."""
    assert not [n for n in list_names(spark, work_dir(spark)) if n.startswith("run-")]
    assert not any(list_names(spark, first[0].path(n)) for n in ("stg_trips", "stg_weather", "stg_stations"))


def test_leakage_over_training_periods(spark):
    wh = warehouse.Warehouse(spark, scratch_path(spark, "wh"), "r1")
    at = lambda h, m=0: datetime(2026, 2, 15, h, m)
    run = RunContext("r1", at(23), cet=datetime(2026, 2, 16), lset=datetime(2026, 1, 1), splits=(at(8, 21), at(8, 21), at(12)))
    warehouse.stage(wh, raw(spark), run)
    warehouse.assess(wh, run)
    got = {(r["source_name"], r["rule_code"]): (r["checked_count"], r["leak_count"], r["status"]) for r in wh.now("leakage").collect()}
    assert got["trips", "TRIP_END_CROSSES_TRAIN_CUTOFF"] == (8, 2, "WARNING")
    assert got["mining_split", "TEMPORAL_SPLIT_ORDER"] == (1, 1, "FAIL")
    assert got["trips", "FUTURE_RECORD_AFTER_ETL_CUTOFF"] == (8, 0, "PASS")


def test_kpis_of_the_first_load(first):
    base = kpi.report_base(warehouse.star(first[0]), 2026)
    got = {(r["kpi_code"], r["period"], r["city_code"]): r["actual_value"] for r in kpi.kpi_all(base).collect()}
    assert got["A", "YTD", None] == pytest.approx(2 / 9)
    assert got["B", "2", None] == 0.0 and got["C", "YTD", None] == 0.0 and ("C", "2", None) not in got
    assert got["H", "YTD", None] == 1.0 and got["I", "YTD", None] == 50.0
    assert got["K", "YTD", "CHI"] == 4.0 and got["K", "2", "NYC"] == 4.0
    assert got["E", "YTD", None] == pytest.approx(0.4)


def test_rerun_changes_nothing(spark, first):
    wh, _ = first
    before = (fact_rows(wh), sorted(map(tuple, wh.now("trip").collect())))
    again = warehouse.Warehouse(spark, wh.root, "r1b", previous="r1")
    warehouse.daily_run(again, raw(spark), ctx(2))
    assert (fact_rows(again), sorted(map(tuple, again.now("trip").collect()))) == before
    assert again.now("grains").count() == 0
    assert {r["change_type"] for r in again.now("changes").collect()} == {"UNCHANGED"}


def test_late_changed_and_moved_rows_equal_a_full_build(spark):
    root = scratch_path(spark, "wh")
    one = warehouse.Warehouse(spark, root, "r1")
    # CHI10002 is not known yet: its trips wait.
    warehouse.daily_run(one, raw(spark, stations=[s for s in STATIONS if s[0] != "CHI10002"]), ctx(1))
    assert one.now("backlog").count() == 3 and one.now("trip").count() == 5
    # It arrives; one trip moves to another hour and station, one is new, the weather is corrected.
    moved = ("NYC_RIDE_001", "electric_bike", "10:15", "10:30", "5514.01", "5514.01", "member", "NYC")
    extra = ("NYC_RIDE_009", "classic_bike", "14:50", "15:10", "6602.05", "6602.05", "casual", "NYC")
    trips = [t for t in TRIPS if t[0] != "NYC_RIDE_001"] + [moved, extra]
    hours = [("NYC", "14", "FG", "0") if w[:2] == ("NYC", "14") else w for w in WEATHER]
    two = warehouse.Warehouse(spark, root, "r2", previous="r1")
    report = warehouse.daily_run(two, raw(spark, trips, weather=hours), ctx(2))
    assert two.now("backlog").count() == 0 and two.now("trip").count() == 9
    got = fact_rows(two)
    assert {k: v[:3] for k, v in got.items()} == rebuilt(two)
    assert ("6602.05", 2026021508) not in got  # its only leg moved away
    assert got["6602.05", 2026021514][5] == "Fog"
    assert {r["status"] for r in report.collect()} == {"OK"}
    stamps = {r["ride_id"]: (r["loaded_at"], r["updated_at"]) for r in two.now("trip").collect()}
    assert stamps["NYC_RIDE_001"] == (datetime(2026, 2, 16), datetime(2026, 2, 17))
    assert stamps["NYC_RIDE_004"] == (datetime(2026, 2, 16), datetime(2026, 2, 16))


MOVED = ("NYC_RIDE_001", "electric_bike", "10:15", "10:30", "5514.01", "5514.01", "member", "NYC")


@pytest.mark.parametrize("stop", ["normalise", "publish", "reconcile_window"])
def test_a_run_that_stopped_can_be_repeated(spark, first, monkeypatch, stop):
    """The run fails as it comes to one of its steps; run again, it equals a full build."""
    two = warehouse.Warehouse(spark, first[0].root, f"r2-{stop}", previous="r1")
    trips = [t for t in TRIPS if t[0] != MOVED[0]] + [MOVED]

    def fail(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, stop, fail)
        with pytest.raises(RuntimeError, match="stopped"):
            warehouse.daily_run(two, raw(spark, trips), ctx(2))
    report = warehouse.daily_run(two, raw(spark, trips), ctx(2))
    assert {k: v[:3] for k, v in fact_rows(two).items()} == rebuilt(two)
    assert ("6602.05", 2026021508) not in fact_rows(two)
    assert {r["status"] for r in report.collect()} == {"OK"} and two.now("missing_hours").count() == 0
    # The run before still reads as it was.
    assert ("6602.05", 2026021508) in fact_rows(first[0])


def test_a_pushed_delete_closes_the_station(spark, first):
    root = first[0].root
    two = warehouse.Warehouse(spark, root, "r2-push", previous="r1")
    push = [("CHI", "CHI10001", "g1", "Stop CHI10001", 41.5, -87.5, 15, None, None, "open", "DELETE", datetime(2026, 2, 16, 12))]
    kind = (
        "source_city_code string, short_name string, gbfs_station_id string, station_name string, latitude double,"
        " longitude double, capacity int, station_type string, region_id string, station_status string, operation string,"
        " sent_at timestamp_ntz"
    )
    warehouse.daily_run(two, raw(spark, trips=[]), ctx(2), spark.createDataFrame(push, kind))
    state = {r["source_station_id"]: r["is_current"] for r in two.now("dim_station").collect()}
    assert state == {"CHI10001": False, "CHI10002": True, "6602.05": True, "5514.01": True}
    closed = two.now("dim_station").filter("source_station_id = 'CHI10001'").first()
    assert closed["effective_to"] == datetime(2026, 2, 17)
    logged = spark.read.parquet(f"{root}/job_log/normalise")
    assert {r["load_run_id"] for r in logged.collect()} == {"r1", "r2"}
    assert {r["match_method"] for r in first[0].now("entity_matches").collect()} == {"EXACT_ID"}
    assert {r["status"] for r in two.now("leakage").collect()} == {"PASS"}
    assert {r["difference"] for r in two.now("stage_balance").collect()} == {0}


def test_only_months_in_reach_are_read(spark, first):
    wh, _ = first
    hours = spark.createDataFrame([(datetime(2026, 2, 15, 8),)], "date_hour timestamp_ntz")
    assert wh.now("trip", hours).count() == 8
    other = spark.createDataFrame([(datetime(2026, 3, 1),)], "date_hour timestamp_ntz")
    assert wh.now("trip", other).rdd.getNumPartitions() == 0 or wh.now("trip", other).isEmpty()
    assert "trip_month=202602" in wh.now("trip").inputFiles()[0]


def test_weather_alone_refreshes_the_fact(spark, first):
    two = warehouse.Warehouse(spark, first[0].root, "r2-weather", previous="r1")
    warehouse.daily_run(two, raw(spark, trips=[], weather=[("CHI", "08", "SN", "0"), ("NYC", "09", "FG", "0")]), ctx(2))
    got = fact_rows(two)
    assert len(got) == 9
    assert got["CHI10001", 2026021508] == (1, 1, 0, 1, 0, "Snow")
    assert got["6602.05", 2026021509] == (0, 1, 1, 0, 0, "Fog")
    assert got["6602.05", 2026021508][5] == "Snow" and got["CHI10001", 2026021514][5] == "Rain"


def test_a_late_master_resolves_stored_trips(spark):
    trips = spark.createDataFrame(
        [(1, "t1", "a", "b", 5, None), (1, "t2", "a", None, 5, None)],
        "city_sk bigint, ride_id string, start_station_id string, end_station_id string, start_station_sk bigint,"
        " end_station_sk bigint",
    )
    at = datetime(2026, 1, 1, 8, 30)
    trips = trips.withColumns(
        {c: F.lit(str(at)).cast("timestamp_ntz") for c in ("started_at", "ended_at", "updated_at")}
    ).withColumns({c: F.lit("x") for c in ("member_casual", "rideable_type")}).withColumn("duration_minutes", F.lit(1.0))
    station = spark.createDataFrame(
        [(9, 1, "b", True, at)],
        "station_sk bigint, city_sk bigint, source_station_id string, is_current boolean, effective_from timestamp_ntz",
    )
    updates, grains = loads.reresolve(trips, station, ctx(3))
    assert [(r["ride_id"], r["end_station_sk"]) for r in updates.collect()] == [("t1", 9)]
    assert {r["source_station_id"] for r in grains.collect()} == {"a", "b"}


def test_a_run_reads_the_months_that_its_keys_name(spark, monkeypatch):
    """A ride that moves from January to March is found; February is not read for it."""
    root, read = scratch_path(spark, "wh"), []
    plain = warehouse.Warehouse._monthly

    def noted(self, name, index, side="", schema=None):
        out = plain(self, name, index, side, schema)
        if name == "trip" and not side:
            read.append({f.partition("trip_month=")[2].partition("/")[0] for f in out.inputFiles()})
        return out

    def months(*rides):
        return [(r, "classic_bike", "08:05", "08:20", "6602.05", "5514.01", "member", "NYC") for r in rides]

    def landed(parts, stations=STATIONS):
        out = None
        for (month, last), trips in parts.items():
            one = raw(spark, trips, stations, day=f"2026-{month}-{last}")
            one["trips:citibike_trips:CITI"] = one["trips:citibike_trips:CITI"].withColumn("trip_month", F.lit(f"2026{month}"))
            out = one if out is None else {k: out[k].unionByName(one[k]) if k.startswith("trips") else out[k] for k in out}
        return out

    parts = {("01", "10"): months("a", "b"), ("02", "10"): months("c", "d"), ("03", "10"): months("e")}
    one = warehouse.Warehouse(spark, root, "r1")
    at = datetime(2026, 3, 20)
    warehouse.daily_run(one, landed(parts), RunContext("r1", at, cet=at, lset=datetime(2026, 1, 1)))
    assert one.now("trip").count() == 5
    index = spark.read.parquet(f"{root}/trip_keys/run=r1")
    assert index.filter("kind = 'ride'").selectExpr("sum(size(prints))").first()[0] == 5
    assert {str(r[0]) for r in index.select("trip_month").distinct().collect()} == {"202601", "202602", "202603"}

    two = warehouse.Warehouse(spark, root, "r2", previous="r1")
    later = datetime(2026, 3, 21)
    monkeypatch.setattr(warehouse.Warehouse, "_monthly", noted)
    ctx2 = RunContext("r2", later, cet=later, lset=datetime(2026, 3, 1))
    warehouse.stage(two, landed({("03", "19"): months("a", "f")}), ctx2)
    read.clear()
    warehouse.normalise(two, ctx2)
    assert {"202601"} in read and not any("202602" in names for names in read)
    monkeypatch.setattr(warehouse.Warehouse, "_monthly", plain)
    report = warehouse.publish(two, ctx2)
    got = {r["ride_id"]: r["trip_month"] for r in two.now("trip").collect()}
    assert got == {"b": "202601", "a": "202603", "c": "202602", "d": "202602", "e": "202603", "f": "202603"}
    assert {k: v[:3] for k, v in fact_rows(two).items()} == rebuilt(two)
    assert {r["status"] for r in report.collect()} == {"OK"}


def test_open_station_keys_are_indexed(spark):
    """Stored trips without a known station are found through the months that the index names."""
    root = scratch_path(spark, "wh")
    wh = warehouse.Warehouse(spark, root, "r1")
    full = spark.createDataFrame([], warehouse.SCHEMAS["trip"])
    at = datetime(2026, 1, 5, 8)
    rows = [
        {"city_sk": 1, "ride_id": "t1", "start_station_id": "a", "end_station_id": "b", "start_station_sk": 5, "trip_month": "202601"},
        {"city_sk": 1, "ride_id": "t2", "start_station_id": "c", "end_station_id": None, "start_station_sk": None, "trip_month": "202602"},
        {"city_sk": 1, "ride_id": "t3", "start_station_id": "a", "end_station_id": None, "start_station_sk": 5, "trip_month": "202603"},
    ]
    filled = [tuple(r.get(f.name, at if f.name in ("started_at", "ended_at") else None) for f in full.schema) for r in rows]
    trips = spark.createDataFrame(filled, full.schema)
    wh.replace_months("trip", trips, trips.select("trip_month").distinct())
    two = warehouse.Warehouse(spark, root, "r2", previous="r1")

    def named(kind, *keys):
        cols = ["city_sk", "ride_id"] if kind == "ride" else ["city_sk", "source_station_id"]
        wanted = spark.createDataFrame([(1, k) for k in keys], f"city_sk bigint, {cols[1]} string")
        return {r["month"] for r in two.months_holding("trip", kind, wanted).collect()}

    assert named("open", "b") == {"202601"} and named("open", "c", "a") == {"202602"} and named("open", "a") == set()
    assert named("ride", "t3", "t1", "x") == {"202601", "202603"}
    assert warehouse.Warehouse(spark, root, "r0").months_holding("trip", "ride", trips).count() == 0


def test_an_older_change_of_a_station_moves_its_stored_hours(spark):
    """Version C enters between A and B: the hours of its time are refreshed and the others are not."""
    root = scratch_path(spark, "wh")
    wh = warehouse.Warehouse(spark, root, "r1")
    at = lambda m, d, h=0: datetime(2026, m, d, h)
    cols = {f.name: f.dataType for f in spark.createDataFrame([], warehouse.SCHEMAS["dim_station"]).schema}

    def dim(*versions):
        rows = [
            {"station_sk": sk, "city_sk": 1, "source_station_id": "s", "station_name": name, "station_status": "open",
             "effective_from": a, "effective_to": b, "is_current": b is None, "version": i + 1}
            for i, (sk, name, a, b) in enumerate(versions)
        ]
        return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], warehouse.SCHEMAS["dim_station"])

    stored = dim((10, "A", at(1, 1), at(2, 10)), (11, "B", at(2, 10), None))
    wh.write("dim_station", stored)
    hours = [(10, at(1, 20, 8)), (10, at(2, 4, 9)), (10, at(2, 6, 9)), (10, at(2, 9, 23)), (11, at(2, 10)), (11, at(3, 1, 5))]
    empty = spark.createDataFrame([], warehouse.SCHEMAS["fact"])
    facts = spark.createDataFrame([(sk, int(t.strftime("%Y%m%d%H")), t.strftime("%Y%m")) for sk, t in hours], "station_sk bigint, datetime_sk int, month string")
    facts = empty.unionByName(facts, allowMissingColumns=True)
    wh.replace_months("fact", facts, facts.select("month").distinct())

    two = warehouse.Warehouse(spark, root, "r2", previous="r1")
    station = spark.createDataFrame(
        [(5, 1, "s", "C", "open", "active", True, at(2, 5), None, at(2, 5))],
        "station_sk bigint, city_sk bigint, source_station_id string, station_name string, station_status string, row_status string,"
        " is_current boolean, effective_from timestamp_ntz, effective_to timestamp_ntz, loaded_at timestamp_ntz",
    ).selectExpr("*", "cast(null as decimal(12,8)) as latitude", "cast(null as decimal(12,8)) as longitude", "cast(null as int) as capacity")
    now = loads.load_dim_station(two.before("dim_station"), station, at(1, 1), at(2, 6))
    got = {r["station_name"]: (r["station_sk"], r["effective_from"], r["effective_to"]) for r in now.collect()}
    assert got == {"A": (10, at(1, 1), at(2, 5)), "C": (12, at(2, 5), at(2, 10)), "B": (11, at(2, 10), None)}
    moved = warehouse.moved_grains(two, now).collect()
    assert sorted(r["date_hour"] for r in moved) == [at(2, 6, 9), at(2, 9, 23)]
    spans = spark.createDataFrame([(at(2, 5), at(2, 10))], "low timestamp_ntz, high timestamp_ntz")
    assert [r["month"] for r in two.spanning("fact", spans).collect()] == ["202602"]


def test_staging_reads_a_source_three_times(spark, tmp_path):
    """A counting filter in front of each landed source tells how often its rows are read."""
    counted = {}

    def watched(name, df):
        path = str(tmp_path / name.replace(":", "-"))
        df.write.parquet(path)
        seen = spark.sparkContext.accumulator(0)

        @F.udf("boolean")
        def look(_):
            seen.add(1)
            return True

        counted[name] = (seen, df.count())
        return spark.read.parquet(path).filter(look.asNondeterministic()("source_file"))

    landed = {k: watched(k, v) for k, v in raw(spark, TRIPS + TRIPS[:2]).items()}
    wh = warehouse.Warehouse(spark, scratch_path(spark, "wh"), "r1")
    warehouse.stage(wh, landed, ctx(1))
    assert {name: seen.value / n for name, (seen, n) in counted.items()} == {name: 3.0 for name in counted}
    found = spark.read.parquet(f"{wh.root}/dq_details/citibike_trips")
    assert found.filter("rule_code = 'CITI_DUPLICATE_RIDE'").count() == 4
    balance = {r["source_name"]: r for r in wh.now("stage_balance").collect()}
    assert balance["citibike_trips"]["duplicate_rows"] == 2 and {r["difference"] for r in balance.values()} == {0}


def test_an_empty_source_is_staged(spark):
    wh = warehouse.Warehouse(spark, scratch_path(spark, "wh"), "r1")
    empty = {k: v.limit(0) for k, v in raw(spark).items()}
    warehouse.stage(wh, empty, ctx(1))
    assert {r["raw_rows"] for r in wh.now("stage_balance").collect()} == {0}
    assert wh.now("stg_trips").count() == 0 and wh.now("changes").count() == 0
