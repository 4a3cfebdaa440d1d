"""Streams on keyed state: history may go, batches may repeat, tables may be folded."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.operators import flow
from tidemark.operators.dedup import dedup_first
from tidemark.session import delete, list_names, scratch_path
from tidemark.streaming import changelog, changes, rides, state, trips

SCHEMA = (
    "city_sk int, ride_id string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string,"
    " end_station_id string, start_station_sk bigint, end_station_sk bigint, member_casual string, duration_minutes decimal(10,2),"
    " loaded_at timestamp_ntz"
)
DAY = datetime(2026, 2, 15)


def waves(n, size, seed=1):
    """Batches of ride versions: new rides, changed ones, older versions and NULLs."""
    rng = random.Random(seed)
    out = []
    for w in range(n):
        rows = []
        for _ in range(size):
            ride = rng.randrange(size * (w + 1) // 2 + 1)
            start = DAY + timedelta(minutes=rng.randrange(600))
            end = None if rng.random() < 0.1 else start + timedelta(minutes=rng.randrange(90))
            s, e = rng.choice(["A", "B", "C", None]), rng.choice(["A", "B", None])
            minutes = None if end is None else Decimal((end - start).seconds // 60)
            version = None if rng.random() < 0.05 else DAY + timedelta(days=rng.randrange(w + 1))
            rows.append((1, f"r{ride}", rng.choice(["electric_bike", "classic_bike", "scooter"]), start, end, s, e,
                         None if s is None else 1, None if e is None else 2, rng.choice(["member", "casual", None]), minutes, version))
        out.append(rows)
    return out


def expected(spark, batches):
    """Full build from the last version of each ride."""
    every = None
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, SCHEMA)
        df = df.withColumns({"batch": F.lit(i), "tie": F.xxhash64(*df.columns)})
        every = df if every is None else every.unionByName(df)
    last = dedup_first(every, rides.RIDE, [F.desc("loaded_at"), F.desc("batch"), "tie"])
    return sorted(map(tuple, flow.station_hour_balance(last).collect()))


def fact_rows(spark, root):
    return sorted(map(tuple, rides.fact(spark, root, spark.createDataFrame([], SCHEMA)).collect()))


def offer(spark, rows, inbox):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(inbox)


def clear(spark, folder):
    """Data files of a folder go; the log of the sink stays."""
    for name in list_names(spark, folder):
        if name.startswith("part-"):
            delete(spark, f"{folder}/{name}")


@pytest.fixture
def one_partition(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_batches_need_no_history(spark, one_partition):
    """Consumed rides, consumed legs and all earlier fact changes are deleted between the waves."""
    root, inbox = scratch_path(spark, "rides"), scratch_path(spark, "inbox")
    batches, seen, state_of_fact = waves(4, 40), [], {}
    for rows in batches:
        rides.refresh(offer(spark, rows, inbox), root)
        schema = rides._fact_schema(spark, rides._legs_schema(spark.createDataFrame([], SCHEMA)))
        for r in changelog.changes(spark, f"{root}/fact", schema).drop("batch_id").collect():
            state_of_fact[tuple(r[:3])] = tuple(r)  # the changes of this wave only
        for folder in (inbox, f"{root}/legs"):
            clear(spark, folder)
        delete(spark, f"{root}/fact/changes")
        seen.append(rows)
        got = sorted(r for r in state_of_fact.values() if r[3] or r[4])
        assert got == expected(spark, seen)


def test_many_batches_read_their_rows_only(spark, one_partition):
    """Fifty batches: each reads its rows alone, and folding between them changes nothing."""
    root, inbox = scratch_path(spark, "rides"), scratch_path(spark, "inbox")
    batches = waves(50, 12, seed=5)
    for rows in batches[:49]:
        stream = offer(spark, rows, inbox)
    query = rides.ride_changes(stream, root)
    query.awaitTermination()
    read = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert read == [12] * 49
    legs = rides._legs_schema(spark.createDataFrame([], SCHEMA))
    rides.fact_changes(spark, root, legs).awaitTermination()
    empty = spark.createDataFrame([], SCHEMA)
    before = fact_rows(spark, root)
    assert rides.compact_fact(spark, root, empty) is not None
    assert rides.compact_fact(spark, root, empty) is None
    assert list_names(spark, f"{root}/fact/changes") in ([], ["_SUCCESS"]) and fact_rows(spark, root) == before
    rides.refresh(offer(spark, batches[49], inbox), root)
    assert fact_rows(spark, root) == expected(spark, batches)
    assert rides.compact_fact(spark, root, empty) is not None
    assert len([n for n in list_names(spark, f"{root}/fact") if n.startswith("base-")]) == 1
    assert fact_rows(spark, root) == expected(spark, batches)


def test_a_ride_costs_few_state_calls():
    """A new bucket is written without reads, a known ride is read once and written only if it moved."""
    calls, stored = [], {}

    class Entries:
        def exists(self):
            return bool(stored)

        def getValue(self, key):
            calls.append("get")
            return stored.get(key)

        def updateValue(self, key, value):
            calls.append("update")
            stored[key] = value

    class Handle:
        def getMapState(self, name, key, value):
            return Entries()

    names = ["city_sk", "ride_id", "version", "tie", "start_station", "start_hour", "end_station", "end_hour", "member_casual", "rideable_type", "minutes"]
    ride = lambda i, version, tie, station: Row(*names)(1, f"r{i}", version, tie, station, 5, "E", 6, "member", "electric_bike", 100)
    processor = rides.RideVersions("city_sk int, ride_id string")
    processor.init(Handle())
    run = lambda rows: [(r.source_station_id, r.hour, r.trips_started, r.trips_ended) for r in processor.handleInputRows((0,), iter(rows), None)]
    first = [ride(i, version, tie, station) for i in range(20) for version, tie, station in ((1, 0, "old"), (2, 9, "tie"), (2, 3, "A"), (None, 0, "null"))]
    assert sorted(run(first)) == [("A", 5, 20, 0), ("E", 6, 0, 20)] and calls == ["update"] * 20
    calls.clear()
    assert run([ride(i, 2, 3, "A") for i in range(20)]) == [] and calls == ["get"] * 20
    calls.clear()
    assert sorted(run([ride(0, 3, 0, "B"), ride(1, 1, 0, "B"), ride(2, None, 0, "B")])) == [("A", 5, -1, 0), ("B", 5, 1, 0)]
    assert calls.count("update") == 1


def test_a_failed_batch_is_repeated(spark, one_partition, monkeypatch):
    """The fact query dies after it wrote its rows and before the batch is recorded; it goes on from its checkpoint."""
    root, inbox = scratch_path(spark, "rides"), scratch_path(spark, "inbox")
    batches = waves(3, 30, seed=9)
    rides.refresh(offer(spark, batches[0], inbox), root)
    store = changelog.store_changes

    def failing(path):
        def write(batch, batch_id):
            store(path)(batch, batch_id)
            raise RuntimeError("lost")

        return write

    monkeypatch.setattr(changelog, "store_changes", failing)
    with pytest.raises(Exception, match="lost"):
        rides.refresh(offer(spark, batches[1], inbox), root)
    monkeypatch.setattr(changelog, "store_changes", store)
    rides.refresh(offer(spark, batches[2], inbox), root)
    assert fact_rows(spark, root) == expected(spark, batches)


def test_a_fold_that_failed_is_passed_over(spark):
    path = scratch_path(spark, "table")
    store = changelog.store_changes(path)
    for i, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 3)]]):
        store(spark.createDataFrame(rows, "k string, v int"), i)
    schema = spark.createDataFrame([], "k string, v int").schema
    spark.range(3).selectExpr("'x' as k", "9 as v", "2L as batch_id").write.parquet(f"{path}/base-2")
    delete(spark, f"{path}/base-2/_SUCCESS")
    read = lambda: sorted(map(tuple, changelog.latest(spark, path, ["k"], schema).collect()))
    want = [("a", 2), ("b", 1), ("c", 3)]
    assert read() == want
    assert changelog.compact(spark, path, ["k"], schema) == 2 and read() == want
    store(spark.createDataFrame([("b", 4)], "k string, v int"), 3)
    assert read() == [("a", 2), ("b", 4), ("c", 3)]
    assert changelog.latest(spark, scratch_path(spark, "none"), ["k"], schema).count() == 0


def event(operation, sent_at, name, station="S1", city="NYC"):
    data = (city, f"g{name}", station, name, 40.5, -73.5, 10, "classic", "1", "open")
    return (operation, sent_at, data)


def test_station_events_keep_the_latest(spark, one_partition):
    """An event that arrives late does not replace a later one; consumed files may go."""
    inbox, out, checkpoint = (scratch_path(spark, x) for x in ("inbox", "out", "checkpoint"))
    stations = spark.createDataFrame([], "station_sk bigint, city_sk int, source_station_id string, is_current boolean, effective_from timestamp_ntz")
    city = spark.createDataFrame([(1, "NYC")], "city_sk int, city_code string")
    steps = [
        [event("insert", "2026-02-02", "one"), event("insert", "2026-02-03", "two"), event("move", "2026-02-09", "bad")],
        [event("update", "2026-02-01", "old"), event("insert", "2026-02-01", "other", "S2")],
        [event("update", "2026-02-05", "three"), event("update", "2026-02-04", "late", "S2")],
    ]
    want = [{"S1": "two"}, {"S1": "two", "S2": "other"}, {"S1": "three", "S2": "late"}]
    for n, (rows, names) in enumerate(zip(steps, want)):
        spark.createDataFrame(rows, changes.EVENT_SCHEMA).coalesce(1).write.mode("append").json(inbox)
        for query in changes.change_stream(spark, inbox, out, checkpoint, stations, city):
            query.awaitTermination()
        clear(spark, inbox)
        got = {r["short_name"]: r["station_name"] for r in changes.latest_staging(spark, out).collect()}
        assert got == names
        if n == 1:
            assert changes.compact_staging(spark, out) is not None
    answers = spark.read.parquet(f"{out}/responses")
    assert answers.count() == 7 and answers.filter("http_status = 400").count() == 1


def test_a_repeat_after_thirty_days_is_dropped(spark, one_partition):
    inbox, out, checkpoint = (scratch_path(spark, x) for x in ("inbox", "out", "checkpoint"))
    days = [[("a", 0), ("b", 0)], [("c", 15)], [("a", 30), ("d", 31), ("c", 32)], [("b", 90), ("a", 91)]]
    for rows in days:
        typed = [(k, DAY + timedelta(days=d)) for k, d in rows]
        spark.createDataFrame(typed, "ride_id string, started_at timestamp_ntz").coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("ride_id string, started_at timestamp_ntz").parquet(inbox)
        kept = trips.dedup_stream(stream, ["ride_id"], "started_at", None)
        writer = kept.writeStream.foreachBatch(trips.store_by_batch(out)).option("checkpointLocation", checkpoint)
        state.on_rocksdb(writer).awaitTermination()
        clear(spark, inbox)
    got = {r["ride_id"]: r["started_at"] for r in spark.read.parquet(out).collect()}
    assert got == {"a": DAY, "b": DAY, "c": DAY + timedelta(days=15), "d": DAY + timedelta(days=31)}


def test_settings_of_other_streams_stay(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    df = spark.readStream.format("rate").load()
    writer = df.writeStream.foreachBatch(lambda b, i: None).option("checkpointLocation", scratch_path(spark, "c"))
    query = state.on_rocksdb(writer)
    query.awaitTermination()
    assert spark.conf.get(key, None) == before
