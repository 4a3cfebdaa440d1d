"""Operators against brute force on small, skewed inputs."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.checks.views import Tables
from tidemark.operators import cdc, incremental, keys, lookup, match, ordered, profile, ranged, rules, scd, skew, snapshots, upsert
from tidemark.operators.dedup import dedup_best, dedup_first
from tidemark.plans import bike
from tidemark.session import materialize, scratch_path


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def skewed(spark, n=600, seed=3):
    """A third of the rows has one key, a sixth a NULL key."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else (None if i % 6 == 1 else f"k{rnd.randrange(40)}")
        data.append((i, k, datetime(2024, 1, 1) + timedelta(hours=rnd.randrange(3000)), rnd.randrange(5)))
    return spark.createDataFrame(data, "id bigint, k string, ts timestamp_ntz, v int"), data


def test_count_over_counts_null_and_hot_groups(spark):
    df, data = skewed(spark)
    size = {}
    for _, k, _, _ in data:
        size[k] = size.get(k, 0) + 1
    got = dict(rows(ordered.count_over(df, ["k"]), "id", "key_count"))
    assert got == {i: size[k] for i, k, _, _ in data}


def test_sliced_ranks_equal_plain_ranks(spark):
    df, _ = skewed(spark)
    order = [F.col("ts"), F.col("id")]
    plain = ordered.rank_rows(df, ["k"], order)
    sliced = ordered.rank_rows(df, ["k"], order, slice_by=F.date_trunc("month", "ts"))
    assert rows(plain, "id", "row_num") == rows(sliced, "id", "row_num")


def test_sliced_history_equals_plain_history_and_brute_force(spark):
    df, data = skewed(spark)
    log = {}
    for _, k, ts, v in data:
        if k is not None:
            log[k, ts] = max(v, log.get((k, ts), -1))
    changes = spark.createDataFrame([(k, t, v) for (k, t), v in log.items()], "k string, ts timestamp_ntz, v int")
    plain = scd.scd2_from_changes(changes, ["k"], ["v"], "ts")
    sliced = scd.scd2_from_changes(changes, ["k"], ["v"], "ts", long_keys=True, partitions=7)
    shown = ("k", "v", "effective_from", "effective_to", "is_current", "version")
    want = []
    for key in {k for k, _ in log}:
        steps = []
        for t, v in sorted((t, v) for (k, t), v in log.items() if k == key):
            if not steps or steps[-1][1] != v:
                steps.append((t, v))
        for i, (t, v) in enumerate(steps):
            end = steps[i + 1][0] if i + 1 < len(steps) else None
            want.append((key, v, t, end, end is None, i + 1))
    assert rows(plain, *shown) == rows(sliced, *shown) == sorted(want, key=repr)


def test_duplicate_rows(spark):
    df, data = skewed(spark)
    found = rules.duplicate_rows(df, [F.col("k"), F.col("v")])
    size = {}
    for _, k, _, v in data:
        size[k, v] = size.get((k, v), 0) + 1
    want = [(i,) for i, k, _, v in data if k is not None and size[k, v] > 1]
    assert rows(found, "id") == sorted(want, key=repr)


def shuffled_bytes(df):
    """Bytes that the run of a frame wrote to shuffles, by the metrics of its final plan."""
    df.collect()
    qe = df._jdf.queryExecution()
    total, todo, seen = 0, [qe.executedPlan()], set()
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        metrics = node.metrics()
        if node.nodeName() == "Exchange" and node.id() not in seen and metrics.contains("shuffleBytesWritten"):
            seen.add(node.id())
            total += metrics.apply("shuffleBytesWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_details_shuffle_keys_and_findings_only(spark):
    """Wide rows stay where they are: what is shuffled grows with the repeated rows."""
    path = scratch_path(spark, "raw")
    wide = [f"concat('{c}', repeat(md5(cast(id as string)), 30)) as {c}" for c in ("start_station_name", "end_station_name")]
    n = 20_000
    spark.range(n).selectExpr(
        "concat('r', if(id % 1000 = 0, 0, id)) as ride_id", "'2024-01-05 10:00:00' as started_at", "'2024-01-05 10:05:00' as ended_at",
        "'a' as start_station_id", "'b' as end_station_id", "'member' as member_casual", "'classic_bike' as rideable_type", *wide,
        "'1' as start_lat", "'1' as start_lng", "'1' as end_lat", "'1' as end_lng", "'202401' as trip_month", "'NYC' as source_city_code",
        "'r' as load_run_id", "'f' as source_file", "id as source_row_number",
    ).repartition(4).write.parquet(path)
    raw = spark.read.parquet(path)
    rule_set = bike.trip_rules("CITI", "c")
    found = rules.dq_details(raw, rule_set)
    moved = shuffled_bytes(found)
    assert found.count() == n // 1000
    assert 0 < moved < 60 * n  # a row is two thousand bytes wide
    rows_ = rules.duplicate_rows(raw, list(rule_set.duplicate.keys))
    assert 0 < shuffled_bytes(rows_) < 60 * n and rows_.count() == n // 1000


def test_a_full_filter_changes_nothing(spark):
    """With a handful of bits nearly every row is a candidate; the join still decides."""
    df, data = skewed(spark)
    known = profile.repeated_keys(df, [F.col("k"), F.col("v")])
    marked = profile.mark_repeated(df.withColumn("key", skew.struct_key([F.col("k"), F.col("v")])), "key", known, "maybe", bits=64)
    size = {}
    for _, k, _, v in data:
        size[k, v] = size.get((k, v), 0) + 1
    sure = {i for i, k, _, v in data if size[k, v] > 1}
    assert sure <= {r["id"] for r in marked.filter("maybe").collect()} and marked.count() == len(data)


def test_measured_values_and_repeated_keys(spark):
    df, data = skewed(spark)
    df = df.withColumn("source_file", F.concat(F.lit("f"), F.col("v")))
    metrics = {"n": F.count(F.lit(1)), "hot": F.count_if(F.col("k") == "hot")}
    out, values = profile.measured(df, metrics, lambda d: materialize(d.filter("v = 1"), "x"))
    assert values == {"n": len(data), "hot": sum(d[1] == "hot" for d in data)} and out.count() == sum(d[3] == 1 for d in data)
    out, values = profile.measured(df.limit(0), metrics, lambda d: materialize(d, "x"))
    assert values == {"n": 0, "hot": 0} and out.count() == 0
    seen = profile.profile(df, {"copies": skew.struct_key(["k", "v"]), "odd": F.when(F.col("v") % 2 == 1, F.struct("k"))}, ["ts"])
    assert rows(profile.fingerprints(seen), "source_file", "row_count", "fingerprint") == rows(
        cdc.fingerprint(df, ["source_file"], ["ts"]), "source_file", "row_count", "fingerprint"
    )
    counts = {}
    for _, k, _, v in data:
        if v % 2:
            counts[k] = counts.get(k, 0) + 1
    got = {r["__key"]["k"]: r["n_rows"] for r in profile.repeated(seen, "odd").collect()}
    assert got == {k: n for k, n in counts.items() if n > 1}


def test_a_hot_key_is_dealt_over_many_tasks(spark):
    df, _ = skewed(spark)
    df = df.repartition(6)
    salt = df.select(F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.lit(skew.SALTS)).alias("s"), "k")
    assert salt.filter("k = 'hot'").select("s").distinct().count() > skew.SALTS // 2


def executed(df):
    """The final plan, after running."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_details_of_chosen_rules_read_no_more_than_needed(spark):
    raw = Tables(spark, "/root/testdata/sf0.001").raw_trips
    every = rules.dq_details(raw, bike.trip_rules("CITI", "c"))
    # Raw trips are two reads of one file: one pass over the keys, one over the rows.
    assert executed(every).count("FileScan") <= 4
    null = rules.dq_details(raw, bike.trip_rules("CITI", "c"), codes=["CITI_NULL_REQUIRED"])
    assert "Exchange" not in executed(null)
    assert null.count() == every.filter("rule_code = 'CITI_NULL_REQUIRED'").count()
    with pytest.raises(ValueError):
        rules.dq_details(raw, bike.trip_rules("CITI", "c"), codes=["NONE"])


def test_first_row_per_key_is_pruned_before_the_shuffle(spark):
    df, data = skewed(spark)
    first = dedup_first(df, ["k"], ["ts", "id"])
    want = {}
    for i, k, ts, _ in data:
        want[k] = min(want.get(k, (ts, i)), (ts, i))
    assert rows(first, "k", "ts", "id") == sorted(((k, t, i) for k, (t, i) in want.items()), key=repr)
    plan = first._jdf.queryExecution().toString()
    assert plan.index("Partial") > plan.index("hashpartitioning(k")


def test_best_row_prefers_the_rank(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, "c", 5)], "k int, kind string, t int")
    rank = F.when(F.col("kind") == "a", 1).otherwise(2)
    assert rows(dedup_best(df, ["k"], rank, ["t"]), "k", "kind") == [(1, "a"), (2, "c")]


# ---- lookups ----


def versions(spark):
    at = [datetime(2024, 1, 1), datetime(2024, 2, 10), datetime(2024, 2, 20)]
    data = [("a", at[0], at[1], 1), ("a", at[1], at[2], 2), ("a", at[2], None, 3), ("b", at[1], at[2], 4)]
    return spark.createDataFrame(data, "k string, effective_from timestamp_ntz, effective_to timestamp_ntz, sk int")


@pytest.mark.parametrize("way", ["join", "months", "merge"])
def test_as_of_bounds(spark, way):
    asked = [
        ("a", datetime(2023, 12, 31, 23), None),
        ("a", datetime(2024, 1, 1), 1),
        ("a", datetime(2024, 2, 9, 23, 59, 59), 1),
        ("a", datetime(2024, 2, 10), 2),
        ("a", datetime(2024, 2, 20), 3),
        ("a", datetime(2030, 1, 1), 3),
        ("b", datetime(2024, 2, 20), None),
        ("c", datetime(2024, 2, 20), None),
        (None, datetime(2024, 2, 20), None),
        ("a", None, None),
    ]
    facts = spark.createDataFrame([(i, k, t) for i, (k, t, _) in enumerate(asked)], "i int, k string, t timestamp_ntz")
    if way == "merge":
        found = lookup.merge_asof(facts, versions(spark), ["k"], "t", ["sk"], partitions=5)
    else:
        found = lookup.scd2_lookup(facts, versions(spark), ["k"], "t", ["sk"], slice_months=way == "months")
    assert rows(found, "i", "sk") == sorted([(i, sk) for i, (_, _, sk) in enumerate(asked)], key=repr)


def test_merged_as_of_equals_the_join_on_hot_keys(spark):
    """Half the facts share one key, many share one time; versions leave gaps; names clash with helpers."""
    rng = random.Random(7)
    day = lambda d: datetime(2024, 1, 1) + timedelta(hours=d)
    dim = []
    for key in ["hot", *[f"k{i}" for i in range(30)]]:
        at = rng.randrange(50)
        for i in range(200 if key == "hot" else rng.randrange(4)):
            end = at + rng.randrange(1, 6)
            dim.append((key, day(at), None if i == 199 else day(end), i))
            at = end + rng.choice([0, 0, 2])
    dim = spark.createDataFrame(dim + [(None, day(0), None, 9)], "k string, effective_from timestamp_ntz, effective_to timestamp_ntz, sk int")
    facts = [
        (i, rng.choice(["hot", None, f"k{rng.randrange(40)}", "hot"]), None if i % 97 == 0 else day(rng.choice([100, rng.randrange(1200)])))
        for i in range(4000)
    ]
    facts = spark.createDataFrame(facts, "__at int, k string, t timestamp_ntz").repartition(5)
    want = rows(lookup.scd2_lookup(facts, dim, ["k"], "t", {"sk": "sk2", "effective_from": "since"}), "__at", "sk2", "since")
    got = lookup.merge_asof(facts, dim, ["k"], "t", {"sk": "sk2", "effective_from": "since"}, partitions=9)
    assert got.columns == ["__at", "k", "t", "sk2", "since"] and rows(got, "__at", "sk2", "since") == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange rangepartitioning") == 0
    assert lookup.merge_asof(facts.limit(0), dim, ["k"], "t", ["sk"]).count() == 0
    none = lookup.merge_asof(facts, dim.limit(0), ["k"], "t", ["sk"])
    assert none.count() == 4000 and none.filter("sk is not null").count() == 0


def test_a_hot_key_is_laid_over_many_partitions(spark):
    data = [(1 if i % 3 else i, i % 500, i) for i in range(9000)]
    laid = ranged.lay(spark.createDataFrame(data, "k int, t int, v int").repartition(4), ["k"], ["t"], partitions=12)
    sizes = [r["count"] for r in laid.table.groupBy(ranged.PART).count().collect()]
    assert max(sizes) < 3 * 9000 / 12
    assert laid.table.filter("k = 1").select(ranged.PART).distinct().count() >= 6


def test_carried_totals_and_ends(spark):
    """Sums, last and first values over partitions, against plain lists; one key lies in all of them."""
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", "b", "b", "c"]), i, rng.randrange(9)) for i in range(300)]
    laid = ranged.lay(spark.createDataFrame(data, "k string, t int, v int"), ["k"], ["t"], partitions=11)
    n = F.row_number().over(laid.inside()).cast("bigint")
    scanned = laid.table.withColumn("n", n)
    odd = scanned.filter("v % 2 = 1")
    full = laid.carry(scanned, scanned, total={"n": "sofar"})
    full = laid.carry(full, odd, last={"v": "last_odd"}, first={"v": "next_odd"})
    for r in full.collect():
        mine = sorted((t, v) for k, t, v in data if k == r["k"])
        place = [t for t, _ in mine].index(r["t"])
        assert r["n"] + (r["sofar"] or 0) == place + 1
    part = {(r["k"], r["t"]): r[ranged.PART] for r in full.collect()}
    for r in full.collect():
        before = [v for k, t, v in sorted(data, key=lambda x: x[1]) if k == r["k"] and part[k, t] < r[ranged.PART] and v % 2]
        later = [v for k, t, v in sorted(data, key=lambda x: x[1]) if k == r["k"] and part[k, t] > r[ranged.PART] and v % 2]
        assert r["last_odd"] == (before[-1] if before else None) and r["next_odd"] == (later[0] if later else None)


def test_long_histories_are_shuffled_once(spark):
    df, _ = skewed(spark)
    changes = df.filter("k is not null").groupBy("k", "ts").agg(F.max("v").alias("v"))
    built = scd.scd2_from_changes(changes, ["k"], ["v"], "ts", long_keys=True)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange rangepartitioning") == 0


@pytest.mark.parametrize("salts", [0, 3])
def test_lookup_keeps_every_row(spark, salts):
    df, data = skewed(spark)
    dim = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, sk int")
    got = lookup.lookup(df, dim, ["k"], ["sk"], salts=salts)
    known = {"hot": 1, "k3": 2}
    assert rows(got, "id", "sk") == sorted([(i, known.get(k)) for i, k, _, _ in data], key=repr)


def test_best_version_falls_back_to_history(spark):
    data = [("a", True, 1, 10), ("a", False, 5, 11), ("b", False, 1, 12), ("b", False, 2, 13)]
    dim = spark.createDataFrame(data, "k string, is_current boolean, effective_from int, sk int")
    assert rows(lookup.best_version(dim, ["k"]), "k", "sk") == [("a", 10), ("b", 13)]


def test_blank_ids_do_not_wait(spark):
    data = [(1, " ", None), (2, None, None), (3, "s1", None), (4, "s2", 7)]
    df = spark.createDataFrame(data, "id int, sid string, sk int")
    ready, backlog = lookup.split_pending(df, {"sid": "sk"})
    assert rows(ready, "id") == [(1,), (2,), (4,)] and rows(backlog, "id") == [(3,)]


def test_routes_take_the_first_match(spark):
    df = spark.range(10)
    parts = lookup.split_by(df, {"low": F.col("id") < 3, "mid": F.col("id") < 6})
    assert {k: v.count() for k, v in parts.items()} == {"low": 3, "mid": 3, "SKIP": 4}


# ---- upserts, keys, dimensions ----


def two_tables(spark):
    t = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (3, "c", 30), (None, "n", 0)], "k int, v string, first_seen int"
    )
    s = spark.createDataFrame([(2, "b", 99), (3, "x", 99), (4, "d", 99), (None, "m", 99)], "k int, v string, first_seen int")
    return t, s


def test_upsert_actions_and_insert_only(spark):
    t, s = two_tables(spark)
    out = upsert.upsert_actions(t, s, ["k"], insert_only=["first_seen"])
    assert rows(out, "k", "v", "first_seen", "action") == sorted(
        [
            (1, "a", 10, "kept"),
            (2, "b", 20, "unchanged"),
            (3, "x", 30, "update"),
            (4, "d", 99, "insert"),
            (None, "n", 0, "kept"),
            (None, "m", 99, "insert"),
        ],
        key=repr,
    )


def test_upsert_twice_is_upsert_once(spark):
    t, s = two_tables(spark)
    s = s.filter("k is not null")
    once = upsert.upsert(t, s, ["k"])
    assert rows(once, "k", "v", "first_seen") == rows(upsert.upsert(once, s, ["k"]), "k", "v", "first_seen")
    again = upsert.upsert_stats(once, s, ["k"])
    assert dict(rows(again, "action", "n_rows")) == {"kept": 2, "unchanged": 3}


def test_one_per_key_keeps_null_keys(spark):
    df, data = skewed(spark)
    got = upsert.one_per_key(df, ["k"], ["ts", "id"])
    assert got.count() == len({k for _, k, _, _ in data if k}) + sum(k is None for _, k, _, _ in data)


def test_upsert_partitions_leaves_other_partitions_out(spark):
    t = spark.createDataFrame([(1, "p1", 1), (2, "p1", 2), (3, "p2", 3)], "k int, p string, v int")
    s = spark.createDataFrame([(2, "p1", 5), (9, "p1", 9)], "k int, p string, v int")
    got = upsert.upsert_partitions(t, s, ["k"], ["p"])
    assert rows(got, "k", "p", "v") == [(1, "p1", 1), (2, "p1", 5), (9, "p1", 9)]


def test_keys_are_dense_and_stable(spark):
    old = spark.createDataFrame([(7, "x")], "sk bigint, k string")
    new = spark.createDataFrame([(f"n{i}",) for i in range(300)], "k string")
    got = keys.allocate_keys(new, old, "sk", ["k"])
    assert sorted(r["sk"] for r in got.collect()) == list(range(8, 308))
    assert rows(got, "sk", "k") == rows(keys.allocate_keys(new.repartition(7), old, "sk", ["k"]), "sk", "k")


def test_scd2_changes_in_any_order_give_the_sorted_history(spark):
    rnd = random.Random(9)
    kind = "k int, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, version bigint"
    log = {k: [(datetime(2024, 1, 1 + i), f"v{i}") for i in range(4)] for k in range(6)}
    orders = {k: rnd.sample(range(4), 4) for k in log}
    dim = spark.createDataFrame([], kind)
    for step in range(4):
        batch = [(k, log[k][orders[k][step]][1], log[k][orders[k][step]][0]) for k in log]
        dim = scd.scd2_apply(dim, spark.createDataFrame(batch, "k int, v string, ts timestamp_ntz"), ["k"], ["v"], "ts")
        dim = spark.createDataFrame(dim.collect(), kind)
    want = [
        (k, v, at, log[k][i + 1][0] if i < 3 else None, i == 3, i + 1) for k in log for i, (at, v) in enumerate(log[k])
    ]
    shown = ("k", "v", "effective_from", "effective_to", "is_current", "version")
    assert rows(dim, *shown) == sorted(want, key=repr)


def test_scd2_late_changes_that_meet_their_neighbours(spark):
    day = lambda d: datetime(2024, 1, d)
    kind = "k int, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, version bigint"
    dim = spark.createDataFrame(
        [(k, "a", day(1), day(10), False, 1) for k in range(5)] + [(k, "b", day(10), None, True, 2) for k in range(4)]
        + [(4, "b", day(10), day(20), False, 2)],
        kind,
    )
    changes = [(0, "a", day(5)), (1, "b", day(5)), (2, "c", day(10)), (3, "c", day(5)), (4, "c", day(15))]
    got = scd.scd2_apply(dim, spark.createDataFrame(changes, "k int, v string, ts timestamp_ntz"), ["k"], ["v"], "ts")
    by = {}
    for r in got.orderBy("k", "version").collect():
        by.setdefault(r["k"], []).append((r["v"], r["effective_from"].day, r["effective_to"] and r["effective_to"].day))
    assert by[0] == [("a", 1, 10), ("b", 10, None)]  # valid anyway
    assert by[1] == [("a", 1, 5), ("b", 5, None)]  # the next version begins earlier
    assert by[3] == [("a", 1, 5), ("c", 5, 10), ("b", 10, None)]
    assert by[4] == [("a", 1, 10), ("b", 10, 15), ("c", 15, 20)]  # inside a closed version
    assert got.filter("effective_to < effective_from").count() == 0


def history(spark, rows_):
    """Versions of one key from (value, start day, end day, surrogate key)."""
    day = lambda d: d and datetime(2024, 1, d)
    kind = "k int, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, version bigint, sk int"
    return spark.createDataFrame([(1, v, day(a), day(b), b is None, i + 1, sk) for i, (v, a, b, sk) in enumerate(rows_)], kind)


@pytest.mark.parametrize(
    "stored,change,want",
    [
        # A correction at the start of the current, of an older and of the first version.
        ([("a", 1, 10, 10), ("b", 10, None, 11)], ("c", 10), [("a", 1, 10, 10), ("c", 10, None, 11)]),
        ([("a", 1, 5, 10), ("b", 5, 9, 11), ("a", 9, None, 12)], ("c", 5), [("a", 1, 5, 10), ("c", 5, 9, 11), ("a", 9, None, 12)]),
        ([("a", 1, 10, 10), ("b", 10, None, 11)], ("c", 1), [("c", 1, 10, 10), ("b", 10, None, 11)]),
        # It makes neighbours equal: they join, and the earlier key holds.
        ([("a", 1, 5, 10), ("b", 5, 9, 11), ("c", 9, None, 12)], ("a", 5), [("a", 1, 9, 10), ("c", 9, None, 12)]),
        ([("a", 1, 5, 10), ("b", 5, 9, 11), ("c", 9, None, 12)], ("c", 5), [("a", 1, 5, 10), ("c", 5, None, 11)]),
        ([("a", 1, 5, 10), ("b", 5, 9, 11), ("a", 9, None, 12)], ("a", 5), [("a", 1, None, 10)]),
        # An older change: later versions keep their keys; equal to the next one, that begins earlier.
        ([("a", 1, 10, 10), ("b", 10, None, 11)], ("c", 5), [("a", 1, 5, 10), ("c", 5, 10, None), ("b", 10, None, 11)]),
        ([("a", 1, 10, 10), ("b", 10, None, 11)], ("b", 5), [("a", 1, 5, 10), ("b", 5, None, 11)]),
        ([("a", 3, 10, 10), ("b", 10, None, 11)], ("c", 2), [("c", 2, 3, None), ("a", 3, 10, 10), ("b", 10, None, 11)]),
        # Gaps: inside one, at its start and after the end; a stored end stays.
        ([("a", 1, 5, 10), ("b", 10, None, 11)], ("c", 7), [("a", 1, 5, 10), ("c", 7, 10, None), ("b", 10, None, 11)]),
        ([("a", 1, 5, 10), ("b", 10, None, 11)], ("a", 5), [("a", 1, 10, 10), ("b", 10, None, 11)]),
        ([("a", 1, 5, 10)], ("b", 9), [("a", 1, 5, 10), ("b", 9, None, None)]),
        ([("a", 1, 5, 10)], ("b", 3), [("a", 1, 3, 10), ("b", 3, 5, None)]),
        # Nothing new; two stored versions that say the same stay apart.
        ([("a", 1, 5, 10), ("a", 5, None, 11)], ("a", 9), [("a", 1, 5, 10), ("a", 5, None, 11)]),
        ([("a", 1, None, 10)], ("a", 1), [("a", 1, None, 10)]),
        ([("a", 1, None, 10)], (None, 4), [("a", 1, 4, 10), (None, 4, None, None)]),
    ],
)
def test_versions_keep_their_keys(spark, stored, change, want):
    source = spark.createDataFrame([(1, change[0], datetime(2024, 1, change[1])), (None, "x", None)], "k int, v string, ts timestamp_ntz")
    got = scd.scd2_apply(history(spark, stored), source, ["k"], ["v"], "ts", extra=["sk"]).orderBy("effective_from").collect()
    assert [(r["v"], r["effective_from"].day, r["effective_to"] and r["effective_to"].day, r["sk"]) for r in got] == want
    assert [r["version"] for r in got] == list(range(1, len(want) + 1))
    assert [r["is_current"] for r in got] == [w[2] is None for w in want]


@pytest.mark.parametrize(
    "before,after,want",
    [
        ([("a", 1, 10, 10), ("b", 10, None, 11)], [("a", 1, 5, 10), ("c", 5, 10, 12), ("b", 10, None, 11)], [(5, 10)]),
        ([("a", 1, 10, 10), ("b", 10, None, 11)], [("a", 1, 5, 10), ("b", 5, None, 11)], [(5, 10)]),
        ([("a", 1, 5, 10), ("b", 5, 9, 11), ("c", 9, None, 12)], [("a", 1, 9, 10), ("c", 9, None, 12)], [(5, 9)]),
        ([("a", 1, 5, 10), ("b", 5, 9, 11), ("a", 9, None, 12)], [("a", 1, None, 10)], [(5, None)]),
        ([("a", 1, None, 10)], [("a", 1, 8, 10), ("b", 8, None, 13)], [(8, None)]),
        ([("a", 1, None, 10)], [("a", 1, 8, 10)], []),
        ([], [("a", 1, None, 10)], []),
    ],
)
def test_intervals_that_changed_their_version(spark, before, after, want):
    got = scd.gained_intervals(history(spark, before), history(spark, after), ["k"], "sk").collect()
    assert sorted((r["low"].day, r["high"] and r["high"].day) for r in got) == want


def test_the_second_spelling_matches(spark):
    master = spark.createDataFrame([("c", None, "Main St"), ("c", "m1", "Main St"), ("c", "m2", None)], "city string, mid string, mname string")
    legs = spark.createDataFrame([("c", "e1", "A street", "main st."), ("c", "m2", None, "Other")], "city string, id string, one string, two string")
    found = match.entities(legs, [{"id": "id", "name": "one"}, {"id": "id", "name": "two"}], ["city"])
    every = match.match_entities(found, master, "city", ["mid"], "mid", "mname")
    best = match.best_spelling(every, ["city"])
    shown = ("entity_id", "entity_name", "candidate_master_key", "match_method")
    assert every.count() == 4
    assert rows(best, *shown) == [("e1", "main st.", "m1", "NORMALIZED_NAME"), ("m2", "Other", "m2", "EXACT_ID")]


def test_scd2_rerun_changes_nothing(spark):
    dim = spark.createDataFrame(
        [],
        "k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, version bigint",
    )
    first = spark.createDataFrame([("a", "1", datetime(2024, 1, 1)), ("b", None, datetime(2024, 1, 1))],
                                  "k string, v string, ts timestamp_ntz")
    later = spark.createDataFrame([("a", "2", datetime(2024, 2, 1)), ("b", None, datetime(2024, 2, 1))],
                                  "k string, v string, ts timestamp_ntz")
    shown = ("k", "v", "effective_from", "effective_to", "is_current", "version")
    one = scd.scd2_apply(dim, first, ["k"], ["v"], "ts", scd.FIRST_FROM)
    two = scd.scd2_apply(one, later, ["k"], ["v"], "ts", scd.FIRST_FROM)
    assert rows(two, *shown) == sorted(
        [
            ("a", "1", datetime(1900, 1, 1), datetime(2024, 2, 1), False, 1),
            ("a", "2", datetime(2024, 2, 1), None, True, 2),
            ("b", None, datetime(1900, 1, 1), None, True, 1),
        ],
        key=repr,
    )
    assert rows(scd.scd2_apply(two, later, ["k"], ["v"], "ts", scd.FIRST_FROM), *shown) == rows(two, *shown)


def test_soft_close_and_reopen(spark):
    t0, t1, t2 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
    master = spark.createDataFrame(
        [("a", "x", "active", True, t0, None)],
        "k string, name string, row_status string, is_current boolean, effective_from timestamp_ntz,"
        " effective_to timestamp_ntz",
    )

    def op(kind, at):
        return spark.createDataFrame([("a", "y", kind, at)], "k string, name string, operation string, now timestamp_ntz")

    gone = scd.apply_operations(master, op("DELETE", t1), ["k"], ["name"], "now")
    assert rows(gone, "name", "row_status", "is_current", "effective_to") == [("x", "deleted", False, t1)]
    assert rows(scd.deleted_only(gone, ["k"]), "k", "effective_to") == [("a", t1)]
    back = scd.apply_operations(gone, op("UPDATE", t2), ["k"], ["name"], "now")
    assert rows(back, "name", "is_current", "effective_from") == sorted([("x", False, t0), ("y", True, t2)], key=repr)
    assert scd.deleted_only(back, ["k"]).count() == 0
    assert rows(scd.apply_operations(gone, op("DELETE", t2), ["k"], ["name"], "now"), "name") == [("x",)]


# ---- change detection and matching ----


def test_fingerprint_ignores_order_and_sees_one_change(spark):
    df, _ = skewed(spark)
    shuffled = df.orderBy(F.rand(1)).repartition(5)
    changed = df.withColumn("v", F.when(F.col("id") == 17, 99).otherwise(F.col("v")))
    base = rows(cdc.fingerprint(df.drop("k"), []), "row_count", "fingerprint")
    assert base == rows(cdc.fingerprint(shuffled.drop("k"), []), "row_count", "fingerprint")
    assert base != rows(cdc.fingerprint(changed.drop("k"), []), "row_count", "fingerprint")


def test_fuzzy_match_equals_all_pairs(spark):
    rnd = random.Random(5)
    names = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 7))) for _ in range(60)]
    df = spark.createDataFrame([("c", n) for n in names], "city string, name string")

    def distance(a, b):
        prev = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            line = [i]
            for j, y in enumerate(b, 1):
                line.append(min(prev[j] + 1, line[-1] + 1, prev[j - 1] + (x != y)))
            prev = line
        return prev[-1]

    for limit, long_name in ((1, 64), (2, 0), (3, 0), (2, 3)):
        got = match.fuzzy_match(df, df, "city", "name", "name", limit, long_name)
        want = {(a, b, distance(a, b)) for a in names for b in names if distance(a, b) <= limit}
        assert rows(got, "left_name", "right_name", "distance") == sorted(want, key=repr)

    # Long names with up to four edits, a few of them in many places; the number of signatures is small.
    base = ["".join(rnd.choice("abcdefgh") for _ in range(200)) for _ in range(6)]
    long_names = list(base)
    for text in base:
        for edits in (1, 2, 3, 4):
            chars = list(text)
            for _ in range(edits):
                at, kind = rnd.randrange(len(chars)), rnd.randrange(3)
                chars[at : at + (kind != 1)] = [] if kind == 0 else ["z"]
            long_names.append("".join(chars))
    df = spark.createDataFrame([("c", n) for n in long_names], "city string, name string")
    for limit in (1, 3):
        got = match.fuzzy_match(df, df, "city", "name", "name", limit)
        want = {(a, b, distance(a, b)) for a in long_names for b in long_names if distance(a, b) <= limit}
        assert rows(got, "left_name", "right_name", "distance") == sorted(want, key=repr)
    sizes = df.select(F.size(match.met_segments(F.col("name"), 2)).alias("n"), F.size(match.own_segments(F.col("name"), 2)).alias("m"))
    assert sizes.agg(F.max("n"), F.max("m")).first()[:] <= (25, 3)


def test_signatures_of_few_names_are_not_sent_to_the_driver(spark):
    """Some names are small, their thousands of deletion variants are not: that join is a shuffle."""
    df = spark.createDataFrame([("c", f"{i:04}" * 15) for i in range(8)], "city string, name string")
    got = match.fuzzy_match(df, df, "city", "name", "name", 2)
    assert rows(got, "left_name", "right_name", "distance") == [(f"{i:04}" * 15, f"{i:04}" * 15, 0) for i in range(8)]
    joins = re.findall(r"(\w+Join) \[city#\d+, __v#\d+L?\]", executed(got))
    assert set(joins) == {"SortMergeJoin"}


def test_shared_names_do_not_multiply(spark):
    master = spark.createDataFrame([("c", f"m{i:03}", "Same Name") for i in range(50)], "city string, mid string, mname string")
    found = spark.createDataFrame([("c", f"e{i}", "same  name!") for i in range(50)],
                                  "city string, entity_id string, entity_name string")
    got = match.match_entities(found, master, "city", ["mid"], "mid", "mname")
    assert got.count() == 50 and {r["candidate_master_key"] for r in got.collect()} == {"m000"}


# ---- rules ----


def test_summary_and_details_differ_on_purpose(spark):
    fields = [*bike.TRIP_FIELDS, "source_city_code", "trip_month", "load_run_id", "source_file", "source_row_number"]
    ok = dict(ride_id="r1", started_at="2024-01-01 00:00:00", start_station_id="s", end_station_id="e",
              source_city_code="CHI", trip_month="202401", source_file="f")
    cases = [
        ok,
        {**ok, "ride_id": " r1"},  # equal only after trimming
        {**ok, "ride_id": None},
        {**ok, "ride_id": None},  # NULL keys group in the summary only
        {**ok, "ride_id": None, "trip_month": "x"},  # unguarded in the summary only
        {**ok, "ride_id": "r2", "start_station_id": " "},
        {**ok, "ride_id": "r3", "start_station_id": None, "end_station_id": ""},
        {**ok, "ride_id": "r4"},
        {**ok, "ride_id": "r4"},
    ]
    data = [tuple({**c, "source_row_number": str(i)}.get(f) for f in fields) for i, c in enumerate(cases)]
    raw = spark.createDataFrame(data, ", ".join(f"{f} string" for f in fields))
    rule_set = bike.trip_rules("CITI", "citibike_trips")
    details = {}
    for code, n in rows(rules.dq_details(raw, rule_set), "rule_code", "source_row_number"):
        details.setdefault(code, []).append(int(n))
    assert details == {
        "CITI_NULL_REQUIRED": [2, 3, 4],
        "CITI_DUPLICATE_RIDE": [7, 8],
        "CITI_REJECT_BOTH_STATION_ID": [6],
        "CITI_WARN_STATION_ID": [5],
    }
    summary = {r["rule_code"]: (r["passed_count"], r["failed_count"], r["warning_count"])
               for r in rules.dq_summary(raw, rule_set).collect()}
    assert summary["CITI_DUPLICATE_RIDE"] == (4, 5, 0)
    assert summary["CITI_FORMAT_TRIP_MONTH"] == (8, 1, 0)
    assert summary["CITI_WARN_STATION_ID"] == (8, 0, 1)
    assert rows(rules.accept_rows(raw, rule_set), "source_row_number") == [("0",), ("1",), ("5",), ("7",), ("8",)]


def test_gate_stops_on_missing_status(spark):
    control = spark.createDataFrame([("a", "SUCCESS"), ("b", None)], "source_name string, status string")
    rules.dq_gate(control, ["a"])
    with pytest.raises(rules.GateClosed, match="b"):
        rules.dq_gate(control)


def test_window_bounds(spark):
    at = [datetime(2024, 1, d) for d in (6, 7, 10, 20, 21)]
    df = spark.createDataFrame([(t,) for t in at], "t timestamp_ntz")
    span = (datetime(2024, 1, 10), datetime(2024, 1, 20))
    assert rows(incremental.incremental(df, "t", *span), "t") == [(at[3],)]
    assert rows(incremental.incremental(df, "t", *span, lookback_days=3), "t") == sorted([(t,) for t in at[1:4]], key=repr)


# ---- snapshots ----


def test_unchanged_snapshots_are_compared_by_digests(spark):
    data = [(i, f"c{i % 7}", None if i % 5 == 0 else float(i)) for i in range(500)]
    kind = "id int, city string, value double"
    rows_ = spark.createDataFrame(data, kind)
    old = snapshots.write_snapshot(rows_, scratch_path(spark, "snap"), ["id"], 32)
    # Another order of rows and columns is the same snapshot.
    again = snapshots.write_snapshot(rows_.orderBy(F.desc("id")).select("value", "id", "city"), scratch_path(spark, "snap"), ["id"], 32)
    assert snapshots.changed_buckets(old, again) == []
    same = snapshots.diff_snapshots(old, again, ["city", "value"])
    assert same.inputFiles() == [] and same.count() == 0 and snapshots.deleted_rows(old, again).count() == 0

    changed = [(i, "new" if i == 17 else c, v) for i, c, v in data if i != 401] + [(999, "c", 1.0)]
    new = snapshots.write_snapshot(spark.createDataFrame(changed, kind), scratch_path(spark, "snap"), ["id"], 32)
    hit = {r[0] for r in rows_.unionByName(spark.createDataFrame(changed, kind)).filter("id in (17, 401, 999)").select(F.pmod(F.xxhash64("id"), F.lit(32))).collect()}
    assert set(snapshots.changed_buckets(old, new)) == hit
    found = snapshots.diff_snapshots(old, new, ["city", "value"])
    assert {int(f.partition("key_bucket=")[2].partition("/")[0]) for f in found.inputFiles()} == hit
    assert rows(found, "id", "change_type", "changed_columns") == sorted(
        [(17, "CHANGED", "city"), (401, "DELETED", ""), (999, "INSERTED", "")], key=repr
    )
    assert rows(snapshots.deleted_rows(old, new), "id") == [(401,)]
    assert old.rows().count() == 500


def test_a_repeated_row_changes_the_digest(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    two = one.unionByName(one.filter("id = 1")).unionByName(one.filter("id = 1"))
    a, b = (snapshots.write_snapshot(df, scratch_path(spark, "snap"), ["id"], 4) for df in (one, two))
    assert len(snapshots.changed_buckets(a, b)) == 1
    empty = snapshots.write_snapshot(one.limit(0), scratch_path(spark, "snap"), ["id"], 4)
    assert rows(snapshots.deleted_rows(a, empty), "id") == [(1,), (2,)] and snapshots.changed_buckets(empty, empty) == []
    other = snapshots.write_snapshot(one, scratch_path(spark, "snap"), ["id"], 8)
    with pytest.raises(ValueError, match="laid out"):
        snapshots.changed_buckets(a, other)
