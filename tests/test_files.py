"""Row numbers of split files, run replacement and the shared folder."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.plans import bike, landing
from tidemark.session import scratch_path, work_dir
from tidemark.sources import files, sinks


def test_row_numbers_of_a_split_file(spark):
    path = scratch_path(spark, "lines")
    spark.range(20000).select(F.col("id"), F.repeat(F.lit("x"), 50).alias("pad")).coalesce(1).write.option(
        "header", True
    ).csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = files.read_csv_dir(spark, path, files.text_schema(["id", "pad"]), number_rows=True)
        assert df.count() == 20000
        assert df.filter("cast(id as bigint) + 1 <> source_row_number").count() == 0
        scan = spark.read.schema(files.text_schema(["id", "pad"])).option("header", True).csv(path)
        assert scan.select("_metadata.file_block_start").distinct().count() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_names_are_filtered_by_regex(spark):
    path = scratch_path(spark, "names")
    for name in ("trips_2024", "weather_2024"):
        spark.range(3).write.option("header", True).csv(f"{path}/{name}")
    found = files.read_csv_dir(spark, path, files.text_schema(["id"]), r"^nothing")
    assert found.count() == 0
    assert files.read_csv_dir(spark, path, files.text_schema(["id"]), r"\.csv$").count() == 6


def test_a_repeated_run_replaces_itself(spark):
    path = scratch_path(spark, "runs")
    for run, n in (("a", 3), ("b", 2), ("a", 1)):
        sinks.replace_run(spark.range(n).withColumn("load_run_id", F.lit(run)), path)
    got = spark.read.parquet(path).groupBy("load_run_id").count().collect()
    assert {r[0]: r[1] for r in got} == {"a": 1, "b": 2}


def test_work_dir_is_the_configured_one(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_reordered_header_fails_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,2\n")
    schema = files.text_schema(["a", "b"])
    with pytest.raises(Exception, match="header"):
        files.read_csv_dir(spark, str(tmp_path), schema).collect()
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "a.txt").write_text("z\n9\n")
    assert [tuple(r)[:2] for r in files.read_csv_dir(spark, str(tmp_path), schema, r"\.csv$").collect()] == [("1", "2")]
    assert files.read_csv_dir(spark, str(tmp_path), schema, r"\.tsv$", number_rows=True).collect() == []


def test_weather_and_stations_are_landed_with_their_place(spark, tmp_path):
    ctx = RunContext("r1", datetime(2026, 2, 16), cet=datetime(2026, 2, 16))
    (tmp_path / "lcd").mkdir()
    (tmp_path / "lcd" / "nyc.csv").write_text(
        ",".join(bike.WEATHER_FIELDS) + "\nw,2026-02-15T08:51:00,FM-15,1.5,T,3,\nw,2026-02-15T09:51:00,FM-15,2.5,0,3,RA\n"
    )
    hours = landing.land_weather(spark, str(tmp_path / "lcd"), r"\.csv$", "NYC", ctx)
    got = sorted((r["source_file"], r["source_row_number"], r["observation_ts"], r["source_city_code"]) for r in hours.collect())
    assert got == [("nyc.csv", 1, "2026-02-15T08:51:00", "NYC"), ("nyc.csv", 2, "2026-02-15T09:51:00", "NYC")]
    feed = {"last_updated": 1, "data": {"stations": [{"station_id": f"g{i}", "name": f"Stop {i}", "lat": 1.5, "lon": -2.5, "capacity": i} for i in (1, 2)]}}
    (tmp_path / "feed.json").write_text(json.dumps(feed, indent=1))
    rows = landing.land_stations(spark, str(tmp_path / "feed.json"), "NYC", ctx).orderBy("source_row_number").collect()
    assert [(r["gbfs_station_id"], r["latitude"], r["capacity"], r["source_row_number"], r["load_run_id"]) for r in rows] == [
        ("g1", "1.5", "1", 1, "r1"), ("g2", "1.5", "2", 2, "r1")
    ]
    staged = bike.stage_stations(landing.land_stations(spark, str(tmp_path / "feed.json"), "NYC", ctx), ctx)
    assert {r["short_name"] for r in staged.collect()} == {"g1", "g2"}
