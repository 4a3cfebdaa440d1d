"""From files to raw tables: reading, lineage and derived columns, and the appended practice loads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.functions import clean
from tidemark.plans import bike
from tidemark.sources import files
from tidemark.sources.sinks import replace_partitions

# The exported practice tables and their column types.
EXPORTS = {
    "ratings": {"rating_id": "int", "user_id": "int", "movie_id": "string", "rating": "double", "rated_at": "masked_ts",
                "last_update_timestamp": "masked_ts"},
    "revenues": {"revenue_id": "int", "movie_id": "string", "region": "string", "revenue_amount": "double",
                 "currency": "string", "revenue_date": "masked_ts", "last_update_timestamp": "masked_ts"},
}


def _lineage(df: DataFrame, ctx: RunContext, city_code: str) -> DataFrame:
    named = df.withColumn("source_file", F.element_at(F.split("source_file", "/"), -1))
    return files.land(named, ctx.load_run_id, ctx.cet, source_city_code=city_code)


def land_trips(spark: SparkSession, path: str, regex: str, city_code: str, ctx: RunContext) -> DataFrame:
    """Raw trips of the CSV files below ``path`` whose name matches ``regex``.

    Adds the month of the start, the city of the feed, the file's name, the row number in
    it and the run. A file whose header differs fails the load before a row is landed.
    """
    rows = files.read_csv_dir(spark, path, files.text_schema(bike.TRIP_FIELDS), regex, number_rows=True)
    return _lineage(rows, ctx, city_code).withColumn("trip_month", clean.year_month("started_at"))


def land_weather(spark: SparkSession, path: str, regex: str, city_code: str, ctx: RunContext) -> DataFrame:
    rows = files.read_csv_dir(spark, path, files.text_schema(bike.WEATHER_FIELDS), regex, number_rows=True)
    return _lineage(rows, ctx, city_code)


def land_stations(spark: SparkSession, path: str, city_code: str, ctx: RunContext) -> DataFrame:
    """Raw stations of the feed documents below ``path``, numbered inside each document."""
    feed = spark.read.schema(files.STATION_FEED).option("multiLine", True).json(path)
    rows = feed.select(F.col("_metadata.file_path").alias("source_file"), F.posexplode("data.stations").alias("n", "s"))
    text = {"gbfs_station_id": "station_id", "station_name": "name", "latitude": "lat", "longitude": "lon"}
    fields = [F.col(f"s.{text.get(c, c)}").cast("string").alias(c) for c in bike.STATION_FIELDS]
    numbered = rows.select(*fields, "source_file", (F.col("n") + 1).cast("bigint").alias("source_row_number"))
    return _lineage(numbered, ctx, city_code)


def batch_id(ctx: RunContext) -> str:
    """Batch of the practice loads: the start of the run."""
    return ctx.started_at.strftime("%Y/%m/%d %H:%M:%S")


def load_exports(
    spark: SparkSession, folders: Mapping[str, str], target: str, ctx: RunContext, kinds: Mapping[str, Mapping] = EXPORTS
) -> str:
    """Append the exported files of each kind to ``<target>/stg_<kind>`` under the run's batch.

    Text is trimmed and cast as declared. A run that is repeated replaces its own batch.
    """
    batch = batch_id(ctx)
    for kind, path in folders.items():
        rows = files.read_csv_text(spark, path, list(kinds[kind])).select(*clean.cast_columns(kinds[kind]))
        replace_partitions(rows.withColumn("batch_id", F.lit(batch)), f"{target}/stg_{kind}", ["batch_id"])
    return batch
