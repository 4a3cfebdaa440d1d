"""File and table sources with declared schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators.incremental import in_window
from tidemark.operators.ordered import rank_rows


def text_schema(names: Sequence[str]) -> StructType:
    """Every field as text, the landing form of a raw table."""
    return StructType([StructField(n, StringType()) for n in names])


def read_csv_dir(
    spark: SparkSession,
    path: str,
    schema: StructType,
    regex: str | None = None,
    recursive: bool = True,
    number_rows: bool = False,
    check_header: bool = True,
) -> DataFrame:
    """CSV files with a header below ``path`` whose name matches ``regex``.

    Other files are not read. Columns go by position, so with ``check_header`` a header
    whose names or order differ from the schema fails the read. Adds ``source_file``. ``number_rows`` adds the
    1-based data row number in the file; files are still split, see ``with_row_numbers``.
    """
    paths = [path] if regex is None else list_files(spark, path, regex, recursive)
    if not paths:
        extra = [StructField("source_file", StringType())]
        extra += [StructField("source_row_number", LongType())] if number_rows else []
        return spark.createDataFrame([], StructType([*schema.fields, *extra]))
    reader = spark.read.schema(schema).options(header=True, enforceSchema=not check_header)
    df = reader.option("recursiveFileLookup", recursive).csv(paths).select(
        *[f.name for f in schema.fields],
        F.col("_metadata.file_path").alias("source_file"),
        *([F.col("_metadata.file_block_start").alias("__block")] if number_rows else []),
        *([F.monotonically_increasing_id().alias("__mid")] if number_rows else []),
    )
    return with_row_numbers(df) if number_rows else df


def list_files(spark: SparkSession, path: str, regex: str, recursive: bool = True) -> list[str]:
    """Files below ``path`` whose name matches ``regex``; only the listing is read."""
    every = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return sorted(r["path"] for r in every.filter(name.rlike(regex)).collect())


def with_row_numbers(df: DataFrame) -> DataFrame:
    """``source_row_number`` from the block offset of each split.

    Rows are numbered inside a file block and shifted by the row counts of the blocks
    before it, so one huge file is numbered by many tasks.
    """
    return rank_rows(df, ["source_file"], [F.col("__mid")], "source_row_number", slice_by=F.col("__block")).drop(
        "__block", "__mid"
    )


def read_csv_positional(
    spark: SparkSession, path: str, n_fields: int, keep: Mapping[int, str], regex: str | None = None
) -> DataFrame:
    """Wide CSV read by position; only the kept columns are parsed."""
    schema = text_schema([f"f{i}" for i in range(n_fields)])
    df = read_csv_dir(spark, path, schema, regex, check_header=False)
    return df.select(*[F.col(f"f{i}").alias(n) for i, n in keep.items()], "source_file")


def read_csv_text(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Exported CSV with all fields as text."""
    return spark.read.schema(text_schema(names)).option("header", True).csv(path)


STATION_FEED = (
    "last_updated bigint, data struct<stations: array<struct<"
    "station_id: string, name: string, short_name: string, lat: double, lon: double, "
    "capacity: int, station_type: string, region_id: string>>>"
)


def read_json_feed(spark: SparkSession, path: str, schema: str = STATION_FEED, items: str = "data.stations") -> DataFrame:
    """One row per element of an array inside whole-file JSON documents."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.select(F.col("_metadata.file_path").alias("source_file"), F.explode(items).alias("i")).select(
        "i.*", "source_file"
    )


def json_fields(text: Column, paths: Mapping[str, str]) -> list[Column]:
    """Values at JSON paths as text; an array value stays JSON text."""
    return [F.get_json_object(text, p).alias(n) for n, p in paths.items()]


def read_json_lines(spark: SparkSession, path: str, paths: Mapping[str, str]) -> DataFrame:
    """One document per line, kept tolerant of mixed types by reading text."""
    return spark.read.text(path).select(*json_fields(F.col("value"), paths))


def read_documents(
    spark: SparkSession, path: str, schema: str, ts: str, lset: datetime, cet: datetime, lookback: int | None = None
) -> DataFrame:
    """Documents changed in the window."""
    return spark.read.schema(schema).json(path).filter(in_window(ts, lset, cet, lookback))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, query: str, split: tuple[str, int, int, int] | None = None, **options):
    """A database query; ``split`` = (column, lower, upper, parts) reads it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    if split is None:
        return reader.option("query", query).load()
    column, low, high, parts = split
    return (
        reader.option("dbtable", f"({query}) q")
        .options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
        .load()
    )


def land(df: DataFrame, load_run_id: str, loaded_at: datetime, **constants) -> DataFrame:
    """Add the lineage columns of a raw table."""
    stamp = F.lit(str(loaded_at)).cast("timestamp_ntz")
    out = df.withColumns({"load_run_id": F.lit(load_run_id), "raw_loaded_at": stamp})
    return out.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else out
