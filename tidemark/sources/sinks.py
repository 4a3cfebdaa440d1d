"""Writers. Tables are folders of Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _by_partition(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition value together: few files instead of one per task.

    A rebalance is adaptive: Spark splits a value that holds very many rows over several
    tasks and merges small ones.
    """
    return df.hint("rebalance", *cols) if cols else df


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Truncate and load. The plan of ``df`` must not read ``path``."""
    writer = _by_partition(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = _by_partition(df, partition_by).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite exactly the partitions that occur in ``df``; the others stay."""
    (
        _by_partition(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_run(df: DataFrame, path: str) -> None:
    """Results of a run replace earlier results of the same ``load_run_id``."""
    replace_partitions(df, path, ["load_run_id"])


def export_csv(df: DataFrame, path: str) -> None:
    """Delimited files with a header, one part per task."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, **keep).csv(path)


def export_jsonl(df: DataFrame, path: str, text_col: str | None = None) -> None:
    """One JSON document per line, from columns or from a column that holds the text."""
    if text_col is None:
        df.write.mode("overwrite").json(path)
    else:
        df.select(F.col(text_col).alias("value")).write.mode("overwrite").text(path)


def log_rows(df: DataFrame, path: str, level: str = "ERROR") -> None:
    """Append findings; they may be many and are never brought to the driver."""
    write_append(df.withColumns({"log_level": F.lit(level), "logged_at": F.localtimestamp()}), path)


def truncate(spark: SparkSession, path: str, schema: StructType) -> None:
    write_replace(spark.createDataFrame([], schema), path)
