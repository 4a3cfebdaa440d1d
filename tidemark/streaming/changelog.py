"""Tables kept as changes by batch, folded from time to time.

A micro-batch appends the new state of the keys it touches, in a partition of its own, and
reads nothing; run again after a failure, it replaces that partition. The table is the last
change of each key. ``compact`` folds all changes into a base and deletes them, so that
reading stays cheap however long the stream runs. A base counts once it is complete, and a
reader takes the newest base and the changes after it, so a fold that fails changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tidemark.operators.dedup import dedup_first
from tidemark.session import delete, list_names
from tidemark.sources.sinks import replace_partitions

BATCH = "batch_id"


def store_changes(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer: the rows of a batch are the new state of their keys."""

    def store(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn(BATCH, F.lit(batch_id).cast("long")), f"{path}/changes", [BATCH])

    return store


def _bases(spark: SparkSession, path: str) -> list[int]:
    """Last batches of the complete bases, ascending."""
    found = [re.fullmatch(r"base-(\d+)", name) for name in list_names(spark, path)]
    return sorted(int(m[1]) for m in found if m and "_SUCCESS" in list_names(spark, f"{path}/{m[0]}"))


def changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows that readers must consider, with their batch."""
    full = StructType([*schema.fields]).add(BATCH, LongType())
    bases = _bases(spark, path)
    parts = [spark.createDataFrame([], full)]
    if bases:
        parts.append(spark.read.schema(full).parquet(f"{path}/base-{bases[-1]}"))
    if "changes" in list_names(spark, path):
        later = spark.read.schema(full).parquet(f"{path}/changes")
        parts.append(later.filter(F.col(BATCH) > bases[-1]) if bases else later)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def latest(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType) -> DataFrame:
    """The last state of each key."""
    return dedup_first(changes(spark, path, schema), keys, [F.desc(BATCH)]).drop(BATCH)


def compact(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType) -> int | None:
    """Folds all changes so far into a new base; gives its last batch, or None if there was nothing new."""
    return fold(spark, path, schema, lambda seen: dedup_first(seen, keys, [F.desc(BATCH)]))


def fold(spark: SparkSession, path: str, schema: StructType, merge: Callable[[DataFrame], DataFrame]) -> int | None:
    """``compact`` with ``merge`` to put the changes together; it gives rows of the same columns."""
    seen = changes(spark, path, schema)
    bases = _bases(spark, path)
    upto = seen.agg(F.max(BATCH)).first()[0]
    if upto is None or (bases and upto <= bases[-1]):
        return None
    folded = merge(seen.filter(F.col(BATCH) <= upto)).withColumn(BATCH, F.lit(upto).cast("long"))
    folded.select(*seen.columns).write.mode("overwrite").parquet(f"{path}/base-{upto}")
    for base in bases:
        delete(spark, f"{path}/base-{base}")
    for name in list_names(spark, f"{path}/changes"):
        if name.startswith(f"{BATCH}=") and int(name.partition("=")[2]) <= upto:
            delete(spark, f"{path}/changes/{name}")
    return upto
