"""Snapshots with digests: two of them are compared bucket by bucket before any row is read.

A snapshot lies in folders by hash bucket of its key, beside a table with a count and a
digest of each bucket. Equal digests mean equal rows, in any order, so a comparison reads
the digests and then only the buckets in which something changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cdc
from tidemark.sources.sinks import write_replace

# One changed key makes one bucket be read: more buckets for larger tables with few changes.
BUCKETS = 1024
BUCKET = "key_bucket"
_DIGESTS = f"{BUCKET} int, buckets int, row_count bigint, digest string"


@dataclass(frozen=True)
class Snapshot:
    """A stored snapshot below ``path``: ``rows`` by bucket, and ``digests``."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: T.StructType

    def digests(self) -> DataFrame:
        return self.spark.read.schema(_DIGESTS).parquet(f"{self.path}/digests")

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of the given buckets; no other folder is listed or read."""
        if buckets is None:
            return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        own = {r[BUCKET] for r in self.digests().select(BUCKET).collect()}
        paths = [f"{self.path}/rows/{BUCKET}={b}" for b in buckets if b in own]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> Snapshot:
    """Store ``df``; rows with NULL in the key have a bucket like others."""
    placed = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    write_replace(placed, f"{path}/rows", [BUCKET])
    snapshot = Snapshot(df.sparkSession, path, tuple(keys), df.schema)
    stored = snapshot.spark.read.schema(placed.schema).parquet(f"{path}/rows")
    hashes = cdc.row_number_hashes(sorted(df.columns))
    digest = F.concat_ws(":", *[F.sum(h).cast("string") for h in hashes])
    found = stored.groupBy(BUCKET).agg(F.lit(buckets).alias("buckets"), F.count(F.lit(1)).alias("row_count"), digest.alias("digest"))
    found.select(*[c.split()[0] for c in _DIGESTS.split(", ")]).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")
    return snapshot


def changed_buckets(old: Snapshot, new: Snapshot) -> list[int]:
    """Buckets whose digests differ, from the digests alone; at most as many as there are buckets."""
    counts = {r["buckets"] for s in (old, new) for r in s.digests().select("buckets").distinct().collect()}
    if old.keys != new.keys or len(counts) > 1:
        raise ValueError("the snapshots are laid out by different keys or numbers of buckets")
    a = old.digests().select(BUCKET, F.struct("row_count", "digest").alias("a"))
    b = new.digests().select(BUCKET, F.struct("row_count", "digest").alias("b"))
    differ = a.join(b, BUCKET, "full").filter(~F.col("a").eqNullSafe(F.col("b")))
    return sorted(r[BUCKET] for r in differ.select(BUCKET).collect())


def diff_snapshots(old: Snapshot, new: Snapshot, cols: Sequence[str]) -> DataFrame:
    """As ``cdc.diff_rows``, from the changed buckets of both. Keys must be unique and not NULL."""
    buckets = changed_buckets(old, new)
    return cdc.diff_rows(old.rows(buckets), new.rows(buckets), old.keys, cols)


def deleted_rows(old: Snapshot, new: Snapshot) -> DataFrame:
    """Rows of ``old`` whose key vanished, from the changed buckets of both."""
    buckets = changed_buckets(old, new)
    return cdc.detect_deleted(new.rows(buckets), old.rows(buckets), old.keys)
