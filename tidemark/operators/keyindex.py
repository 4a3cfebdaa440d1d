"""Which parts of a table may hold given keys, from a small index beside it.

The index has a row per part (such as a month) and hash bucket with the 32-bit prints of
the keys that lie there. Bucket and print together are some 44 bits of the key's hash, four
bytes a key. Bits of a Bloom filter would be smaller only with more errors, and a part is
skipped only if not one of a batch's keys is named by mistake: a million keys against
sixteen million stored ones name a wrong part about once in ten batches. A part that holds
a key is always named. Readers of the named parts compare the keys themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import any_null

# 4096 buckets hold some 250,000 keys each at 10^9 keys a part.
BUCKETS = 4096
SCHEMA = "bucket int, prints array<int>"


def _spots(df: DataFrame, keys: Sequence[str], parts: Sequence[str], buckets: int) -> DataFrame:
    """Bucket and print of each complete key; a key with a NULL matches nothing."""
    h = F.xxhash64(*keys)
    bucket = F.pmod(h, F.lit(buckets)).cast("int").alias("bucket")
    mark = F.shiftright(h, 32).cast("int").alias("print")  # the upper half, with its sign
    return df.filter(~any_null(keys)).select(*parts, bucket, mark)


def key_index(df: DataFrame, keys: Sequence[str], parts: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``parts``, ``bucket`` and ``prints``: the index of ``df``, combined before the shuffle."""
    return _spots(df, keys, parts, buckets).groupBy(*parts, "bucket").agg(F.collect_set("print").alias("prints"))


def parts_holding(index: DataFrame, wanted: DataFrame, keys: Sequence[str], parts: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The distinct ``parts`` of which ``index`` names a key of ``wanted``; one join by bucket."""
    asked = _spots(wanted, keys, [], buckets).groupBy("bucket").agg(F.collect_set("print").alias("__asked"))
    return index.join(asked, "bucket").filter(F.arrays_overlap("prints", "__asked")).select(*parts).distinct()
