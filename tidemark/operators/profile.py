"""One pass over a landed source: what its reports need beside the rows themselves.

``measured`` takes global counts while the rows flow into another write. ``profile`` groups
the rows once, by source file and by any number of keys, and keeps the fingerprints of the
files and the keys that occur more than once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators import cdc, skew


def measured(df: DataFrame, metrics: Mapping[str, Column], write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict]:
    """(what ``write`` gives for ``df``, the values of ``metrics`` over the rows that it read).

    Where Spark cuts the observed part out of the plan, as it may for empty results, the
    values come from a pass of their own.
    """
    seen = Observation()
    out = write(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]))
    try:
        values = seen.get
    except Py4JJavaError:  # the observed part is gone
        values = {}
    if set(values) != set(metrics):
        values = df.agg(*[c.alias(n) for n, c in metrics.items()]).first().asDict()
    return out, values


def profile(df: DataFrame, keys: Mapping[str, Column], exclude: Sequence[str] = (), file_col: str = "source_file") -> DataFrame:
    """Rows of kind ``file`` (name, rows, sums of row hashes) and of each kind in ``keys`` (key, rows).

    A key column is a struct; rows whose key is NULL as a whole take no part in that kind. Of
    the keys only those of two rows or more are kept. Counts combine before the one shuffle.
    """
    hashed = [c for c in df.columns if c not in (file_col, *exclude)]
    hashes = {f"h{i}": h for i, h in enumerate(cdc.row_number_hashes(hashed))}
    fields: dict[str, Column] = {"file": F.col(file_col), **keys, **hashes}
    types = dict(df.select(*[c.alias(n) for n, c in fields.items()]).dtypes)

    def entry(kind: str, *own: str) -> Column:
        parts = [(fields[n] if n in own else F.lit(None).cast(types[n])).alias(n) for n in fields]
        return F.struct(F.lit(kind).alias("kind"), *parts)

    entries = [entry("file", "file", *hashes), *[F.when(keys[k].isNotNull(), entry(k, k)) for k in keys]]
    rows = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    counted = rows.groupBy("kind", "file", *keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(h).alias(h) for h in hashes])
    return counted.filter("kind = 'file' or n_rows > 1")


def repeated(profiled: DataFrame, kind: str) -> DataFrame:
    """``__key`` and ``n_rows`` of the repeated keys of a kind."""
    return profiled.filter(F.col("kind") == kind).select(F.col(kind).alias("__key"), "n_rows")


def fingerprints(profiled: DataFrame, file_col: str = "source_file") -> DataFrame:
    """As ``cdc.fingerprint`` by file."""
    files = profiled.filter("kind = 'file'")
    sums = [F.coalesce(F.col(c), F.lit(0).cast("decimal(38,0)")).cast("string") for c in profiled.columns if c[0] == "h" and c[1:].isdigit()]
    text = F.concat_ws(":", F.col("n_rows").cast("string"), *sums)
    name = F.coalesce("file", F.lit("(unknown)")).alias(file_col)
    return files.select(name, F.col("n_rows").alias("row_count"), F.md5(text).alias("fingerprint"))


# Bits of the filter that keeps rows of unrepeated keys out of a join: 2^18 words of 64, a
# broadcast of some 10 MB whatever the input. A power of two. Ten million repeated keys would fill half of it.
BITS = 1 << 24


def _spot(key: Column, bits: int) -> tuple[Column, Column]:
    # Masks and shifts are never NULL, so no filter on the word gets between the counts and their use.
    at = F.xxhash64(key).bitwiseAND(F.lit(bits - 1).cast("long"))
    return F.shiftright(at, 6).cast("int"), at.bitwiseAND(F.lit(63).cast("long")).cast("int")


def mark_repeated(df: DataFrame, key: str, keys: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """``df`` with the flag ``name``: false where ``key`` (a struct column) is surely not among ``keys``.

    A filter of one bit per hashed key, broadcast; the rows are not shuffled. A NULL key is
    never among them.
    """
    word, bit = _spot(F.col("__key"), bits)
    one = F.expr("shiftleft(1L, __bit)")
    words = keys.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or(one).alias("__bits"))
    word, bit = _spot(F.col(key), bits)
    placed = df.withColumns({"__word": F.when(F.col(key).isNotNull(), word), "__bit": bit})
    joined = placed.join(F.broadcast(words), "__word", "left")  # at most bits / 64 rows
    flag = F.coalesce(F.col("__bits").bitwiseAND(one) != 0, F.lit(False))
    return joined.withColumn(name, flag).drop("__word", "__bit", "__bits")


def repeated_keys(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """``__key`` and ``n_rows`` of the keys of two rows or more, NULL being a key value; a narrow pass."""
    counts = skew.key_counts(df.select(skew.struct_key(keys).alias("__key")), ["__key"])
    return counts.filter("n_rows > 1")
