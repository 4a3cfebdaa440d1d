"""Keyed upsert and delete on snapshot tables.

Plain files have no row-level update, so an upsert produces the new snapshot. For
large targets use ``upsert_partitions``, which rewrites the touched partitions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import skew
from tidemark.operators.dedup import dedup_first


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    out = F.lit(False)
    for a, b in pairs:
        out = out | ~a.eqNullSafe(b)
    return out


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The winning source row per key. Rows with a NULL key all stay: they match nothing."""
    complete = source.filter(~skew.any_null(keys))
    return dedup_first(complete, keys, order).unionByName(source.filter(skew.any_null(keys)))


def upsert_actions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_only: Sequence[str] = (),
    null_keys: bool = True,
) -> DataFrame:
    """New snapshot plus ``action``: insert, update, unchanged or kept.

    Both sides hold one row per key (see ``one_per_key``). ``update_cols`` (default: all non-key columns of the
    source) are compared and overwritten; ``insert_only`` columns keep their first value.
    A NULL key matches nothing, so such rows are kept or inserted; they are spread over
    the tasks. ``null_keys=False`` says that there are none and saves that step.
    """
    cols = target.columns
    given = set(source.columns)
    if update_cols is None:
        update_cols = [c for c in cols if c in given and c not in keys and c not in insert_only]
    t_spread = skew.spread_null_keys(keys, target.columns) if null_keys else F.lit(0)
    s_spread = skew.spread_null_keys(keys, source.columns) if null_keys else F.lit(0)
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], t_spread.alias("t__"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols if c in given], s_spread.alias("s__"))
    cond = F.col("t__") == F.col("s__") if null_keys else F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t_{k}") == F.col(f"s_{k}"))
    in_t, in_s = F.col("t__").isNotNull(), F.col("s__").isNotNull()
    changed = differs([(F.col(f"t_{c}"), F.col(f"s_{c}")) for c in update_cols])
    action = (
        F.when(in_t & in_s & changed, "update").when(in_t & in_s, "unchanged").when(in_t, "kept").otherwise("insert")
    )

    def value(c: str) -> Column:
        if c not in given:
            return F.col(f"t_{c}").alias(c)
        if c in update_cols:
            return F.when(F.col("action").isin("update", "insert"), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)
        return F.when(F.col("action") == "insert", F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)

    joined = t.join(s, cond, "full").withColumn("action", action)
    return joined.select(*[value(c) for c in cols], "action")


def upsert(target, source, keys, update_cols=None, insert_only=(), null_keys=True) -> DataFrame:
    """The new snapshot of ``target``."""
    return upsert_actions(target, source, keys, update_cols, insert_only, null_keys).drop("action")


def upsert_stats(target, source, keys, update_cols=None, insert_only=(), null_keys=True) -> DataFrame:
    """Rows per action."""
    acts = upsert_actions(target, source, keys, update_cols, insert_only, null_keys)
    return acts.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


def upsert_partitions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """New content of the partitions that ``source`` touches, all other partitions left out.

    The partition columns must be functions of the key, so that a changed row cannot
    move. Write the result with ``sinks.replace_partitions``. The semi join prunes the
    scan of the target to the touched partitions at run time.
    """
    touched = source.select(*partition_cols).distinct()
    return upsert(target.join(touched, list(partition_cols), "left_semi"), source, keys, update_cols, insert_only)


def delete_matching(staged: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows that did not reach the target yet."""
    return staged.join(target.select(*keys), list(keys), "left_anti")


def matching(staged: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows that reached the target."""
    return staged.join(target.select(*keys), list(keys), "left_semi")
