"""Change detection on files, rows and schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.upsert import upsert


def row_number_hashes(cols: Sequence[str]) -> list[Column]:
    """The md5 of the row as JSON, as three numbers that can be summed; together they hold all its bits."""
    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return [F.conv(F.substring(F.md5(text), at, 11), 16, 10).cast("decimal(38,0)") for at in (1, 12, 23)]


def fingerprint(df: DataFrame, group: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Row count and order-independent content hash per group.

    A sum combines before the shuffle, so one huge file is no problem.
    """
    cols = [c for c in df.columns if c not in group and c not in exclude]
    sums = [F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).cast("string") for h in row_number_hashes(cols)]
    count = F.count(F.lit(1))
    named = [F.coalesce(F.col(g), F.lit("(unknown)")).alias(g) for g in group]
    text = F.concat_ws(":", count.cast("string"), *sums)
    return df.groupBy(*named).agg(count.alias("row_count"), F.md5(text).alias("fingerprint"))


def classify_change(current: DataFrame, manifest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NEW, CHANGED or UNCHANGED against the manifest."""
    old = manifest.select(*keys, F.col("fingerprint").alias("previous_fingerprint"))
    joined = current.join(old, list(keys), "left")
    previous = F.nullif(F.col("previous_fingerprint"), F.lit(""))
    kind = (
        F.when(previous.isNull(), "NEW").when(previous == F.col("fingerprint"), "UNCHANGED").otherwise("CHANGED")
    )
    return joined.withColumn("change_type", kind)


def update_manifest(manifest: DataFrame, classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest fingerprint per file. The classified rows themselves are appended to a log."""
    return upsert(manifest, classified, keys)


def detect_deleted(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key vanished from the source."""
    return target.join(source.select(*keys), list(keys), "left_anti")


def diff_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Inserted, deleted and changed keys with the names of the changed columns."""
    o = old.select(*keys, F.struct(*cols).alias("__o"))
    n = new.select(*keys, F.struct(*cols).alias("__n"))
    joined = o.join(n, list(keys), "full").filter(~F.col("__o").eqNullSafe(F.col("__n")))
    changed = F.array_compact(
        F.array(*[F.when(~F.col(f"__o.{c}").eqNullSafe(F.col(f"__n.{c}")), F.lit(c)) for c in cols])
    )
    kind = F.when(F.col("__o").isNull(), "INSERTED").when(F.col("__n").isNull(), "DELETED").otherwise("CHANGED")
    fields = F.when(kind == "CHANGED", F.array_join(changed, ",")).otherwise(F.lit(""))
    return joined.select(*keys, kind.alias("change_type"), fields.alias("changed_columns"))


def schema_drift(actual: StructType, declared: StructType) -> list[tuple[str, str, str]]:
    """(column, MISSING | EXTRA | RETYPED, detail) before anything is loaded."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    drift = [(c, "MISSING", t) for c, t in want.items() if c not in have]
    drift += [(c, "EXTRA", t) for c, t in have.items() if c not in want]
    drift += [(c, "RETYPED", f"{want[c]} -> {have[c]}") for c in want if c in have and have[c] != want[c]]
    return sorted(drift)
