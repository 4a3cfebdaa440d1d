"""Lookups against dimensions.

No broadcast hints: Spark broadcasts a dimension whose size it knows, or measures at
run time, to be below ``spark.sql.autoBroadcastJoinThreshold``, and shuffles it
otherwise. For the shuffled case ``salts`` spreads hot keys and NULL keys of the fact
side over several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import clean
from tidemark.operators import ranged
from tidemark.operators.dedup import dedup_first
from tidemark.operators.skew import any_null


def lookup(
    df: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    cols: Mapping[str, str] | Sequence[str],
    salts: int = 0,
) -> DataFrame:
    """Left join that keeps every row; ``dim`` must hold one row per key.

    ``keys`` maps a column of ``df`` to one of ``dim``; ``cols`` maps a column of
    ``dim`` to its name in the result.
    """
    keys = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    cols = cols if isinstance(cols, Mapping) else {c: c for c in cols}
    side = dim.select(
        *[F.col(d).alias(f"__k_{d}") for d in keys.values()], *[F.col(c).alias(f"__v_{c}") for c in cols]
    )
    cond = F.lit(True)
    for left, right in keys.items():
        cond = cond & (df[left] == side[f"__k_{right}"])
    left_df = df
    if salts > 1:
        left_df = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
        side = side.withColumn("__dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cond = cond & (F.col("__salt") == F.col("__dim_salt"))
    joined = left_df.join(side, cond, "left")
    return joined.select(*[df[c] for c in df.columns], *[F.col(f"__v_{c}").alias(n) for c, n in cols.items()])


def lookup_current(df: DataFrame, dim: DataFrame, keys, cols, salts: int = 0) -> DataFrame:
    """Lookup of the current version only."""
    return lookup(df, dim.filter("is_current"), keys, cols, salts)


def best_version(dim: DataFrame, keys: Sequence[str], tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key: the current version, else the latest one."""
    order = [F.desc("is_current"), F.desc("effective_from"), *tie_break]
    return dedup_first(dim, keys, order)


def lookup_best(df: DataFrame, dim: DataFrame, keys, cols, tie_break: Sequence[Column | str] = (), salts: int = 0):
    """Lookup with history as the fallback. The dimension is ranked once, not per row."""
    dim_keys = list(keys.values()) if isinstance(keys, Mapping) else list(keys)
    return lookup(df, best_version(dim, dim_keys, tie_break), keys, cols, salts)


END_OF_TIME = "9999-12-31 00:00:00"


def scd2_lookup(
    df: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    ts: str,
    cols: Mapping[str, str] | Sequence[str],
    effective: tuple[str, str] = ("effective_from", "effective_to"),
    slice_months: bool = False,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Version valid at ``ts``: from <= ts < to, an open end never closes.

    Versions of a key must not overlap. With ``slice_months`` a version is repeated for
    the months it covers and joined on (key, month), so that a key with a long history
    or very many facts is compared month by month and not with its whole history. The
    months run from the least to the greatest ``ts`` of ``bounds``, a frame that is cheaper
    to read than ``df`` and holds all its times; by default of ``df`` itself.
    """
    keys = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    cols = cols if isinstance(cols, Mapping) else {c: c for c in cols}
    begin, end = effective
    forever = F.lit(END_OF_TIME).cast("timestamp_ntz")
    side = dim.select(
        *[F.col(d).alias(f"__k_{d}") for d in keys.values()],
        *[F.col(c).alias(f"__v_{c}") for c in cols],
        F.col(begin).alias("__from"),
        F.coalesce(F.col(end), forever).alias("__to"),
    )
    cond = (df[ts] >= F.col("__from")) & (df[ts] < F.col("__to"))
    for left, right in keys.items():
        cond = cond & (df[left] == side[f"__k_{right}"])
    left_df = df
    if slice_months:
        left_df = df.withColumn("__month", _month_number(F.col(ts)))
        spread = (df if bounds is None else bounds).select(_month_number(F.col(ts)).alias("__month"))
        seen = spread.agg(F.min("__month").alias("__lo"), F.max("__month").alias("__hi"))  # one row
        first = F.greatest(_month_number(F.col("__from")), F.col("__lo"))
        last = F.least(_month_number(F.col("__to")), F.col("__hi"))
        side = (
            side.crossJoin(seen)
            .filter(first <= last)
            .withColumn("__dim_month", F.explode(F.sequence(first, last)))
            .drop("__lo", "__hi")
        )
        cond = cond & (F.col("__month") == F.col("__dim_month"))
    joined = left_df.join(side, cond, "left")
    return joined.select(*[df[c] for c in df.columns], *[F.col(f"__v_{c}").alias(n) for c, n in cols.items()])


def merge_asof(
    df: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    ts: str,
    cols: Mapping[str, str] | Sequence[str],
    effective: tuple[str, str] = ("effective_from", "effective_to"),
    partitions: int | None = None,
) -> DataFrame:
    """``scd2_lookup`` for keys with very many facts or versions: a merge of both sides.

    Facts and versions are laid together in ranges of (key, time), and each fact takes the
    version that came last before it. Both sides are shuffled once; no version is repeated,
    and a hot key is spread by time. Facts with a NULL key or time find nothing.
    """
    keys = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    cols = cols if isinstance(cols, Mapping) else {c: c for c in cols}
    begin, end = effective
    names = [f"__k{i}" for i in range(len(keys))]
    row = [f"__c{i}" for i in range(len(df.columns))]
    body = F.struct(F.col(end).alias("__to"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    starts = dim.filter(~any_null([*keys.values(), begin])).select(
        *[F.col(d).alias(n) for d, n in zip(keys.values(), names)],
        F.col(begin).alias("__at"),
        F.lit(0).alias("__kind"),
        F.lit(0).cast("bigint").alias("__spread"),
        body.alias("__version"),
    )
    facts = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.col(ts).alias("__at"),
        F.lit(1).alias("__kind"),
        F.xxhash64(*[df[c] for c in df.columns]).alias("__spread"),
        *[df[c].alias(r) for c, r in zip(df.columns, row)],
    )
    both = facts.unionByName(starts, allowMissingColumns=True)
    laid = ranged.lay(both, names, ["__at", "__kind"], ["__spread"], partitions)
    seen = F.last("__version", True).over(laid.inside().rowsBetween(Window.unboundedPreceding, 0))
    scanned = laid.table.withColumn("__seen", seen).filter("__kind = 1")
    full = laid.carry(scanned, laid.table.filter("__kind = 0"), last={"__version": "__earlier"})
    last = F.coalesce("__seen", "__earlier")
    inside = F.col("__at").isNotNull() & (last["__to"].isNull() | (F.col("__at") < last["__to"]))
    found = [F.when(inside, last[f"v{i}"]).alias(n) for i, n in enumerate(cols.values())]
    return full.select(*[F.col(r).alias(c) for c, r in zip(df.columns, row)], *found)


def _month_number(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def split_by(df: DataFrame, routes: Mapping[str, Column], other: str = "SKIP") -> dict[str, DataFrame]:
    """First matching route wins; one lazily filtered frame per route."""
    route = None
    for name, cond in routes.items():
        route = F.when(cond, name) if route is None else route.when(cond, name)
    routed = df.withColumn("route", route.otherwise(other))
    return {name: routed.filter(F.col("route") == name) for name in [*routes, other]}


def keep_resolved(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def is_pending(id_to_sk: Mapping[str, str]) -> Column:
    """An id is given but its key is not known yet. Blank ids do not wait."""
    out = F.lit(False)
    for source_id, sk in id_to_sk.items():
        out = out | (~clean.is_blank(source_id) & F.col(sk).isNull())
    return out


def split_pending(df: DataFrame, id_to_sk: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(ready, backlog): the backlog is offered again on the next run."""
    pending = is_pending(id_to_sk)
    return df.filter(~pending), df.filter(pending)
