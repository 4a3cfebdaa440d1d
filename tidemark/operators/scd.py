"""Slowly changing dimensions, master operations and late masters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import ranged, skew
from tidemark.operators.ordered import number_intervals, previous_value
from tidemark.operators.upsert import upsert

# Fixed value: start of the first version when the change time is not to be used.
FIRST_FROM = "1900-01-01 00:00:00"


def scd1(dim: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Overwrite attributes by key."""
    return upsert(dim, source, keys, update_cols=cols)


def scd3(dim: DataFrame, source: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Keep the previous value of ``col`` in ``prev_<col>`` when it changes."""
    prev = f"prev_{col}"
    s = source.select(*keys, F.col(col).alias("__new"), F.lit(True).alias("__hit"))
    known = F.col("__known").isNotNull()
    joined = dim.withColumn("__known", F.lit(True)).join(s, list(keys), "full")
    changed = known & F.col("__hit").isNotNull() & ~F.col(col).eqNullSafe(F.col("__new"))
    new_value = F.when(known & ~changed, F.col(col)).otherwise(F.col("__new"))
    new_prev = F.when(changed, F.col(col)).otherwise(F.col(prev))
    out = joined.withColumns({"__v": new_value, "__p": new_prev})
    names = {col: "__v", prev: "__p"}
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in dim.columns])


def signature(cols: Sequence[str]) -> Column:
    """The tracked values as one comparable, never NULL value."""
    return F.struct(*cols)


def scd2_from_changes(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    long_keys: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """All versions from a change log with one row per (key, ts).

    ``long_keys``: histories that may be too long for one task are dealt by ranges of (key,
    time). The log is shuffled once; the value before, the start after and the versions so
    far are carried from partition to partition.
    """
    if long_keys:
        numbered = _numbered_in_ranges(changes.select(*keys, *tracked, ts), keys, tracked, ts, partitions)
    else:
        seen = previous_value(changes, keys, ts, signature(tracked), "__prev")
        starts = seen.filter(~F.col("__prev").eqNullSafe(signature(tracked))).select(*keys, *tracked, ts)
        numbered = number_intervals(starts, keys, ts, "effective_to", "version")
    return numbered.select(
        *keys,
        *tracked,
        F.col(ts).alias("effective_from"),
        "effective_to",
        F.col("effective_to").isNull().alias("is_current"),
        "version",
    )


def _numbered_in_ranges(changes: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, partitions: int | None) -> DataFrame:
    """Changes that start a version, with its end and number."""
    laid = ranged.lay(changes, keys, [ts], partitions=partitions)
    rows, window = laid.table.withColumn("__now", signature(tracked)), laid.inside()
    seen = laid.carry(rows.withColumn("__prev", F.lag("__now").over(window)), rows, last={"__now": "__earlier"})
    starts = seen.filter(~F.coalesce("__prev", "__earlier").eqNullSafe(F.col("__now"))).select(ranged.PART, *keys, *tracked, ts)
    starts = starts.withColumns(
        {"__start": F.col(ts), "__nth": F.row_number().over(window).cast("bigint"), "__next": F.lead(ts).over(window)}
    )
    numbered = laid.carry(starts, starts, total={"__nth": "__sofar"}, first={"__start": "__later"})
    return numbered.withColumns(
        {
            "effective_to": F.coalesce("__next", "__later"),
            "version": F.col("__nth") + F.coalesce("__sofar", F.lit(0).cast("bigint")),
        }
    )


def scd2_apply(
    dim: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    first_from: str | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Apply one batch (one row per key): close changed versions, open new ones.

    ``dim`` holds keys, tracked, effective_from, effective_to, is_current, version.
    ``first_from`` replaces the change time for the first version of a key. ``extra`` columns
    of ``dim``, such as its surrogate key, stay with their version and are NULL for new ones.

    A version is known by its key and start; ``version`` is only its place. A change older
    than the current version goes into the history: it splits the version valid at its time,
    fills a gap, or precedes the first one. A change at the very start of a version corrects
    it. A change to what was valid anyway changes nothing, and one that makes two neighbours
    equal joins them: the earlier start and the earlier stored ``extra`` hold. No interval
    is empty. A change without a time is passed over.
    """
    cols = [*keys, *tracked, "effective_from", "effective_to", "is_current", "version"]
    key = list(keys)
    body = F.struct(*tracked)
    asked = source.filter(F.col(ts).isNotNull() & ~skew.any_null(keys)).select(*key, F.col(ts).alias("__ts"), body.alias("__body"))
    here = F.struct(*extra) if extra else F.struct(F.lit(True).alias("__stored"))
    touched = dim.join(asked.select(*key, F.lit(True).alias("__hit")), key, "left")
    others = touched.filter("__hit is null").select(*cols, *extra)
    mine = touched.filter("__hit")

    # The history of the touched keys as events, shuffled once: stored ends, stored starts, changes.
    def event(at: Column, rank: int, values: Column, kept: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(rank).alias("rank"), values.alias("body"), kept.alias("extra"))

    shape = dim.select(body.alias("b"), here.alias("e")).schema
    none = {c: F.lit(None).cast(shape[c].dataType) for c in ("b", "e")}
    starts = event(F.col("effective_from"), 1, body, here)
    ends = F.when(F.col("effective_to").isNotNull(), event(F.col("effective_to"), 0, none["b"], none["e"]))
    stored = mine.select(*key, F.explode(F.array_compact(F.array(starts, ends))).alias("__event"))
    changes = asked.select(*key, event(F.col("__ts"), 2, F.col("__body"), none["e"]).alias("__event"))
    events = stored.unionByName(changes).repartition(*key).select(*key, "__event.*")
    if first_from is not None:
        known = F.min("rank").over(Window.partitionBy(*key)) < 2
        events = events.withColumn("at", F.when(known, F.col("at")).otherwise(F.lit(first_from).cast("timestamp_ntz")))
    # One event per time: a change before a stored start before an end.
    states = events.groupBy(*key, F.col("at").alias("__at")).agg(
        F.max("rank").alias("__rank"), F.max_by("body", "rank").alias("__body"), F.max_by("extra", F.when(F.col("rank") == 1, 1)).alias("__extra")
    )
    w = Window.partitionBy(*key).orderBy("__at")
    live = F.col("__rank") > 0
    before = states.withColumns({"__was": F.lag("__body").over(w), "__by": F.lag("__rank").over(w)})
    # Two stored versions side by side stay apart, whatever they say.
    opens = F.col("__by").isNull() | ~F.col("__body").eqNullSafe(F.col("__was")) | ((F.col("__rank") == 1) & (F.col("__by") == 1))
    grouped = before.withColumn("__nth", F.sum(opens.cast("int")).over(w)).groupBy(*key, "__nth").agg(
        F.min("__at").alias("__at"),
        F.min_by("__body", "__at").alias("__body"),
        F.max(live).alias("__live"),
        F.min_by("__extra", F.when(F.col("__extra").isNotNull(), F.col("__at"))).alias("__extra"),
    )
    w = Window.partitionBy(*key).orderBy("__at")
    numbered = grouped.withColumns(
        {"effective_to": F.lead("__at").over(w), "version": F.sum(F.col("__live").cast("int")).over(w)}
    ).filter("__live")
    rebuilt = numbered.select(
        *key,
        *[F.col(f"__body.{c}").alias(c) for c in tracked],
        F.col("__at").alias("effective_from"),
        "effective_to",
        F.col("effective_to").isNull().alias("is_current"),
        F.col("version").cast(dim.schema["version"].dataType).alias("version"),
        *[F.col(f"__extra.{c}").alias(c) for c in extra],
    )
    return others.unionByName(rebuilt.select(*others.columns))


def gained_intervals(before: DataFrame, after: DataFrame, keys: Sequence[str], sk: str) -> DataFrame:
    """Times that a version took over from another one of its key: keys, ``low`` and ``high`` (NULL: open).

    Stored facts of these times point to the version that was valid before. Keys that
    ``before`` lacks have no such facts.
    """
    old = before.select(F.col(sk).alias("__sk"), F.col("effective_from").alias("__from"), F.col("effective_to").alias("__to"))
    known = before.select(*keys).distinct()
    joined = after.join(known, list(keys), "left_semi").join(old, F.col(sk) == F.col("__sk"), "left")
    span = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
    new, start, end = F.col("__sk").isNull(), F.col("effective_from"), F.col("effective_to")
    longer = F.col("__to").isNotNull() & (end.isNull() | (end > F.col("__to")))
    spans = F.array_compact(
        F.array(
            F.when(new, span(start, end)),
            F.when(~new & (start < F.col("__from")), span(start, F.col("__from"))),
            F.when(~new & longer, span(F.col("__to"), end)),
        )
    )
    return joined.select(*keys, F.explode(spans).alias("span")).select(*keys, "span.low", "span.high")


def deleted_only(master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose history holds deletions and no active row, with the latest end time."""
    active = master.filter("is_current and row_status = 'active'").select(*keys).distinct()
    gone = master.filter("row_status = 'deleted' and not is_current and effective_to is not null")
    return gone.join(active, list(keys), "left_anti").groupBy(*keys).agg(F.max("effective_to").alias("effective_to"))


def scd2_close(dim: DataFrame, deleted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Close the current version of deleted keys at their ``effective_to``."""
    d = deleted.select(*keys, F.col("effective_to").alias("__end"))
    joined = dim.join(d, list(keys), "left")
    close = F.col("is_current") & F.col("__end").isNotNull()
    out = joined.withColumns(
        {
            "effective_to": F.when(close, F.col("__end")).otherwise(F.col("effective_to")),
            "is_current": F.col("is_current") & ~close,
        }
    )
    return out.select(*dim.columns)


def route_operation(exists: Column, operation: Column, resolved: Column | None = None) -> Column:
    """INSERT, UPDATE, DELETE or SKIP for a master operation.

    A missing operation means UPDATE; whether a row is inserted or updated depends on
    its existence only; deleting an unknown row is skipped.
    """
    op = F.upper(F.coalesce(operation, F.lit("UPDATE")))
    route = F.when((op == "DELETE") & exists, "DELETE").when(op == "DELETE", "SKIP")
    route = route.when(exists, "UPDATE").otherwise("INSERT")
    return route if resolved is None else F.when(~resolved, F.lit("SKIP")).otherwise(route)


def apply_operations(
    master: DataFrame, ops: DataFrame, keys: Sequence[str], attrs: Sequence[str], now: str
) -> DataFrame:
    """Apply one operation per key to a master with soft deletes.

    ``master`` holds keys, attrs, row_status, is_current, effective_from, effective_to;
    ``ops`` holds keys, attrs, ``operation`` and the time column ``now``.
    """
    cols = [*keys, *attrs, "row_status", "is_current", "effective_from", "effective_to"]
    current = master.filter("is_current").select(*keys, F.lit(True).alias("__here"))
    routed = ops.join(current, list(keys), "left").withColumn(
        "__route", route_operation(F.col("__here").isNotNull(), F.col("operation"))
    )
    edits = routed.filter(F.col("__route").isin("UPDATE", "DELETE")).select(
        *keys, *[F.col(a).alias(f"o_{a}") for a in attrs], F.col(now).alias("__now"), "__route"
    )
    joined = master.select(*cols).join(edits, list(keys), "left")
    upd = F.col("is_current") & F.col("__route").eqNullSafe("UPDATE")
    dele = F.col("is_current") & F.col("__route").eqNullSafe("DELETE")
    kept = joined.select(
        *keys,
        *[F.when(upd, F.col(f"o_{a}")).otherwise(F.col(a)).alias(a) for a in attrs],
        F.when(dele, "deleted").otherwise(F.col("row_status")).alias("row_status"),
        (F.col("is_current") & ~dele).alias("is_current"),
        "effective_from",
        F.when(dele, F.col("__now")).otherwise(F.col("effective_to")).alias("effective_to"),
    )
    fresh = routed.filter("__route = 'INSERT'").select(
        *keys,
        *attrs,
        F.lit("active").alias("row_status"),
        F.lit(True).alias("is_current"),
        F.col(now).alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
    )
    return kept.unionByName(fresh)


def add_skeletons(dim: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Placeholder rows for keys that facts use and the dimension lacks."""
    used = facts.select(*keys).filter(~skew.any_null(keys)).distinct()
    missing = used.join(dim.select(*keys), list(keys), "left_anti")
    flagged = dim if "is_skeleton" in dim.columns else dim.withColumn("is_skeleton", F.lit(False))
    return flagged.unionByName(missing.withColumn("is_skeleton", F.lit(True)), allowMissingColumns=True)
