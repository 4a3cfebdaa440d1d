"""Mixing sources to target weights.

Sizes are summed per source. Sources, in order of their names, carry the given
weights in turn and share the total; no target exceeds ``most`` times its source,
and what a capped source leaves goes to the others by weight. A document of a source
with rate r = target / size is emitted floor(r) times and once more with probability
r - floor(r), decided by a seeded hash of the document alone, so that reruns agree.

One row per source goes through a window; documents are never grouped or moved: the
rates join them by source, broadcast where measured small and else as a shuffle join
that splits a hot source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"
_DRAWS = 1 << 52


def size_column(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_column(id_: Column, text: Column, seed: str = SEED) -> Column:
    """Number in [0, 1) fixed by seed, id and text; null and empty are alike."""
    blank = F.lit("")
    parts = F.concat(F.lit(seed + "|"), F.coalesce(id_.cast("string"), blank), F.lit("|"), F.coalesce(text, blank))
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, 13), 16, 10).cast("double") / _DRAWS


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to one row per source with ``source`` and ``source_size``.

    Filling by weight until no target is above its cap has a closed form: with the
    sources ordered by cap / weight, a source stays below its cap if its share of
    what the ones before it leave does. Null is the last source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = ranked.select(
        "*",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left_over"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left_weight"),
    ).withColumn("open", F.col("left_over") * F.col("weight") <= F.col("cap") * F.col("left_weight"))
    # The first open source sets the level for all open ones.
    at = F.struct((F.col("cap") / F.col("weight")).alias("ratio"), "rank", "left_over", "left_weight")
    level = filled.withColumn("level", F.min(F.when(F.col("open"), at)).over(every))
    share = F.col("weight") * F.col("level.left_over") / F.col("level.left_weight")
    target = F.when(F.col("open"), share).otherwise(F.col("cap").cast("double"))
    return level.select("source", "source_size", target.alias("target"))


def copies_column(rate: Column, draw: Column) -> Column:
    whole = F.floor(rate)
    return F.when(rate > 0, whole + (draw < rate - whole).cast("long")).otherwise(F.lit(0)).cast("long")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    A null text has size 0, a source without words gets target 0, and a null source
    is a source of its own, the last. Repeated rows draw alike. An empty table gives
    an empty result; other columns are not read.
    """
    id_, text, source = (F.col(c) for c in (id_col, text_col, source_col))
    rows = docs.select(id_.alias("id"), source.alias("source"), size_column(text).alias("size"), draw_column(id_, text, seed).alias("draw"))
    return rated(rows, weights, most).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def rated(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to rows with ``source``, ``size`` and ``draw``."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = targets(sizes, weights, most).withColumnRenamed("source", "of")
    joined = rows.join(rates, F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("copies", copies_column(F.try_divide("target", "source_size"), F.col("draw")))


def emit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, with all its columns as they came."""
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(
        doc.alias("doc"),
        F.col(source_col).alias("source"),
        size_column(F.col(text_col)).alias("size"),
        draw_column(F.col(id_col), F.col(text_col), seed).alias("draw"),
    )
    copies = rated(rows, weights, most).where("copies > 0")
    return copies.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")


ORACLE_SQL = r"""
with docs as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    cast('0x' || substr(md5('mix-1|' || coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')), 1, 13) as bigint)
        / 4503599627370496.0::double as draw from documents),
sizes as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as rank from docs group by source),
ranked as (select *, 1 + rank % 3 as weight, 3 * source_size as cap from sizes),
filled as (select *,
    cast(sum(source_size) over () - coalesce(sum(cap) over before, 0) as bigint) as left_over,
    cast(sum(weight) over () - coalesce(sum(weight) over before, 0) as bigint) as left_weight
    from ranked window before as (order by cap / weight, rank rows between unbounded preceding and 1 preceding)),
levels as (select *, left_over * weight <= cap * left_weight as open from filled),
level as (select left_over as lo, left_weight as lw from levels where open order by cap / weight, rank limit 1),
rates as (select source as src, source_size,
    case when open then (weight * (select lo from level)) / (select lw from level)::double else cap::double end as target from levels),
taken as (select doc_id, size, source_size, target, draw, case when source_size > 0 then target / source_size else 0 end as rate
    from docs join rates on source is not distinct from src)
select doc_id, size, source_size, target,
    cast(size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end) as bigint) as taken from taken
"""
