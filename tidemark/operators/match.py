"""Matching of source entities with a master."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import normalize_name
from tidemark.operators.dedup import dedup_first

# Confidence by match method.
CONFIDENCE = {"EXACT_ID": 1.0, "NORMALIZED_NAME": 0.75, "UNMATCHED": 0.0}


def entities(rows: DataFrame, legs: Sequence[Mapping[str, str]], context: Sequence[str]) -> DataFrame:
    """Distinct (context, entity_id, entity_name): every spelling of the name an id occurs with.

    Each leg names the id and the name column.
    """
    made = [F.struct(F.col(g["id"]).alias("entity_id"), F.col(g["name"]).alias("entity_name")) for g in legs]
    flat = rows.select(*context, F.explode(F.array(*made)).alias("e")).select(*context, "e.*")
    return flat.filter("entity_id is not null").distinct()


def best_spelling(matches: DataFrame, context: Sequence[str]) -> DataFrame:
    """One row per (context, entity_id): the spelling with the best method, ties by name, NULL names last."""
    rank = F.array_position(F.array(*map(F.lit, CONFIDENCE)), F.col("match_method"))
    return dedup_first(matches, [*context, "entity_id"], [rank, F.col("entity_name").asc_nulls_last()])


def match_entities(
    found: DataFrame, master: DataFrame, block: str, master_ids: Sequence[str], master_key: str, master_name: str
) -> DataFrame:
    """Exact id within the block beats equal normalised name; else unmatched.

    The best master per id and per name is chosen before the joins. Both joins are then
    many-to-one: a name that thousands of masters share never multiplies rows.
    """
    # NULL keys and names lose against real ones.
    order = [F.col(master_key).isNull(), F.col(master_key), F.col(master_name).isNull(), F.col(master_name)]
    picked = F.min_by(F.struct(master_key, master_name), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("m")
    ids = master.select(block, F.explode(F.array(*master_ids)).alias("entity_id"), master_key, master_name)
    by_id = ids.filter("entity_id is not null").groupBy(block, "entity_id").agg(picked)
    names = master.withColumn("__name", normalize_name(master_name)).filter("__name is not null")
    by_name = names.groupBy(block, "__name").agg(picked)
    e = found.withColumn("__name", normalize_name("entity_name"))
    joined = e.join(by_id.withColumnRenamed("m", "__id_hit"), [block, "entity_id"], "left").join(
        by_name.withColumnRenamed("m", "__name_hit"), [block, "__name"], "left"
    )
    method = (
        F.when(F.col("__id_hit").isNotNull(), "EXACT_ID")
        .when(F.col("__name_hit").isNotNull(), "NORMALIZED_NAME")
        .otherwise("UNMATCHED")
    )
    hit = F.coalesce("__id_hit", "__name_hit")
    return joined.select(
        *found.columns,
        hit[master_key].alias("candidate_master_key"),
        hit[master_name].alias("candidate_master_name"),
        method.alias("match_method"),
    )


def score_match(matches: DataFrame) -> DataFrame:
    value = None
    for method, score in CONFIDENCE.items():
        cond = F.col("match_method") == method
        lit = F.lit(score).cast("decimal(5,4)")
        value = F.when(cond, lit) if value is None else value.when(cond, lit)
    return matches.withColumns({"confidence": value, "requires_review": F.col("match_method") != "EXACT_ID"})


def _drop_one(text: Column) -> Column:
    """The text itself and every text with one character removed."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
        lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))),
    )
    return F.array_union(F.array(text), cuts)


def deletion_variants(text: Column, distance: int) -> Column:
    """All texts reachable by removing up to ``distance`` characters."""
    out = F.array(text)
    for _ in range(distance):
        out = F.array_distinct(F.flatten(F.transform(out, _drop_one)))
    return out


# Longer names are matched by segments: their deletion variants would be too many.
LONG_NAME = 64


def _segment(length: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i`` of a text cut into ``parts`` even segments, the longer ones last."""
    base, first_longer = F.floor(length / parts).cast("int"), parts - length % parts
    return base * i + F.greatest(i - first_longer, F.lit(0)), base + (i >= first_longer).cast("int")


def _named(length: Column, i: Column, piece: Column) -> Column:
    # The colons keep it apart from normalised names, which have none.
    return F.concat(length.cast("string"), F.lit(":"), i.cast("string"), F.lit(":"), piece)


def own_segments(text: Column, distance: int) -> Column:
    """The ``distance`` + 1 segments of a text, each with its number and the length of the text."""

    def one(i: Column) -> Column:
        start, size = _segment(F.length(text), i, distance + 1)
        return _named(F.length(text), i, F.substring(text, start + 1, size))

    return F.transform(F.sequence(F.lit(0), F.lit(distance)), one)


def met_segments(text: Column, distance: int) -> Column:
    """Pieces of a text that are a segment of every text within the distance: of one of its lengths, near its place.

    Of the segments of another text at least one stays whole under ``distance`` edits. The
    i-th can have moved by at most i places if all edits before it count against it, and by
    what is left for those after it. The number of pieces does not depend on the length.
    """
    places = [
        (longer, i, shift)  # how much longer this text is than the other, the segment, how far it moved
        for longer in range(-distance, distance + 1)
        for i in range(distance + 1)
        for shift in range(max(-i, longer - (distance - i)), min(i, longer + (distance - i)) + 1)
    ]

    def one(p: Column) -> Column:
        length = F.length(text) - p["longer"]
        start, size = _segment(length, p["i"], distance + 1)
        at = start + p["shift"]
        fits = (length >= 0) & (at >= 0) & (at + size <= F.length(text))
        return F.when(fits, _named(length, p["i"], F.substring(text, at + 1, size)))

    known = F.expr("array(" + ", ".join(f"named_struct('longer', {a}, 'i', {b}, 'shift', {c})" for a, b, c in places) + ")")
    return F.array_distinct(F.array_compact(F.transform(known, one)))


def fuzzy_match(
    left: DataFrame,
    right: DataFrame,
    block: str,
    left_name: str,
    right_name: str,
    max_distance: int = 1,
    long_name: int = LONG_NAME,
) -> DataFrame:
    """Distinct normalised names of a block within an edit distance, exactly.

    Two names at distance d share a text after removing at most d characters from each, and
    one of the d + 1 segments of the one lies unchanged in the other. Names up to
    ``long_name`` characters are joined on the first, longer ones on the second, so that a
    name has few signatures whatever its length; those on the border have both. No pair of a
    block is formed unless it shares a signature, and repeated names are reduced first.

    Signatures and names are joined as hashes, and each pair found is checked once, on the
    names themselves: equal hashes of different texts cost a comparison and change nothing.
    """
    # A name has up to some thousand signatures: their join must not be planned by the size of the names.
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def known(df: DataFrame, name: str, out: str) -> DataFrame:
        names = df.select(block, normalize_name(name).alias(out)).filter(F.col(out).isNotNull()).distinct()
        return names.withColumn(f"__{out}", F.xxhash64(out))

    def signed(names: DataFrame, out: str, segments) -> DataFrame:
        size, text = F.length(out), F.col(out)
        none = F.array().cast("array<string>")
        short = F.when(size <= long_name + max_distance, deletion_variants(text, max_distance)).otherwise(none)
        long_ = F.when(size > long_name, segments(text, max_distance)).otherwise(none)
        dealt = names.repartition(parts, block, f"__{out}").withColumn("__v", F.explode(F.concat(short, long_)))
        return dealt.select(block, f"__{out}", F.xxhash64("__v").alias("__v"))

    one, other = known(left, left_name, "left_name"), known(right, right_name, "right_name")
    met = signed(one, "left_name", own_segments).hint("merge").join(signed(other, "right_name", met_segments), [block, "__v"])
    pairs = met.select(block, "__left_name", "__right_name").distinct()
    distance = F.levenshtein("left_name", "right_name", max_distance)  # -1 beyond
    return (
        pairs.join(one, [block, "__left_name"])
        .join(other, [block, "__right_name"])
        .withColumn("distance", distance)
        .filter("distance >= 0")
        .select(block, "left_name", "right_name", "distance")
    )
