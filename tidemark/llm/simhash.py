"""SimHash near-duplicates: tiled exact comparison of fingerprints.

A fingerprint bit is the majority vote of the hashes of a text's shingles. Distinct
fingerprints are laid in tiles by the population counts of their ``chunks`` equal
parts. Fingerprints within the radius differ by at most the radius in the sum of
these counts, so most pairs of tiles are skipped unread. The others are compared
whole, by exclusive-or and bit count. A pair of tiles yields a spanning forest of
its links, never all pairs; the components are found from those.

Every task holds two tiles of at most about ``tile`` fingerprints: a count vector
shared by more is split by hash. Texts with equal fingerprints enter once, so the
size of a group of copies does not matter.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8
from tidemark.llm.components import components
from tidemark.session import materialize

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2
CHUNKS = 4
TILE = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text; a text without words has fingerprint zero."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, n = xxhash.xxh64_intdigest, len(words) - shingle + 1
    grams = zip(*(words[i:] for i in range(shingle)))
    ones = np.zeros(BITS, np.int64)
    while block := list(itertools.islice(grams, 1 << 16)):
        hashes = np.array([digest(b" ".join(g), SEED) for g in block], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        got = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(got.view(np.int64))

    return of(utf8(text))


def neighbours(chunks: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of count vectors of two fingerprints within the radius, one of each sign pair."""
    found = {(0,) * chunks}
    for _ in range(radius):
        found |= {d[:i] + (d[i] + s,) + d[i + 1 :] for d in found for i in range(chunks) for s in (-1, 1)}
    return sorted(d for d in found if d >= (0,) * chunks)


def count_code(value: Column, chunks: int) -> Column:
    """The counts of set bits of the parts as one number, a byte each."""
    width = BITS // chunks
    mask = (1 << width) - 1 if width < BITS else -1
    code = F.lit(0).cast("long")
    for i in range(chunks):
        part = F.shiftrightunsigned(value, i * width).bitwiseAND(F.lit(mask).cast("long"))
        code = F.shiftleft(code, 8).bitwiseOR(F.bit_count(part).cast("long"))
    return code


def code_step(diff: tuple[int, ...]) -> int:
    return sum(d << 8 * (len(diff) - 1 - i) for i, d in enumerate(diff))


def forest(left: np.ndarray, right: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links within the radius between two tiles, less those that only close a cycle."""
    base = 0 if same else len(left)
    label = np.arange(base + len(right))
    step = max(1, (1 << 20) // max(1, len(right)))
    out = []
    for at in range(0, len(left), step):
        block = left[at : at + step]
        near = np.bitwise_count(block[:, None] ^ right[None, :]) <= radius
        if same:
            near[np.arange(len(block)), at + np.arange(len(block))] = False
        for i in np.nonzero(near.any(1))[0]:
            partners = np.nonzero(near[i])[0]
            mine, theirs = label[at + i], label[base + partners]
            for other, j in zip(*np.unique(theirs, return_index=True)):
                if other != mine:
                    out.append((int(block[i]), int(right[partners[j]])))
                    label[label == other] = mine
    return out


def links(values: DataFrame, radius: int = RADIUS, chunks: int = CHUNKS, tile: int = TILE) -> DataFrame:
    """Columns ``a`` and ``b``: links that connect all fingerprints (column ``fp``) within the radius.

    ``values`` holds distinct fingerprints. The result spans every component; links
    between fingerprints that a tile pair connects otherwise are left out.
    """
    if BITS % chunks or radius >= 8:
        raise ValueError("chunks must divide 64 and the radius be below 8")
    coded = values.select("fp", count_code(F.col("fp"), chunks).alias("code"))
    parts = coded.groupBy("code").agg(F.ceil(F.count("*") / tile).alias("n"))
    tiles = materialize(
        coded.join(parts, "code")
        .groupBy("code", F.pmod(F.xxhash64("fp"), F.col("n")).alias("sub"))
        .agg(F.first("n").alias("n"), F.collect_list("fp").alias("fps")),
        "simhash-tiles",
    )
    sizes = tiles.select("code", "sub", "n")
    steps = F.array(*(F.lit(code_step(d)).cast("long") for d in neighbours(chunks, radius)))
    near = sizes.select(F.col("code").alias("code_a"), F.col("sub").alias("sub_a"), F.explode(steps).alias("d"))
    near = near.select("code_a", "sub_a", (F.col("code_a") + F.col("d")).alias("code_b"))
    pairs = near.join(sizes.select(F.col("code").alias("code_b"), F.col("sub").alias("sub_b")), "code_b").where(
        "code_a <> code_b or sub_a <= sub_b"
    )
    side = lambda x: tiles.select(*(F.col(c).alias(f"{c}_{x}") for c in ("code", "sub", "fps")))
    full = pairs.join(side("a"), ["code_a", "sub_a"]).join(side("b"), ["code_b", "sub_b"])
    full = full.select((F.expr("code_a = code_b and sub_a = sub_b")).alias("same"), "fps_a", "fps_b")

    def compare(frames):
        for pdf in frames:
            found = []
            for same, a, b in zip(pdf["same"], pdf["fps_a"], pdf["fps_b"]):
                found += forest(np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64), same, radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return full.mapInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, chunks: int = CHUNKS, tile: int = TILE
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``radius``
    bits, the document's own included; null ids count only where a component has no
    other. Empty and null texts share fingerprint zero. Repeated rows stay repeated;
    other columns are not read. An empty table gives an empty result.
    """
    keyed = docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp"))
    return grouped(keyed, radius, chunks, tile).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def grouped(keyed: DataFrame, radius: int, chunks: int, tile: int) -> DataFrame:
    """Adds ``component``, the least id of the component, to rows with ``id`` and ``fp``."""
    keyed = materialize(keyed, "simhash-docs")
    values = materialize(keyed.groupBy("fp").agg(F.min("id").alias("least")), "simhash-values")
    reps = components(links(values.select("fp"), radius, chunks, tile))
    named = values.join(reps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("rep", F.coalesce("rep", "fp"))
    least = named.groupBy("rep").agg(F.min("least").alias("component"))
    return keyed.join(named.select("fp", "rep").join(least, "rep").drop("rep"), "fp")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, chunks: int = CHUNKS, tile: int = TILE
) -> DataFrame:
    """The rows of ``docs`` less all but one of each component: that with the least id stays.

    Rows with a null id lose to others; of equal ids the first row stays. All columns
    are returned as they came, whatever their names.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_at, text_at = (names[docs.columns.index(c)] for c in (id_col, text_col))
    copy = docs.toDF(*names).withColumns({"row": F.monotonically_increasing_id(), "fp": fingerprint_column(F.col(text_at), shingle)})
    copy = materialize(copy, "simhash-rows")
    order = F.struct(F.col(id_at).isNull().alias("n"), F.col(id_at).alias("i"), F.col("row").alias("r"))
    found = grouped(copy.select(order.alias("id"), "fp"), radius, chunks, tile)
    kept = found.where("id = component").select(F.col("id.r").alias("row"))
    return copy.join(kept, "row", "left_semi").select(*names).toDF(*docs.columns)
