"""Substring dedup: words inside repeated windows, found by a count-min prefilter.

Three passes over one copy of the texts, laid out in blocks of documents:

1. Each block sketches its windows: ``DEPTH`` rows of counters, of which it ships the
   cells that it uses. The sketches are merged by adding counters, in shards of the hash
   range, and each block learns which of its cells reach two. The least of a window's
   counters never falls below its true count, so a window that repeats is never lost.
2. Only windows estimated repeated are looked at again. A block sends the first
   occurrence of each, with a 128-bit hash of its words; the occurrences of a hash are
   grouped exactly, and the block learns which of its firsts come late.
3. The block removes the words under every late window and every later occurrence of a
   window inside itself.

A block is what one task wrote, so the texts are never shuffled: the copy is bucketed by
block, and only cells, hashes and bits travel. A window that fills the corpus enters each
shuffle once per block.
"""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8
from tidemark.session import materialize, scratch_path

WINDOW = 20
DEPTH = 2
# Text of a block and windows of a shard: what a task holds. Larger ones make fewer, longer
# messages: about 256 MB and 64 million windows suit 100 TB and 4 GB a core.
BLOCK_BYTES = 8 << 20
SHARD_WINDOWS = 1 << 22
# Counters per window and row; about one window in seventy is then estimated repeated by chance.
SPARE = 8
_MOST_BUCKETS = 50_000  # below Spark's own limit; more blocks share buckets

_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


def _joined(a: np.ndarray, b: np.ndarray, gap: int, odd: int) -> np.ndarray:
    """Hash of each value of ``a`` followed by the value of ``b`` that begins ``gap`` words on."""
    m = max(0, min(len(a), len(b) - gap))
    return _mix(a[:m] * _U(odd) + b[gap : gap + m])


def window_hashes(words: np.ndarray, size: int, odd: int) -> np.ndarray:
    """Hashes of all ``size`` consecutive word hashes, built by doubling."""
    power, length, out, done = words, 1, None, 0
    while True:
        if size & length:
            out = power if out is None else _joined(out, power, done, odd)
            done += length
        if 2 * length > size:
            return out
        power = _joined(power, power, length, odd)
        length *= 2


class _Codes(dict):
    def __missing__(self, word):
        code = self[word] = len(self)
        return code


@dataclass(frozen=True)
class Shape:
    """Sizes all tasks agree on: hash bits that name a shard, and a cell inside it."""

    window: int
    shard_bits: int
    cell_bits: int

    def shard_of(self, h: np.ndarray) -> np.ndarray:
        return (h >> _U(64 - self.shard_bits)).astype(np.int64) if self.shard_bits else np.zeros(len(h), np.int64)


class Block:
    """Windows of the documents of one block, in the order of (document, start).

    A document is known by its id and the hash of its text; a null id comes last. Rows that
    agree in both are one document here.
    """

    def __init__(self, rows: pd.DataFrame, shape: Shape):
        null = rows["id"].isna().to_numpy()
        ident = rows["id"].where(~null, 0).to_numpy(dtype=np.int64)
        tie = rows["tie"].to_numpy(dtype=np.int64)
        order = np.lexsort((tie, ident, null))
        new = np.ones(len(order), bool)
        for part in (null, ident, tie):
            new[1:] &= part[order][1:] == part[order][:-1]
        new[1:] = ~new[1:]
        kept = order[new]
        self.document = np.empty(len(order), np.int64)  # of each row
        self.document[order] = np.cumsum(new) - 1
        self.null, self.ident, self.tie = null[kept].astype(np.int64), ident[kept], tie[kept]
        self.texts = rows["text"].to_numpy(dtype=object)[kept]
        codes, parts = _Codes(), []
        for text in self.texts:
            words = text.split()
            parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
        self.lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, codes)), "<u8").reshape(-1, 2)
        every = np.concatenate([*parts, np.zeros(0, np.int32)])
        per = np.maximum(self.lengths - shape.window + 1, 0)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.doc = np.repeat(np.arange(len(per)), per)
        self.start = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        self.pos = self.begins[self.doc] + self.start
        if len(self.pos):
            self.hi = window_hashes(digest[every, 0], shape.window, 0x9E3779B97F4A7C15)[self.pos]
            self.lo = window_hashes(digest[every, 1], shape.window, 0xA24BAED4963EE407)[self.pos]
        else:
            self.hi = self.lo = np.zeros(0, _U)
        self.shape = shape

    def cells(self, row: int) -> np.ndarray:
        """Cell of each window in one row of the sketch; the leading bits name the shard."""
        g = _mix(self.hi * _U(2 * row + 3) + self.lo)
        return g >> _U(64 - self.shape.shard_bits - self.shape.cell_bits)

    def edges(self, keys: np.ndarray) -> np.ndarray:
        """Where the shards begin in sorted keys, and the end."""
        shards = np.arange((1 << self.shape.shard_bits) + 1, dtype=np.uint64)
        return np.searchsorted(keys, shards << _U(self.shape.cell_bits))

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        """Windows whose least counter reaches two."""
        out = np.ones(len(self.hi), bool)
        for row in range(DEPTH):
            keys, where = np.unique(self.cells(row), return_inverse=True)
            out &= _answers(answers, row << self.shape.shard_bits, self.edges(keys))[where]
        return np.nonzero(out)[0]

    def firsts(self, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First occurrence in the block of each candidate window, and which of those each candidate repeats."""
        order = np.lexsort((self.lo[candidates], self.hi[candidates]))
        ranked = candidates[order]
        new = np.ones(len(ranked), bool)
        new[1:] = (self.hi[ranked][1:] != self.hi[ranked][:-1]) | (self.lo[ranked][1:] != self.lo[ranked][:-1])
        first = ranked[new]  # lexsort is stable, so the least position of each group
        place = np.argsort(np.argsort(first))
        group = np.empty(len(candidates), np.int64)
        group[order] = place[np.cumsum(new) - 1]
        return np.sort(first), group


def _answers(answers: dict[int, bytes], base: int, edges: np.ndarray) -> np.ndarray:
    """Bits of consecutive shards put together."""
    parts = [np.zeros(0, np.uint8)]
    for shard, n in enumerate(np.diff(edges)):
        if n:
            parts.append(np.unpackbits(np.frombuffer(answers[base + shard], np.uint8), count=int(n)))
    return np.concatenate(parts).astype(bool)


def _deflate(numbers: np.ndarray) -> bytes:
    """Whole numbers as differences, compressed."""
    return zlib.compress(np.diff(numbers.astype(np.int64), prepend=np.int64(0)).tobytes(), 1)


def _inflate(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.int64))


def _packed(*parts: bytes) -> bytes:
    return struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts)


def _unpacked(data: bytes, count: int) -> list[bytes]:
    at, out = 8 * count, []
    for n in struct.unpack_from(f"<{count}q", data):
        out.append(data[at : at + n])
        at += n
    return out


def pack_cells(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted distinct cells; their gaps byte by byte, the lowest bytes hardly compressible."""
    planes = np.diff(cells.astype(np.uint32), prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _packed(planes[0].tobytes(), zlib.compress(planes[1:].tobytes(), 1), zlib.compress(np.packbits(twice).tobytes(), 1))


def unpack_cells(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    low, high, bits = _unpacked(data, 3)
    planes = np.frombuffer(low + zlib.decompress(high), np.uint8).reshape(4, -1)
    cells = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)
    return cells, np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=len(cells))


MESSAGE = "block long, shard long, data binary"


def _messages(block: int, found: Iterator[tuple[int, bytes]]) -> pd.DataFrame:
    rows = [(block, shard, data) for shard, data in found]
    return pd.DataFrame(rows, columns=["block", "shard", "data"])


def sketch(shape: Shape) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The used cells of a block's sketch, by shard."""

    def cells(block: Block) -> Iterator[tuple[int, bytes]]:
        for row in range(DEPTH):
            keys = np.sort(block.cells(row))
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            twice = np.zeros(len(keys), bool)
            twice[:-1] = ~new[1:]
            keys, twice = keys[new], twice[new]
            for shard, (a, b) in enumerate(itertools.pairwise(block.edges(keys).tolist())):
                if b > a:
                    inside = keys[a:b] & _U((1 << shape.cell_bits) - 1)
                    yield (row << shape.shard_bits) + shard, pack_cells(inside, twice[a:b])

    return lambda rows: _messages(int(rows["block"].iloc[0]), cells(Block(rows, shape)))


def merge(shape: Shape) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Adds the sketches of all blocks in one shard; a bit per cell of a block: the counter reaches two."""

    def of(messages: pd.DataFrame) -> pd.DataFrame:
        counters = np.zeros(1 << shape.cell_bits, np.uint8)  # two stands for two or more
        for data in messages["data"]:
            cells, twice = unpack_cells(data)
            counters[cells] = np.minimum(counters[cells] + 1 + twice, 2)
        bits = [np.packbits(counters[unpack_cells(data)[0]] >= 2).tobytes() for data in messages["data"]]
        return messages.assign(data=bits)

    return of


def _split(messages: pd.DataFrame) -> dict[int, bytes]:
    return dict(zip(messages["shard"].tolist(), messages["data"].tolist()))


def first_occurrences(shape: Shape):
    """A block's first occurrence of each window estimated repeated, by shard."""

    def found(block: Block, answers: dict[int, bytes]) -> Iterator[tuple[int, bytes]]:
        first, _ = block.firsts(block.repeated(answers))
        shards = shape.shard_of(block.hi[first])
        for shard in np.unique(shards).tolist():
            one = first[shards == shard]
            doc = block.doc[one]
            numbers = (block.null[doc], block.ident[doc], block.tie[doc], block.start[one])
            yield shard, _packed(block.hi[one].tobytes(), block.lo[one].tobytes(), *map(_deflate, numbers))

    def of(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return _messages(0, iter(()))
        return _messages(int(rows["block"].iloc[0]), found(Block(rows, shape), _split(answers)))

    return of


def group(messages: pd.DataFrame) -> pd.DataFrame:
    """Groups equal windows of one shard; a bit per occurrence: another one comes first."""
    parts = []
    for data in messages["data"]:
        hi, lo, *numbers = _unpacked(data, 6)
        parts.append([np.frombuffer(hi, _U), np.frombuffer(lo, _U), *map(_inflate, numbers)])
    sizes = [len(p[0]) for p in parts]
    hi, lo, *place = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((*place[::-1], lo, hi))
    new = np.ones(len(order), bool)
    new[1:] = (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1])
    leader = order[new][np.cumsum(new) - 1]
    late = np.zeros(len(order), bool)
    for numbers in place:  # the same document may lie in two blocks
        late[order] |= numbers[order] != numbers[leader]
    ends = np.cumsum(sizes)
    bits = [np.packbits(late[e - n : e]).tobytes() for e, n in zip(ends.tolist(), sizes)]
    return messages.assign(data=bits)


KEPT = "id long, n_words long, n_removed long, kept binary"
_LATE = -1  # late answers lie beside the sketch's, under shards below zero


def removal(shape: Shape):
    """Rows of a block without the words under late windows."""

    def of(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"id": [], "n_words": [], "n_removed": [], "kept": []})
        block, answers = Block(rows, shape), _split(answers)
        candidates = block.repeated(answers)
        first, which = block.firsts(candidates)
        late = np.zeros(len(first), bool)
        shards = shape.shard_of(block.hi[first])
        for shard in np.unique(shards).tolist():
            here = np.nonzero(shards == shard)[0]
            late[here] = np.unpackbits(np.frombuffer(answers[_LATE - shard], np.uint8), count=len(here))
        again = late[which] | (first[which] != candidates) if len(candidates) else np.zeros(0, bool)
        spots = block.pos[candidates[again]]
        edges = np.zeros(int(block.lengths.sum()) + 1, np.int64)
        edges[spots] += 1
        edges[spots + shape.window] -= 1
        covered = np.cumsum(edges)[:-1] > 0
        removed = np.add.reduceat(np.append(covered, False), np.minimum(block.begins, len(covered)), dtype=np.int64) if len(block.begins) else np.zeros(0, np.int64)
        removed[block.lengths == 0] = 0
        kept = []
        for text, begin, n, gone in zip(block.texts, block.begins.tolist(), block.lengths.tolist(), removed.tolist()):
            if gone == n:
                kept.append(b"")
            else:
                words = text.split()
                kept.append(b" ".join(itertools.compress(words, (~covered[begin : begin + n]).tolist()) if gone else words))
        doc = block.document
        return pd.DataFrame(
            {"id": rows["id"], "n_words": block.lengths[doc], "n_removed": removed[doc], "kept": np.array([*kept, None], object)[:-1][doc]}
        )

    return of


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``block``, and read with that layout."""
    spark = df.sparkSession
    name = f"tidemark_blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"drop table {name}")  # the files stay; what was read keeps the layout
    return out


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    shard_windows: int = SHARD_WINDOWS,
) -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed`` and ``kept``, one row per row of ``docs``.

    A word (a run of anything but ASCII white space, taken unchanged) is removed if some
    window of ``window`` words over it also starts earlier: in a document with a smaller id,
    or earlier in its own. All windows of the input are judged, removed or not; ``kept`` has
    the other words joined by one space.

    A null text has no words; texts shorter than a window keep all. A null id comes after
    all ids. Rows of one id with different texts are told apart, and ordered, by a hash of
    the text; rows equal in id and text are one document and get the same result, so a
    repeated row takes nothing from itself. Ids must be whole numbers. Other columns are
    not read. An empty table gives an empty result. A text is held whole by one task.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(F.col(text_col)).alias("text"))
    sizes = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(F.octet_length("text")).alias("n"))
    most, total, parts = sizes.agg(F.max("n"), F.sum("n"), F.count(F.lit(1))).first()
    most, total = most or 0, total or 0
    per_task = max(1, -(-most // block_bytes))
    # A word and its blank take five bytes or more in all but odd texts; an error only shifts sizes.
    shards = max(1, -(-(total // 5) // shard_windows))
    shape = Shape(window, (shards - 1).bit_length(), max(4, (SPARE * shard_windows - 1).bit_length()))

    rows = rows.withColumn("tie", F.xxhash64("text"))
    inner = F.pmod(F.xxhash64("id", "tie"), F.lit(per_task))
    rows = rows.withColumn("block", F.spark_partition_id().cast("long") * per_task + inner)
    table = _bucketed(rows, min(_MOST_BUCKETS, max(1, parts * per_task)))
    blocks = table.groupBy("block")

    cells = blocks.applyInPandas(sketch(shape), MESSAGE)
    hot = materialize(cells.groupBy("shard").applyInPandas(merge(shape), MESSAGE), "repeated-cells")
    firsts = blocks.cogroup(hot.groupBy("block")).applyInPandas(first_occurrences(shape), MESSAGE)
    late = materialize(firsts.groupBy("shard").applyInPandas(group, MESSAGE), "late-windows")
    answers = hot.unionByName(late.withColumn("shard", F.lit(_LATE) - F.col("shard")))
    kept = blocks.cogroup(answers.groupBy("block")).applyInPandas(removal(shape), KEPT)
    return kept.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))


# DuckDB: the least place of every window, by windows as lists of words.
ORACLE_SQL = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
spots as (select doc_id, i, array_to_string(w[i + 1 : i + 20], ' ') as win
    from (select doc_id, w, unnest(range(len(w) - 19)) as i from docs where len(w) >= 20)),
late as (select doc_id, i from (select doc_id, i, row_number() over (partition by win order by doc_id, i) as n from spots) where n > 1),
gone as (select doc_id, list(distinct p) as ps from (select doc_id, unnest(range(i, i + 20)) as p from late) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(ps), 0) as bigint) as n_removed, kept_sha256
from (select doc_id, w, ps, sha256(array_to_string([x for x, k in w if ps is null or not list_contains(ps, k - 1)], ' ')) as kept_sha256
    from docs left join gone using (doc_id))
"""
