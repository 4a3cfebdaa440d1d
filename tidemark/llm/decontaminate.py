"""Benchmark decontamination by Wu-Manber search over words.

The symbols are words. For each window length there is a machine: the shift table
maps a block of up to two words to the distance that the search may skip, so most
positions are never looked at; a block that may end a window selects its suffix
bucket by the window's first block, and the window is compared word by word.

The benchmark is cut into blocks of about ``block_chars`` characters by hash, repeated
items once, long items in pieces that share no window. Only
one block at a time is collected and broadcast, so memory does not grow with the
benchmark; beyond the first, the findings so far are written to the shared folder.
Documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8
from tidemark.session import materialize

WINDOW = 10
BLOCK = 2
BLOCK_CHARS = 16_000_000

# Lower-cases A-Z, keeps digits, a-z and every byte of other scripts, blanks the rest.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Machine:
    """Wu-Manber tables for windows of one length; ``windows`` maps a window to its items."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], frozenset]):
        self.length, self.windows = length, windows
        self.block = min(BLOCK, length)
        self.furthest = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(lambda: defaultdict(list))
        for window in windows:
            for at in range(self.furthest):
                key, skip = window[at : at + self.block], self.furthest - 1 - at
                self.shift[key] = min(skip, self.shift.get(key, skip))
            self.buckets[window[-self.block :]][window[: self.block]].append(window)
        self.buckets = {k: dict(v) for k, v in self.buckets.items()}

    def search(self, words: list[bytes]):
        """Yields start and window of every occurrence, in order of start."""
        length, block, far, shift = self.length, self.block, self.furthest, self.shift
        end, n = length, len(words)
        while end <= n:
            last = tuple(words[end - block : end])
            skip = shift.get(last, far)
            if skip:
                end += skip
                continue
            start = end - length
            first = tuple(words[start : start + block])
            for window in self.buckets[last].get(first, ()):
                if tuple(words[start:end]) == window:
                    yield start, window
            end += 1


def machines(items: list[tuple[str, bytes]], window: int = WINDOW) -> list[Machine]:
    """Tables for the windows of ``items``, pairs of id and text."""
    found: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        words = words_of(text)
        length = min(window, len(words))
        for at in range(len(words) - length + 1 if length else 0):
            found[length][tuple(words[at : at + length])].add(name)
    return [Machine(k, {w: frozenset(v) for w, v in found[k].items()}) for k in sorted(found)]


def findings(words: list[bytes], tables: list[Machine]) -> tuple[list[tuple[int, int]], set[str]]:
    """Disjoint intervals of hit words in order, and the ids of the items found."""
    spans, items = [], set()
    for machine in tables:
        for start, window in machine.search(words):
            spans.append((start, start + machine.length))
            items |= machine.windows[window]
    return merged(spans), items


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def pieces(text: bytes, window: int, most: int) -> list[bytes]:
    """A text of more than ``most`` bytes cut so that each of its windows lies in one piece and no piece has others."""
    words = words_of(text) if len(text) > most else []
    if len(words) <= window:
        return [text]
    out, start, last = [], 0, len(words) - window + 1
    while start < last:
        size, stop = 0, start
        while stop < last and (stop == start or size + len(words[stop]) < most):
            size += len(words[stop]) + 1
            stop += 1
        out.append(b" ".join(words[start : stop + window - 1]))
        start = stop
    return out


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int, window: int = WINDOW):
    """Lists of (id, text), each of about ``block_chars`` characters; a null id is an empty text.

    Equal items count once, and a long one is dealt in pieces.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), utf8(F.col(text_col)).alias("body"))
    most = max(1, block_chars // 8)

    def cut(frames):
        for pdf in frames:
            found = [(item, piece) for item, body in zip(pdf["item"], pdf["body"]) for piece in pieces(bytes(body), window, most)]
            yield pd.DataFrame(found, columns=["item", "body"])

    items = materialize(items.distinct().mapInPandas(cut, "item string, body binary"), "benchmark")
    chars = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    part = F.pmod(F.xxhash64("item", "body"), F.lit(max(1, blocks)))
    for block in range(blocks):
        yield [(r["item"], bytes(r["body"])) for r in items.where(part == block).collect()]


_SCAN = "n_words long, starts array<long>, ends array<long>, items array<string>"


def scan_column(text: Column, tables) -> Column:
    """Number of words, disjoint hit intervals and items; ``tables`` is a broadcast."""

    @F.pandas_udf(_SCAN)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = words_of(text)
            spans, items = findings(words, tables.value)
            rows.append((len(words), [s for s, _ in spans], [e for _, e in spans], sorted(items)))
        return pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    return scan(utf8(text))


def scanned(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, window: int, block_chars: int) -> DataFrame:
    """``docs`` as struct ``doc`` with ``scan``, the findings over all blocks."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    found = None
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_chars, window)
    for items in blocks:
        tables = spark.sparkContext.broadcast(machines(items, window))
        now = scan_column(F.col("doc").getField(text_col), tables)
        if found is None:
            found = rows.select("doc", now.alias("scan"))
        else:
            found = materialize(found, "decontaminate").select("doc", "scan", now.alias("more"))
            found = found.select("doc", union_column(F.col("scan"), F.col("more")).alias("scan"))
    if found is None:
        found = rows.select("doc", scan_column(F.col("doc").getField(text_col), spark.sparkContext.broadcast([])).alias("scan"))
    return found


def union_column(one: Column, two: Column) -> Column:
    @F.pandas_udf(_SCAN)
    def union(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        both = [merged([*zip(s, e), *zip(t, f)]) for s, e, t, f in zip(a["starts"], a["ends"], b["starts"], b["ends"])]
        items = [sorted({*x, *y}) for x, y in zip(a["items"], b["items"])]
        sides = {name: [[s[i] for s in spans] for spans in both] for i, name in enumerate(("starts", "ends"))}
        return pd.DataFrame({"n_words": a["n_words"], **sides, "items": items})

    return union(one, two)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``items``, ``hits``.

    A null or empty text has no words and no hits. An item without words has no
    window; a null item id stands as an empty text; items with equal ids count once.
    Repeated documents are judged one by one. An empty benchmark hits nothing, an
    empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    found = scanned(docs.select(id_col, text_col), benchmark, text_col, item_col, item_text_col, window, block_chars)
    hits = F.zip_with("scan.starts", "scan.ends", lambda s, e: F.struct(s.alias("start"), e.alias("end")))
    out = found.select(F.col("doc").getField(id_col).alias(id_col), F.col("scan.n_words").alias("n_words"), hits.alias("hits"), F.col("scan.items").alias("items"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return out.select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "items",
        "hits",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The documents without any benchmark window, all columns as they came."""
    found = scanned(docs, benchmark, text_col, item_col, item_text_col, window, block_chars)
    return found.where(F.size("scan.items") == 0).select("doc.*")


# DuckDB: every window of every item against every window of the same length.
ORACLE_SQL = r"""
with docs as (select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (select distinct item, k, array_to_string(w[i + 1 : i + k], ' ') as win
    from (select item, w, least(10, len(w)) as k, unnest(range(len(w) - least(10, len(w)) + 1)) as i from items where len(w) > 0)),
lengths as (select distinct k from windows),
spots as (select r, k, i, array_to_string(w[i + 1 : i + k], ' ') as win
    from (select r, w, k, unnest(range(len(w) - k + 1)) as i from docs, lengths where len(w) >= k)),
found as (select r, k, i, item from spots join windows using (k, win)),
hit as (select r, count(distinct p) as n from (select r, unnest(range(i, i + k)) as p from found) group by r),
named as (select r, list(distinct item) as items from found group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_hit,
    cast(coalesce(len(items), 0) as bigint) as n_items,
    sha256(coalesce(array_to_string(list_sort(items), ','), '')) as items_sha256, coalesce(n, 0) > 0 as contaminated
from docs left join hit using (r) left join named using (r)
"""
