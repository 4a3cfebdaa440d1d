"""Periodic runs of words, by Lyndon roots.

Every maximal repetition (run) has a Lyndon root that is the longest Lyndon word at its
place under the order of the words or under the reverse order. The first phase of Baier's
suffix sorter sorts suffixes into groups of equal longest Lyndon prefix; the length of a
group's prefix is the Lyndon array, so the phase is run once for each order and nothing
more is sorted. Each root is then extended to both sides by longest common extensions,
answered from ranks of blocks of 1, 2, 4, ... words, and gives the run.

A wanted run is long: it matches itself one period on over ``least - period`` words or
more, so all of it lies under windows that occur twice in the text. Words outside such
windows are left out before the grouping; no run is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, utf8

LEAST = 24
EXPONENT = 3
# Words that are grouped at once, unless one stretch is longer.
_TOGETHER = 200_000


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place, by the first phase of Baier's suffix sorter.

    Symbols are whole numbers from 0; 0 separates texts, is smaller than all others, and must
    come first and last. Words do not reach over it.

    Suffixes start in one group per first symbol. Groups are taken from the greatest down.
    For each member the nearest place to the left that lies in a lower group follows; those
    found are moved up: out of their group into a new one just above it, the more members
    point to a place, the higher. The new group's prefix is the old one followed by so many
    copies of the taken group's, so its length needs no comparison of words.
    """
    n = len(symbols)
    top = max(symbols) if n else 0
    group = symbols[:]
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    length = [1] * (top + 1)
    below = list(range(-1, top))
    above = list(range(1, top + 2))
    left = list(range(n))  # nearest place at or to the left that is not taken yet
    out = [1] * n
    g = top
    while g > 0:
        taken = [i for i in members[g] if group[i] == g]
        members[g] = ()
        size = length[g]
        for i in taken:
            left[i] = i - 1
            out[i] = size
        pointed: dict[int, int] = {}
        for i in taken:
            j = i
            while (k := left[j]) != j:
                if (m := left[k]) != k:
                    left[j] = m
                j = k
            pointed[j] = pointed.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in pointed.items():
            old = group[j]
            if old:
                moved.setdefault((times, old), []).append(j)
        for times, old in sorted(moved, reverse=True):
            new = len(members)
            places = moved[times, old]
            members.append(places)
            length.append(length[old] + times * size)
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            if up < len(below):
                below[up] = new
            for j in places:
                group[j] = new
        g = below[g]
    return out


class _Blocks:
    """Ranks of the blocks of 1, 2, 4, ... symbols, for exact longest common extensions."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.ranks = [symbols]
        while 2 << (len(self.ranks) - 1) <= longest:
            half = 1 << (len(self.ranks) - 1)
            low, high = self.ranks[-1][:-half], self.ranks[-1][half:]
            pair = low.astype(np.int64) * (int(high.max(initial=0)) + 1) + high
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common symbols from ``a`` and from ``b`` on, ``a`` being smaller."""
        out = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            ranks, last = self.ranks[k], len(self.ranks[k]) - 1
            for _ in range(2 if k == len(self.ranks) - 1 else 1):
                fits = b + out <= last
                same = fits & (ranks[np.where(fits, a + out, 0)] == ranks[np.where(fits, b + out, 0)])
                out[same] += 1 << k
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common symbols that end just before ``a`` and just before ``b``, ``a`` being smaller."""
        out = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            ranks = self.ranks[k]
            for _ in range(2 if k == len(self.ranks) - 1 else 1):
                at = a - out - (1 << k)
                fits = at >= 0
                same = fits & (ranks[np.where(fits, at, 0)] == ranks[np.where(fits, b - out - (1 << k), 0)])
                out[same] += 1 << k
        return out


def runs(symbols: np.ndarray, longest: int, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs, sorted; ``symbols`` as for ``lyndon_lengths``.

    A run is as long as ``least`` and as ``exponent`` (two or more) times its period.
    ``longest``: no stretch between zeros is longer.
    """
    blocks = _Blocks(symbols.astype(np.int32), longest)
    separated = np.where(symbols == 0, 0, int(symbols.max(initial=0)) + 1 - symbols)
    found = []
    for order in (symbols, separated):
        period = np.array(lyndon_lengths(order.tolist()), np.int64)
        start = np.nonzero(symbols)[0]
        period = period[start]
        keep = start + period < len(symbols)
        start, period = start[keep], period[keep]
        after = blocks.forward(start, start + period)
        before = blocks.backward(start, start + period)
        length = before + period + after
        keep = (length >= least) & (length >= exponent * period)
        found.append(np.stack([start - before, length, period], 1)[keep])
    every = np.unique(np.concatenate(found), axis=0)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


_U = np.uint64


def _repeated(codes: np.ndarray, doc: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Words under windows of ``size`` words whose hash occurs twice in their text.

    A collision can only mark too many words.
    """
    h = (codes.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
    length, out, done = 1, None, 0

    def joined(a, b, gap):
        m = max(0, min(len(a), len(b) - gap))
        x = a[:m] * _U(0xD6E8FEB86659FD93) + b[gap : gap + m]
        return (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)

    while True:
        if size & length:
            out = h if out is None else joined(out, h, done)
            done += length
        if 2 * length > size:
            break
        h = joined(h, h, length)
        length *= 2
    spots = np.nonzero(np.arange(len(out)) + size <= ends[: len(out)])[0]
    key = out[spots] ^ (doc[spots].astype(_U) * _U(0xA24BAED4963EE407))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(spots), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(codes) + 1, np.int64)
    edges[spots[twice]] += 1
    edges[spots[twice] + size] -= 1
    return np.cumsum(edges)[:-1] > 0


def window_of(least: int, exponent: int) -> int:
    """Words over which a wanted run surely matches itself one period on."""
    shift = max(1, least // exponent)  # the greatest period that the least length allows
    return min(least - shift, (exponent - 1) * (shift + 1))


def text_runs(texts: list[bytes], least: int = LEAST, exponent: int = EXPONENT) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and runs (start, length, period) of each text; words are runs of non-blank bytes."""
    ids: dict[bytes, int] = {}
    words = [t.split() for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    parts = [np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int64, len(w)) for w in words]
    codes = np.concatenate([*parts, np.zeros(0, np.int64)])
    doc = np.repeat(np.arange(len(words)), lengths)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    found = [np.zeros((0, 3), np.int64)]
    size = window_of(least, exponent)
    if len(codes) >= size:
        active = _repeated(codes, doc, np.repeat(ends, lengths), size)
        spots = np.nonzero(active)[0]
        cut = np.ones(len(spots), bool)
        cut[1:] = (np.diff(spots) > 1) | (np.diff(doc[spots]) > 0)
        edge = np.append(np.nonzero(cut)[0], len(spots))
        at = 0
        while at < len(edge) - 1:
            stop = max(at + 1, int(np.searchsorted(edge, edge[at] + _TOGETHER, "right")) - 1)
            inside = spots[edge[at] : edge[stop]]
            sizes = np.diff(edge[at : stop + 1])
            # Stretches with a zero before each and one at the end.
            place = np.arange(len(inside)) + np.repeat(np.arange(len(sizes)), sizes) + 1
            symbols = np.zeros(len(inside) + len(sizes) + 1, np.int64)
            symbols[place] = np.unique(codes[inside], return_inverse=True)[1] + 1
            got = runs(symbols, int(sizes.max()), least, exponent)
            back = np.zeros(len(symbols), np.int64)
            back[place] = inside
            got[:, 0] = back[got[:, 0]]
            found.append(got)
            at = stop
    every = np.concatenate(found)
    owner = doc[every[:, 0]] if len(every) else np.zeros(0, np.int64)
    bounds = np.searchsorted(owner, np.arange(len(words) + 1))
    for i, w in enumerate(words):
        mine = every[bounds[i] : bounds[i + 1]].copy()
        mine[:, 0] -= begins[i]
        yield w, mine


RESULT = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: binary>"


def _collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """Words without those that a run holds after its first period."""
    if not len(found):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    return b" ".join(compress(words, (np.cumsum(edges)[:-1] == 0).tolist()))


def find_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, exponent: int = EXPONENT, name: str = "found") -> DataFrame:
    """``docs`` with the column ``name``: ``n_words``, ``runs`` and ``collapsed``.

    A word is a run of anything but ASCII white space. ``runs`` lists, by start and period,
    every run (start, length, period in words, counted from 0) of ``least`` words and
    ``exponent`` periods or more: consecutive words with smallest period ``period`` that no
    neighbour prolongs. ``collapsed`` is the text without the words that a run holds after
    its first period, joined by one space.

    A null text is an empty one: no word, no run, an empty ``collapsed``. Repeated rows and
    null or equal ids play no part, as every text is judged alone; other columns stay as
    they are. A column called ``name`` is replaced. A text is held whole by one task.
    """

    @F.pandas_udf(RESULT)
    def of(texts: pd.Series) -> pd.DataFrame:
        n_words, lists, left = [], [], []
        for start, stop in batches(texts):
            for words, got in text_runs(texts.iloc[start:stop].tolist(), least, exponent):
                n_words.append(len(words))
                lists.append([{"start": s, "length": n, "period": p} for s, n, p in got.tolist()])
                left.append(_collapsed(words, got))
        return pd.DataFrame({"n_words": n_words, "runs": lists, "collapsed": left})

    return docs.withColumn(name, of(utf8(F.col(text_col))))


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text of the stated query: a tenth of the documents repeat a stretch from some word on.

    With h = crc32 of the id as text, unsigned, and g = floor(h / 10): where h % 10 is 0 and
    there are n > 0 words, each word i >= a becomes word a + (i - a) % p, for a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, null ones too, stay as they are; a
    null id counts as an empty text.
    """
    key, text = F.col(id_col), F.col(text_col)
    h = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    split = docs.select(key.alias("id"), text.alias("text"), F.floor(h / 10).cast("long").alias("g"), words.alias("w"))
    n, g, w = F.size("w").cast("long"), F.col("g"), F.col("w")
    a = g % F.greatest(n, F.lit(1).cast("long"))
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    whole = lambda x: x.cast("int")
    again = F.flatten(F.array_repeat(F.slice(w, whole(a + 1), whole(p)), whole(F.ceil((n - a) / p))))
    turned = F.concat(F.slice(w, F.lit(1), whole(a)), F.slice(again, F.lit(1), whole(n - a)))
    return split.select(F.col("id").alias(id_col), F.when(n > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias(text_col))


def digest(found: Column) -> dict[str, Column]:
    """The digest columns of ``find_runs``' result; ``best`` is the run of the greatest length by period."""
    runs_ = found["runs"]

    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        first = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))
        return F.when((left > right) | ((left == right) & first), -1).otherwise(1)

    best = F.get(F.array_sort(runs_, better), F.lit(0))
    fields = ("start", "length", "period")
    lines = F.transform(runs_, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in fields]), F.lit("\n")))
    return {
        "n_runs": F.size(runs_).cast("long"),
        "start": best["start"],
        "length": best["length"],
        "period": best["period"],
        "exponent_milli": F.floor(1000 * best["length"] / best["period"]).cast("long"),
        "runs_sha256": F.sha2(F.array_join(lines, "").cast("binary"), 256),
        "collapsed_sha256": F.sha2(found["collapsed"], 256),
    }
