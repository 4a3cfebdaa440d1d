"""A large JSON array read by many tasks.

A document is split by byte ranges: the text reader ends a record at every ``}``, so a task
gets the pieces that begin in its range, whatever lies in them. Where a range begins inside
a string or at an unknown depth, a structural scan finds out:

1. Each task scans its range under both assumptions (outside and inside a string) and says
   which containers the range closes and opens.
2. The summaries of a file are put in order; that gives the state at the start of each range.
3. Each task scans its range again and cuts out the elements. An element that goes on in
   later ranges is put together from its fragments, at most one per range border.

Only quotes, brackets and braces are looked at here; Spark parses the elements.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors get the scan itself and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_REST = re.compile(rb'(?:[^"\\]|\\.)*("?)', re.S)
# A string, up to its end or that of the text; an opening with the colon of its key; a closing.
_TOKEN = re.compile(rb'"((?:[^"\\]|\\.)*)("|\Z)|(:\s*)?([{\[])|[}\]]', re.S)


class Scan:
    """Containers that a text opens and closes, from a state that need not be known.

    ``stack`` holds those that are open, as their kind and key (``{data``, ``[stations``);
    ``pops`` counts closings of containers that were open before.
    """

    def __init__(self, stack: Sequence[str] = (), in_string: bool = False):
        self.stack, self.pops, self.in_string = list(stack), 0, in_string
        self.last = b""

    def _open(self, kind: bytes, keyed: bool) -> str:
        return kind.decode() + (self.last.decode("utf-8", "replace") if keyed else "")

    def tokens(self, text: bytes) -> Iterator[tuple[str, int, int]]:
        """("open" or "close", start, end) of the containers, after ``stack`` and ``pops`` have followed."""
        at = 0
        if self.in_string:
            m = _REST.match(text)
            if not m[1]:
                return
            # Only a part of the string is here: a key that no path has.
            self.in_string, self.last, at = False, b"\x00", m.end()
        for m in _TOKEN.finditer(text, at):
            if m[4] is not None:
                self.stack.append(self._open(m[4], m[3] is not None))
                yield "open", m.start(4), m.end()
            elif m[2] is None:
                if self.stack:
                    self.stack.pop()
                else:
                    self.pops += 1
                yield "close", m.start(), m.end()
            elif m[2]:
                self.last = m[1]
            else:
                self.in_string = True


def _text(pieces: pd.Series) -> bytes:
    return b"}".join(pieces) + b"}"


def _runs(batch: pd.DataFrame) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """Consecutive rows of one range."""
    change = (batch["file"] != batch["file"].shift()) | (batch["block"] != batch["block"].shift())
    for _, rows in batch.groupby(change.cumsum(), sort=False):
        yield rows["file"].iloc[0], int(rows["block"].iloc[0]), rows


SUMMARY = "file string, block long, inside boolean, pops int, stack array<string>, in_string boolean"


def summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Two rows per range: what it closes and opens if it begins outside or inside a string."""

    def row(place, scans):
        return pd.DataFrame(
            [(*place, inside, s.pops, s.stack, s.in_string) for inside, s in scans.items()],
            columns=["file", "block", "inside", "pops", "stack", "in_string"],
        )

    place = scans = None
    for batch in batches:
        for file, block, rows in _runs(batch):
            if place != (file, block):
                if place is not None:
                    yield row(place, scans)
                place, scans = (file, block), {False: Scan(), True: Scan(in_string=True)}
            text = _text(rows["piece"])
            for scan in scans.values():
                for _ in scan.tokens(text):
                    pass
    if place is not None:
        yield row(place, scans)


STATE = "file string, block long, stack array<string>, in_string boolean, owner long"


def states(target: list[str]):
    """The state at the start of each range of a file, and the range in which an open element began."""

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        stack, inside, owner, out = [], False, None, []
        depth = len(target)
        for block, pair in rows.groupby("block", sort=True):
            known = pair[pair["inside"] == inside].iloc[0]
            out.append((known["file"], block, stack, inside, owner))
            kept = stack[: max(0, len(stack) - int(known["pops"]))]
            went_on = owner is not None and len(kept) > depth
            stack, inside = kept + list(known["stack"]), bool(known["in_string"])
            if len(stack) <= depth or stack[:depth] != target:
                owner = None
            elif not went_on:
                owner = int(block)
        frame = pd.DataFrame(out, columns=["file", "block", "stack", "in_string", "owner"])
        return frame.astype({"owner": "Int64"})

    return of


FOUND = "file string, owner long, block long, at long, whole boolean, element binary"


def elements(target: list[str]):
    """Elements of the target array in each range; those cut by its borders as fragments."""
    depth = len(target)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = scan = owner = None
        parts: list[bytes] = []
        whole, at = True, 0
        for batch in batches:
            out = []

            def rest(place, owner, parts, at):
                if parts:  # the element goes on in the next range
                    out.append((place[0], owner, place[1], at, False, b"".join(parts)))

            for file, block, rows in _runs(batch):
                if place != (file, block):
                    rest(place, owner, parts, at)
                    first = rows.iloc[0]
                    place, at = (file, block), 0
                    scan = Scan(first["stack"], bool(first["in_string"]))
                    going = not pd.isna(first["owner"])
                    owner, whole = (int(first["owner"]), False) if going else (block, True)
                    parts = [b""] if going else []
                text = _text(rows["piece"])
                start = 0 if parts else None
                for what, begin, end in scan.tokens(text):
                    if what == "open":
                        if start is None and len(scan.stack) == depth + 1 and scan.stack[:depth] == target and text[begin : begin + 1] == b"{":
                            start, owner, whole = begin, block, True
                            parts = []
                    elif start is not None and len(scan.stack) == depth:
                        parts.append(text[start:end])
                        out.append((file, owner, block, at, whole, b"".join(parts)))
                        at, parts, start = at + 1, [], None
                if start is not None:
                    parts.append(text[start:])
            if out:
                yield pd.DataFrame(out, columns=["file", "owner", "block", "at", "whole", "element"])
        if parts and place is not None:
            yield pd.DataFrame([(place[0], owner, place[1], at, False, b"".join(parts))], columns=["file", "owner", "block", "at", "whole", "element"])

    return of


def read_json_array(spark: SparkSession, path: str, schema: str, items: str = "data.stations") -> DataFrame:
    """One row per object in an array inside JSON documents, with ``source_file``.

    ``schema`` is that of an element, ``items`` the keys from the root to the array, empty
    for an array at the root. Fields that an element lacks are NULL; elements that are no
    objects give no row, nor do files without the array. Keys on the way must be written
    without escapes and hold no ``}``. The order of the rows is not kept. Files are UTF-8.
    """
    keys = [k for k in items.split(".") if k]
    target = [*(["{", *("{" + k for k in keys[:-1])] if keys else []), "[" + (keys[-1] if keys else "")]
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").cast("binary").alias("piece"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    ranges = pieces.mapInPandas(summaries, SUMMARY)
    known = ranges.groupBy("file").applyInPandas(states(target), STATE)
    # A row per range; a broadcast leaves the pieces in order.
    told = pieces.join(F.broadcast(known), ["file", "block"])
    found = told.mapInPandas(elements(target), FOUND)
    fragments = found.filter("not whole").groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("block", "element"))).alias("parts")  # one per range that it crosses
    )
    # Binary pieces put together as text: a piece may end inside a string but not inside a character.
    joined = fragments.select("file", F.array_join(F.transform("parts", lambda p: p["element"].cast("string")), "").alias("text"))
    texts = found.filter("whole").select("file", F.col("element").cast("string").alias("text")).unionByName(joined)
    parsed = texts.select(F.from_json("text", schema).alias("i"), F.col("file").alias("source_file"))
    return parsed.select("i.*", "source_file")
