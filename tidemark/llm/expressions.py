"""Column helpers for text that is cut at matches and put together again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def cumulative(numbers: Column) -> Column:
    """Running sums of an array of numbers, in time near to its length."""
    zero = F.lit(0).cast("long")
    extend = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))

    def chunks(all_: Column) -> Column:
        count = F.ceil(F.size(all_) / _CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(1), count), lambda c: F.slice(all_, (c - 1) * _CHUNK + 1, F.lit(_CHUNK)))

    def sums(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, x: a + x))
        starts = F.aggregate(totals, F.array(zero), extend)
        inner = F.zip_with(
            parts, starts, lambda p, s: F.when(p.isNotNull(), F.slice(F.aggregate(p, F.array(s), extend), F.lit(2), F.lit(_CHUNK)))
        )
        return F.flatten(F.filter(inner, lambda x: x.isNotNull()))

    empty = F.array().cast("array<bigint>")
    return let(numbers, lambda n: F.when(F.size(n) > 0, let(chunks(n), sums)).otherwise(empty))


def woven(pieces: Column, found: Column) -> Column:
    """A text from the pieces between matches and what stands for the matches."""
    return F.array_join(F.zip_with(pieces, found, lambda p, f: F.concat(p, F.coalesce(f, F.lit("")))), "")
