"""Cleaning and typed casts of text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the source rules.
TS_PREFIX = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
NUMERIC = r"^-?[0-9]+(\.[0-9]+)?$"
INTEGER = r"^[0-9]+$"
YEAR_MONTH = r"^[0-9]{6}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str, any_whitespace: bool = False) -> Column:
    """Trim, then empty becomes NULL. Plain SQL trimming removes spaces only."""
    c = _col(c)
    text = F.regexp_replace(c, r"^\s+|\s+$", "") if any_whitespace else F.trim(c)
    return F.nullif(text, F.lit(""))


def is_blank(c: Column | str) -> Column:
    return blank_to_null(c).isNull()


def not_matching(c: Column | str, pattern: str) -> Column:
    return ~_col(c).rlike(pattern)


def year_month(c: Column | str) -> Column:
    """``YYYYMM`` of a timestamp text that starts with a 20xx year and a real month."""
    pattern = r"^(20\d\d)-(0[1-9]|1[0-2])"
    c = _col(c)
    joined = F.concat(F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2))
    return F.nullif(joined, F.lit(""))


def ts_seconds(c: Column | str) -> Column:
    """Timestamp from a text that starts with ``yyyy-MM-dd HH:mm:ss``.

    A fraction, a zone or whatever follows is cut off. An impossible time gives NULL;
    the datatype rules report it.
    """
    text = F.trim(_col(c))
    return F.when(text.rlike(TS_PREFIX), F.substring(text, 1, 19).try_cast("timestamp_ntz"))


def ts_iso(c: Column | str) -> Column:
    """Timestamp from ``yyyy-MM-dd``, a ``T`` or blank, and ``HH:mm`` or ``HH:mm:ss``; the rest is cut off."""
    text, shape = F.trim(_col(c)), r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})(:\d{2})?"
    part = [F.regexp_extract(text, shape, i) for i in (1, 2, 3)]
    seconds = F.coalesce(F.nullif(part[2], F.lit("")), F.lit(":00"))
    return F.when(text.rlike(shape), F.concat(part[0], F.lit(" "), part[1], seconds).try_cast("timestamp_ntz"))


def ts_masked(c: Column | str, digits: int = 3) -> Column:
    """Timestamp from ``yyyy/MM/dd HH:mm:ss.fffffffff``, fraction cut to ``digits``."""
    shape = r"^(\d{4})/(\d{2})/(\d{2}) (\d{2}:\d{2}:\d{2})(?:(\.\d{1,%d})\d*)?$" % digits
    text = F.trim(_col(c))
    iso = F.regexp_replace(text, shape, "$1-$2-$3 $4$5")
    return F.when(text.rlike(shape), iso.try_cast("timestamp_ntz"))


def number(c: Column | str, type_name: str = "decimal(12,8)") -> Column:
    return blank_to_null(c).try_cast(type_name)


def integer(c: Column | str) -> Column:
    return blank_to_null(c).try_cast("int")


def dirty_number(c: Column | str, type_name: str = "decimal(12,4)") -> Column:
    """Trace mark ``T`` becomes NULL, everything but digits, point and sign is dropped."""
    text = blank_to_null(c)
    digits = F.nullif(F.regexp_replace(text, r"[^0-9.\-]", ""), F.lit(""))
    return F.when(text != "T", digits.try_cast(type_name))


def cast_columns(spec: Mapping[str, str]) -> list[Column]:
    """Declared casts, e.g. ``{"age": "int", "updated": "masked_ts"}``."""
    made = []
    for name, kind in spec.items():
        if kind == "masked_ts":
            made.append(ts_masked(name).alias(name))
        elif kind == "string":
            made.append(blank_to_null(name).alias(name))
        else:
            made.append(number(name, kind).alias(name))
    return made


def flatten_array_text(c: Column | str) -> Column:
    """A JSON string array or an already piped text becomes a piped text."""
    text = F.trim(_col(c))
    items = F.from_json(text, "array<string>")
    return F.when(text.startswith("["), F.array_join(items, "|")).otherwise(text)


def raw_payload(cols: Sequence[str]) -> Column:
    """The row as a JSON object with NULL fields kept."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def business_key(*parts: Column | str, sep: str = "@") -> Column:
    """Readable key; a missing part shows as ``(null)``."""
    shown = [F.coalesce(blank_to_null(p), F.lit("(null)")) for p in parts]
    return shown[0] if len(shown) == 1 else F.concat_ws(sep, *shown)


def first_filled(*cols: Column | str) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def decode(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Code to value. Small fixed maps only; large ones belong in a lookup table."""
    c = _col(c)
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out.otherwise(F.lit(default)) if default is not None else out


def decode_prefix(c: Column | str, prefixes: Mapping[str, str]) -> Column:
    c = _col(c)
    return F.coalesce(*[F.when(c.startswith(p), F.lit(v)) for p, v in prefixes.items()])


def normalize_name(c: Column | str) -> Column:
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    return F.nullif(F.regexp_replace(text, "[^a-z0-9]+", ""), F.lit(""))


def first_error(checks: Sequence[tuple[Column, str]]) -> Column:
    """Message of the first failing check, NULL when all hold."""
    return F.coalesce(*[F.when(failed, F.lit(message)) for failed, message in checks])


def with_constants(df, **values):
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})
