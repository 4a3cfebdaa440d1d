"""Secrets by pattern and by a battery of randomness tests.

Three kinds follow patterns: values assigned to secret names, access key ids and long
hex strings. The battery looks at the other long tokens of a text. It infers a token's
encoding from its characters and compares it with two hypotheses:

* *ordinary text* in that alphabet, whose chi-squared statistic against uniform
  frequencies is far above that of random symbols (``coincidence`` is the chance that
  two symbols of ordinary text agree). ``S`` says by how many standard deviations of
  ordinary text the statistic lies below. It grows with the length, so short tokens
  cannot stand out.
* *random symbols*, for which the runs test and the serial correlation test must hold.
  Excess of these two is taken off ``S``, which only makes its p-value conservative;
  it removes alphabets, counters and keyboard rows, uniform as they are.

Tokens are strata of encoding and length class. In each, the Benjamini-Hochberg step
over all documents bounds the share of false discoveries. It needs only a histogram
of ``S``: strata times score bins, bounded whatever the input.

Only column functions are used. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.expressions import cumulative, let, woven
from tidemark.session import materialize


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The kinds in their order.
KEYS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = rf"({'|'.join(map(_either_case, KEYS))})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_VALUE = 8
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

MIN_TOKEN = 20
FALSE_DISCOVERIES = 0.01
PLACEHOLDER = "[SECRET]"

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()


@dataclass(frozen=True)
class Encoding:
    pattern: str
    alphabet: str
    coincidence: float


# The first that fits is a token's encoding. Coincidences are those of numbers, words and names.
ENCODINGS = (
    Encoding("^[0-9]+$", _DIGITS, 0.15),
    Encoding("^[0-9a-f]+$", _DIGITS + "abcdef", 0.11),
    Encoding("^[0-9A-F]+$", _DIGITS + "ABCDEF", 0.11),
    Encoding("^[a-z]+$", _LOWER, 0.06),
    Encoding("^[A-Z2-7]+$", _UPPER + "234567", 0.055),
    Encoding("^[0-9a-z]+$", _DIGITS + _LOWER, 0.05),
    Encoding("^[0-9A-Z]+$", _DIGITS + _UPPER, 0.05),
    Encoding("^[0-9A-Za-z]+$", _DIGITS + _LOWER + _UPPER, 0.045),
    Encoding("^[0-9A-Za-z+/]+$", _UPPER + _LOWER + _DIGITS + "+/", 0.045),
    Encoding("", _UPPER + _LOWER + _DIGITS + "-_+/", 0.045),
)
_BINS, _LOWEST, _HIGHEST = 4, -20, 80
_SPAN = "struct<start:bigint,kind:int,end:bigint>"


def token_pattern(least: int) -> str:
    return rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{least},}}={{0,2}}"


def spans_of(text: Column, pattern: str, kind: int, value: int | None = None) -> Column:
    """Spans of the matches; with ``value``, only where group 2 has as many characters."""

    def find(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        steps = F.zip_with(F.split(t, pattern, -1), found, lambda p, f: F.length(p) + F.length(f))
        steps = F.filter(steps, lambda s: s.isNotNull())
        ends = F.zip_with(cumulative(steps), found, lambda e, f: F.struct((e - F.length(f)).alias("start"), F.lit(kind).alias("kind"), e.alias("end")))
        if value is None:
            return ends
        group = F.regexp_extract_all(t, F.lit(pattern), F.lit(2))
        kept = F.zip_with(ends, group, lambda s, g: F.when(F.length(g) >= value, s))
        return F.filter(kept, lambda s: s.isNotNull())

    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(text.rlike(pattern), let(text, find).cast(f"array<{_SPAN}>")).otherwise(none)


def hidden(text: Column, fill) -> Column:
    """``text`` with the secrets of the three patterned kinds put through ``fill``."""
    for pattern, value in ((ASSIGN, ASSIGN_VALUE), (ACCESS, None), (HEX, None)):

        def hide(t: Column, pattern=pattern, value=value) -> Column:
            found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
            if value is None:
                new = F.transform(found, fill)
            else:
                group = F.regexp_extract_all(t, F.lit(pattern), F.lit(2))
                new = F.zip_with(found, group, lambda f, g: F.when(F.length(g) >= value, fill(f)).otherwise(f))
            return woven(F.split(t, pattern, -1), new)

        text = let(text, lambda t, hide=hide, pattern=pattern: F.when(t.rlike(pattern), hide(t)).otherwise(t))
    return text


def battery(token: Column) -> Column:
    """Encoding, length class and score bin of one token."""

    def with_encoding(body: Column) -> Column:
        which = F.lit(len(ENCODINGS) - 1)
        for i in reversed(range(len(ENCODINGS) - 1)):
            which = F.when(body.rlike(ENCODINGS[i].pattern), F.lit(i)).otherwise(which)
        return let(which, lambda e: let(statistics(body, e), lambda s: scored(s, e)))

    def statistics(body: Column, e: Column) -> Column:
        pick = lambda values: F.element_at(F.array(*map(F.lit, values)), e + 1)
        alphabet = pick([x.alphabet for x in ENCODINGS])
        chars = F.regexp_extract_all(body, F.lit("."), F.lit(0))

        def sums(b: Column) -> Column:
            x, ones, c = b["x"], b["half"], b["chars"]
            rest = lambda a: F.concat(F.slice(a, F.lit(2), F.size(a)), F.slice(a, F.lit(1), F.lit(1)))
            total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
            changes = F.zip_with(ones, F.slice(ones, F.lit(2), F.size(ones)), lambda p, q: F.coalesce((p != q).cast("double"), F.lit(0.0)))
            squares = F.transform(F.array_distinct(c), lambda s: F.pow((F.length(body) - F.length(F.replace(body, s, F.lit("")))).cast("double"), F.lit(2.0)))
            return F.struct(
                F.size(x).cast("double").alias("n"),
                pick([float(len(y.alphabet)) for y in ENCODINGS]).alias("k"),
                pick([y.coincidence for y in ENCODINGS]).alias("agree"),
                total(x).alias("sx"),
                total(F.transform(x, lambda v: v * v)).alias("sxx"),
                total(F.zip_with(x, rest(x), lambda p, q: p * q)).alias("sxy"),
                total(ones).alias("ones"),
                (total(changes) + 1.0).alias("runs"),
                total(squares).alias("squares"),
            )

        index = lambda c, a: (F.instr(a, c) - 1).cast("double")
        both = let(
            F.struct(chars.alias("chars"), alphabet.alias("a")),
            lambda p: let(
                F.transform(p["chars"], lambda c: index(c, p["a"])),
                lambda x: F.struct(p["chars"].alias("chars"), x.alias("x"), F.transform(x, lambda v: (v * 2 >= F.length(p["a"])).cast("double")).alias("half")),
            ),
        )
        return let(both, sums)

    def scored(s: Column, e: Column) -> Column:
        n, k = s["n"], s["k"]
        chi = k / n * s["squares"] - n
        text = k + k * (n - 1) * s["agree"] - n
        spread = F.sqrt(2 * (k - 1) + 4 * F.greatest(text - (k - 1), F.lit(0.0)))
        mean = 2 * s["ones"] * (n - s["ones"]) / n + 1
        runs_var = (mean - 1) * (mean - 2) / (n - 1)
        runs = F.when(runs_var > 0, F.pow(s["runs"] - mean, F.lit(2.0)) / runs_var).otherwise(n)
        base = n * s["sxx"] - s["sx"] * s["sx"]
        serial = (n * s["sxy"] - s["sx"] * s["sx"]) / base + 1 / (n - 1)
        serial = F.when(base > 0, F.pow(serial, F.lit(2.0)) * F.pow(n - 1, F.lit(2.0)) * (n - 2) / (n * n)).otherwise(n)
        score = (text - chi) / spread - F.greatest(F.lit(0.0), (runs + serial - 2) / 2)
        bin_ = F.least(F.greatest(F.floor(score * _BINS), F.lit(_LOWEST)), F.lit(_HIGHEST))
        stratum = e * 64 + F.floor(F.log2(n)).cast("int")
        return F.struct(stratum.cast("int").alias("stratum"), bin_.cast("int").alias("bin"))

    return let(F.regexp_replace(token, "=+$", ""), with_encoding)


def tested(hidden_text: Column, least: int) -> Column:
    """Struct per long token of a text whose patterned secrets are blank: span and battery."""
    pattern = token_pattern(least)
    kind = KINDS.index("random")

    def test(t: Column) -> Column:
        tokens = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        return F.zip_with(spans_of(t, pattern, kind), F.transform(tokens, battery), lambda s, b: F.struct(s.alias("span"), b["stratum"].alias("stratum"), b["bin"].alias("bin")))

    kind_of = f"array<struct<span:{_SPAN},stratum:int,bin:int>>"
    return F.when(hidden_text.rlike(pattern), let(hidden_text, test).cast(kind_of)).otherwise(F.array().cast(kind_of))


def thresholds(tests: DataFrame, rate: float) -> dict[int, int]:
    """Least score bin that counts as a discovery, by stratum; ``tests`` has the column ``tokens``.

    Collects strata times score bins, which no input exceeds.
    """
    counts = tests.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.bin").count().collect()
    found: dict[int, int] = {}
    for stratum in {r["stratum"] for r in counts}:
        own = sorted(((r["bin"], r["count"]) for r in counts if r["stratum"] == stratum), reverse=True)
        total, above = sum(c for _, c in own), 0
        for bin_, count in own:
            above += count
            if 0.5 * math.erfc(bin_ / _BINS / math.sqrt(2)) <= rate * above / total:
                found[stratum] = bin_
    return found


def discovered(stratum: Column, bin_: Column, limits: dict[int, int]) -> Column:
    if not limits:
        return F.lit(False)
    least = F.create_map(*(F.lit(x) for pair in sorted(limits.items()) for x in pair))
    return F.coalesce(bin_ >= F.element_at(least, stratum), F.lit(False))


def blank(match: Column) -> Column:
    return F.repeat(F.lit(" "), F.length(match))


def _described(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_TOKEN, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """One row per document: id, ``n_assign``, ``n_access``, ``n_hex``, ``n_random``, ``base_sha256``, ``spans``.

    A null or empty text has no spans. Spans of one kind never overlap; those of the
    battery lie outside the others. Repeated rows are judged alike, but each counts in
    the false-discovery step. An empty table gives an empty result. Other columns are
    not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = [spans_of(F.col("t"), ASSIGN, 0, ASSIGN_VALUE), spans_of(F.col("t"), ACCESS, 1), spans_of(F.col("t"), HEX, 2)]
    found = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    found = found.select("id", *(b.alias(k) for b, k in zip(base, KINDS)), tested(hidden(F.col("t"), blank), least).alias("tokens"))
    found = materialize(found, "secrets")
    limits = thresholds(found, rate)
    random = F.transform(F.filter("tokens", lambda t: discovered(t["stratum"], t["bin"], limits)), lambda t: t["span"])
    patterned = F.concat(*KINDS[:3])
    return found.withColumn("random", random).select(
        F.col("id").alias(id_col),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_described(patterned).cast("binary"), 256).alias("base_sha256"),
        _described(F.concat(patterned, F.col("random"))).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", least: int = MIN_TOKEN, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """All documents, all columns, with every secret of a text replaced by ``PLACEHOLDER``.

    Where a text changed, ``length_col`` gets its new length, if there is such a column.
    """
    text = F.col(text_col)
    tests = docs.select(tested(hidden(F.coalesce(text, F.lit("")), blank), least).alias("tokens"))
    limits = thresholds(tests, rate)
    pattern = token_pattern(least)

    def clean(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        new = F.transform(found, lambda f: let(battery(f), lambda b: F.when(discovered(b["stratum"], b["bin"], limits), F.lit(PLACEHOLDER)).otherwise(f)))
        return F.when(t.rlike(pattern), woven(F.split(t, pattern, -1), new)).otherwise(t)

    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("doc"), let(hidden(text, lambda f: F.lit(PLACEHOLDER)), clean).alias("new"))
    old = F.col("doc").getField(text_col)
    out = {text_col: F.col("new")}
    if length_col in names:
        changed = ~F.col("new").eqNullSafe(old)
        length = F.col("doc").getField(length_col)
        out[length_col] = F.when(changed, F.length("new").cast(docs.schema[length_col].dataType)).otherwise(length)
    return rows.select(*(out.get(c, F.col("doc").getField(c)).alias(c) for c in names))
