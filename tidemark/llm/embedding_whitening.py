"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries are rounded down to whole numbers, so n times the scatter matrix, A = n * sum(x x') -
S S', is a matrix of integers. Its characteristic polynomial is computed exactly: modulo
many primes by reduction to Hessenberg form, one prime at a time in Spark tasks, and put
together by Chinese remaindering. All roots are real and none is negative, so the signs of
the shifted coefficients count the roots above any point; bisection isolates the largest
ones to ``BITS`` bits. Components are the null vectors of A - root, by inverse iteration in
decimal arithmetic of ``DIGITS`` digits.

Only sums over all rows reach the driver: their number is bounded by the dimension squared,
not by the rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
BITS = 200  # to which roots are isolated; roots that agree so far count as one
DIGITS = 90
# Entries at or beyond this, times the scale, do not fit a long.
LARGEST = 2.0**52

_LIMB = 20  # bits of a part of an entry: sums of 8192 products stay exact in doubles
_CHUNK = 8192
_BASE = 40  # bits of a part of a sum on its way


def usable(vector: Column) -> Column:
    """Not null, and no entry null, infinite, not a number, or of 2**52 and more."""
    fine = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < LARGEST))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def rounded(vectors: pd.Series, scale: int = SCALE) -> np.ndarray:
    """Entries times ``scale`` rounded down, a row per vector."""
    return np.floor(np.stack(vectors.to_list()).astype(np.float64) * scale).astype(np.int64)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x`` as whole numbers of ``_LIMB`` bits in doubles, the last one with the sign."""
    out, rest = [], x
    while np.abs(rest).max(initial=0) >= 1 << _LIMB:
        out.append((rest & ((1 << _LIMB) - 1)).astype(np.float64))
        rest = rest >> _LIMB
    return [*out, rest.astype(np.float64)]


def moments(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of whole numbers: row and column 0 stand for a constant one."""
    total = np.zeros((x.shape[1] + 1,) * 2, object)
    for at in range(0, len(x), _CHUNK):
        part = x[at : at + _CHUNK]
        whole = np.concatenate([np.ones((len(part), 1), np.int64), part], 1)
        limbs = _limbs(whole)
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (_LIMB * (i + j))
    return total


def _parts(total: np.ndarray) -> pd.DataFrame:
    """The upper triangle as rows (i, j, k, part): value = sum of part * 2**(40 k)."""
    i, j = np.triu_indices(len(total))
    rest, frames, k = total[i, j], [], 0
    while True:
        last = max(map(abs, rest), default=0) < 1 << (_BASE + 10)
        part = rest if last else rest & ((1 << _BASE) - 1)
        frames.append(pd.DataFrame({"i": i, "j": j, "k": k, "part": part.astype(np.int64)}))
        if last:
            return pd.concat(frames)
        rest, k = rest >> _BASE, k + 1


def sums(vectors: DataFrame, vector_col: str, dimension: int, scale: int = SCALE) -> np.ndarray:
    """``moments`` of all rows."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                mine = moments(rounded(batch["vector"], scale))
                total = mine if total is None else total + mine
        if total is not None:
            yield _parts(total)

    parts = vectors.select(F.col(vector_col).alias("vector")).mapInPandas(partial, "i int, j int, k int, part long")
    # A row per pair of dimensions, so their number is bounded by the dimension squared.
    summed = parts.groupBy("i", "j", "k").agg(F.sum("part").alias("part")).collect()
    total = np.zeros((dimension + 1,) * 2, object)
    for r in summed:
        total[r["i"], r["j"]] += int(r["part"]) << (_BASE * r["k"])
        if r["i"] != r["j"]:
            total[r["j"], r["i"]] = total[r["i"], r["j"]]
    return total


def _is_prime(n: int) -> bool:
    """Miller-Rabin; the four bases decide all numbers below 3.2 * 10**9."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31, from the largest down, whose product exceeds ``bound``."""
    out, product, n = [], 1, (1 << 31) + 1
    while product <= bound:
        n -= 2
        if _is_prime(n):
            out.append(n)
            product *= n
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime below 2**31, from the highest power down."""
    h, n = matrix.copy(), len(matrix)
    for m in range(1, n - 1):
        pivots = np.nonzero(h[m:, m - 1])[0]
        if not len(pivots):
            continue
        i = m + int(pivots[0])
        if i != m:
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] + (p - u)[:, None] * h[m]) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(1)) % p
    poly = np.zeros((n + 1, n + 1), np.int64)  # row k: the leading k by k part, lowest power first
    poly[0, 0] = 1
    chain = np.zeros(n, np.int64)  # products of the subdiagonal up to the current column
    for k in range(1, n + 1):
        if k > 1:
            chain[: k - 2] = chain[: k - 2] * h[k - 1, k - 2] % p
            chain[k - 2] = h[k - 1, k - 2]
        step = np.roll(poly[k - 1], 1) - h[k - 1, k - 1] * poly[k - 1] % p
        weights = chain[: k - 1] * h[: k - 1, k - 1] % p
        poly[k] = (step - (weights[:, None] * poly[: k - 1] % p).sum(0)) % p
    return poly[n, ::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients of det(x - matrix), highest power first, of a symmetric integer matrix without negative roots."""
    n = len(matrix)
    mean = int(matrix.trace()) // n + 1  # the coefficients are greatest if all roots equal their mean
    bound = 2 * max(comb(n, k) * mean**k for k in range(n + 1)) + 1
    primes = primes_beyond(bound)

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [polynomial_modulo((matrix % p).astype(np.int64), p) for p in batch["p"].tolist()]
            yield pd.DataFrame({"p": batch["p"], "residues": found})

    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    got = dealt.mapInPandas(reduced, "p long, residues array<long>").collect()  # primes times the dimension
    value, product = [0] * (n + 1), 1
    for p, residues in got:
        inverse = pow(product, -1, p)
        value = [v + product * ((r - v) * inverse % p) for v, r in zip(value, residues)]
        product *= p
    return [v - product if 2 * v > product else v for v in value]


def _scaled(poly: list[int], s: int) -> list[int]:
    """Coefficients, up to a factor, of the polynomial in z = x * 2**s."""
    n = len(poly) - 1
    return [c << (s * k) for k, c in enumerate(poly)] if s >= 0 else [c << (-s * (n - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], num: int, s: int) -> int:
    """Number of roots above num / 2**s of a polynomial with real roots only, each as often as it occurs.

    The sign changes of the coefficients around a point: Descartes' bound is exact here.
    """
    b = _scaled(poly, s)
    n = len(b) - 1
    for i in range(n if num else 0):
        for j in range(1, n + 1 - i):
            b[j] += num * b[j - 1]
    signs = [c > 0 for c in b if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], num: int, s: int) -> int:
    value = 0
    for c in _scaled(poly, s):
        value = value * num + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int, bits: int = BITS) -> list[tuple[int, int, int]]:
    """The ``count`` largest positive roots, as (num, s, how many): each lies in (num, num + 1] / 2**s.

    The roots of a polynomial with real roots only, from the greatest down; num has ``bits``
    bits. Roots that share such a small interval come as one with their number, which may
    lead a little beyond ``count``. Fewer where there are fewer positive roots.
    """
    if len(poly) > 1 and poly[1] >= 0:  # minus the sum of the roots
        return []
    top = (-poly[1]).bit_length() if len(poly) > 1 else 0
    out, todo = [], [(0, -top, 0, roots_above(poly, 0, -top))]
    while todo:
        num, s, over, inside = todo.pop()
        if not inside or over >= count:
            continue
        if num.bit_length() >= bits:
            out.append((num, s, inside))
        elif inside == 1:
            # One simple root: the sign on its right is that of the roots above it.
            right = -1 if over % 2 else 1
            while num.bit_length() < bits:
                num, s = 2 * num, s + 1
                if _sign(poly, num + 1, s) not in (0, right):
                    num += 1
            out.append((num, s, 1))
        else:
            middle = roots_above(poly, 2 * num + 1, s + 1) - over
            todo.append((2 * num, s + 1, over + middle, inside - middle))
            todo.append((2 * num + 1, s + 1, over, middle))
    return out


def null_vectors(matrix: np.ndarray, num: int, s: int, many: int) -> tuple[list[list[float]], str]:
    """Orthonormal vectors of the eigenvalue (num + 1/2) / 2**s, which occurs ``many`` times, and that value.

    Inverse iteration on one decomposition, in decimal arithmetic; the sign makes the largest
    entry positive.
    """
    with localcontext() as ctx:
        ctx.prec = DIGITS
        root = Decimal(2 * num + 1) / (Decimal(2) ** (s + 1)) if s >= -1 else Decimal((2 * num + 1) << (-s - 1))
        n = len(matrix)
        m = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
        for i in range(n):
            m[i, i] -= root
        tiny = (abs(root) + 1) * Decimal(10) ** (5 - DIGITS)
        perm = np.arange(n)
        for k in range(n):
            i = k + max(range(n - k), key=lambda r: abs(m[k + r, k]))
            if i != k:
                m[[k, i]] = m[[i, k]]
                perm[[k, i]] = perm[[i, k]]
            if abs(m[k, k]) < tiny:
                m[k, k] = tiny
            if k + 1 < n:
                m[k + 1 :, k] = m[k + 1 :, k] / m[k, k]
                m[k + 1 :, k + 1 :] = m[k + 1 :, k + 1 :] - m[k + 1 :, k][:, None] * m[k, k + 1 :]
        rng = random.Random(n)
        found = [np.array([Decimal(rng.randrange(1, 1 << 30)) for _ in range(n)], object) for _ in range(many)]
        for _ in range(3):
            for at, v in enumerate(found):
                v = v[perm]
                for k in range(1, n):
                    v[k] -= m[k, :k] @ v[:k]
                for k in reversed(range(n)):
                    if k + 1 < n:
                        v[k] -= m[k, k + 1 :] @ v[k + 1 :]
                    v[k] /= m[k, k]
                v = v / max(map(abs, v))
                for _ in range(2):
                    for w in found[:at]:
                        v = v - (v @ w) * w
                found[at] = v / (v @ v).sqrt()
        out = []
        for v in found:
            sizes = [float(abs(x)) for x in v]
            out.append([float(x) for x in (v if v[sizes.index(max(sizes))] > 0 else -v)])
        return out, str(root)


@dataclass(frozen=True)
class Whitening:
    """Sums of the fit list and the components, the greatest eigenvalue first.

    ``roots`` are eigenvalues of ``n**2`` times the covariance, exact to ``BITS`` bits.
    """

    n: int
    scale: int
    offset: int
    totals: list[int]  # of the entries with the offset, by dimension
    components: list[list[float]]
    roots: list[Decimal]
    trace: int
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(r / self.trace) for r in self.roots]


def _identity_error(matrix: np.ndarray, vectors: list[list[float]], roots: list[Decimal]) -> float:
    """Largest entry of the whitened covariance minus the identity, in decimal arithmetic."""
    with localcontext() as ctx:
        ctx.prec = DIGITS
        exact = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
        w = np.array([[Decimal(x) / r.sqrt() for x in v] for v, r in zip(vectors, roots)], object)
        gap = w @ exact @ w.T
        return max(float(abs(gap[i, j] - (i == j))) for i in range(len(w)) for j in range(len(w)))


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Whitening of all usable rows of the most frequent length, or None where there is no row or no spread.

    Ties of length go to the longer one. Components of eigenvalue zero are left out, so there
    may be fewer than ``components``.
    """
    spark = vectors.sparkSession
    fine = vectors.where(usable(F.col(vector_col)))
    lengths = fine.groupBy(F.size(vector_col).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if most is None or most["d"] == 0:
        return None
    d = most["d"]
    total = sums(fine.where(F.size(vector_col) == d), vector_col, d, scale)
    n, first = int(total[0, 0]), total[0, 1:]
    matrix = n * total[1:, 1:] - first[:, None] * first[None, :]
    trace = int(matrix.trace())
    if trace == 0:
        return None
    found = largest_roots(characteristic_polynomial(spark, matrix), components)

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [null_vectors(matrix, int(r.num), r.s, r.many) for r in batch.itertuples()]
            yield pd.DataFrame({"at": batch["at"], "vectors": [g[0] for g in got], "root": [g[1] for g in got]})

    jobs = [(at, str(num), s, many) for at, (num, s, many) in enumerate(found)]
    dealt = spark.createDataFrame(jobs, "at int, num string, s int, many int").repartition(len(jobs))
    rows = dealt.mapInPandas(solved, "at int, vectors array<array<double>>, root string").collect()  # the components
    pairs = [(v, Decimal(r["root"])) for r in sorted(rows, key=lambda r: r["at"]) for v in r["vectors"]][:components]
    vectors_, roots = [p[0] for p in pairs], [p[1] for p in pairs]
    totals = [int(t) + n * offset for t in first]
    return Whitening(n, scale, offset, totals, vectors_, roots, trace, _identity_error(matrix, vectors_, roots))


RESULT = T.StructType([T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("values", T.ArrayType(T.DoubleType()))])


def whiten(vectors: DataFrame, model: Whitening | None, vector_col: str = "embedding", name: str = "whitened") -> DataFrame:
    """Usable rows of the model's dimension with ``name``: ``deviation`` and ``values``, one per component.

    ``deviation``: the sum of (n * x - S)**2 over the dimensions, exact, null beyond 38 digits.
    A value is x - S / n projected on the component, over the square root of its eigenvalue.

    Dropped are rows whose vector is null, has another length, or has an entry that is null,
    infinite, not a number, or of 2**52 and more; without a model (an empty table, or all
    vectors equal) all rows. Repeated rows and null ids are rows as others; other columns stay
    as they are, one called ``name`` is replaced.
    """
    if model is None:
        return vectors.withColumn(name, F.lit(None).cast(RESULT)).where(F.lit(False))
    n, scale = model.n, model.scale
    centre = [t - n * model.offset for t in model.totals]
    weights = np.array(model.components) / np.array([float(r.sqrt()) for r in model.roots])[:, None]

    @F.pandas_udf(RESULT)
    def of(vectors: pd.Series) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"deviation": [], "values": []})
        x = rounded(vectors, scale)
        most = n * int(np.abs(x).max(initial=0)) + max(map(abs, centre))
        if most * most * len(centre) < 1 << 62:
            u = n * x - np.array(centre, np.int64)
            squares = (u * u).sum(1).tolist()
        else:
            u = n * x.astype(object) - np.array(centre, object)
            squares = (u * u).sum(1).tolist()
        deviation = [Decimal(v) if v < 10**38 else None for v in squares]
        return pd.DataFrame({"deviation": deviation, "values": list(u.astype(np.float64) @ weights.T)})

    vector = F.col(vector_col)
    kept = vectors.where(usable(vector) & (F.size(vector) == len(centre)))
    return kept.withColumn(name, of(vector))
