import math
import random
from decimal import Decimal

import numpy as np
import pytest

import cases
from tidemark.llm import embedding_whitening as ew
from tidemark.llm.queries import QUERIES


def plain_polynomial(a):
    """Faddeev-LeVerrier in whole numbers."""
    n = len(a)
    a = np.array(a, object)
    m, c = np.zeros((n, n), object), [1]
    eye = np.array([[int(i == j) for j in range(n)] for i in range(n)], object)
    for k in range(1, n + 1):
        m = a @ m + c[-1] * eye
        c.append(-int(np.trace(a @ m)) // k)
    return c


def scatter(rows, n):
    """A matrix without negative roots: whole vectors times themselves."""
    v = np.array(rows, object).reshape(-1, n)
    return v.T @ v


def random_scatter(rng, n, rows, size):
    return scatter([[rng.randrange(-size, size + 1) for _ in range(n)] for _ in range(rows)], n)


@pytest.mark.parametrize("n,rows,size", [(1, 3, 9), (2, 2, 5), (5, 3, 10**6), (6, 9, 3), (9, 12, 10**12)])
def test_polynomial_is_exact(spark, n, rows, size):
    a = random_scatter(random.Random(n), n, rows, size)
    assert ew.characteristic_polynomial(spark, a) == plain_polynomial(a)


def test_polynomial_without_first_pivots(spark):
    """Zeros below the diagonal call for another pivot or none."""
    a = np.array(np.diag([4, 4, 7, 0, 7]), object)
    a[0, 3] = a[3, 0] = 1
    a[3, 3] = 2
    assert ew.characteristic_polynomial(spark, a) == plain_polynomial(a)


def test_roots_are_counted_and_isolated():
    roots = [0, 0, 1, 3, 3, 3, 10, 10**9]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([*poly, 0], [0, *poly])]
    for at in (0, 1, 2, 3, 9, 10, 11):
        assert ew.roots_above(poly, at, 0) == sum(r > at for r in roots)
    assert ew.roots_above(poly, 21, 1) == 1 and ew.roots_above(poly, 1, -3) == 2
    got = ew.largest_roots(poly, 5, 60)
    assert [many for _, _, many in got] == [1, 1, 3]
    for (num, s, _), want in zip(got, (10**9, 10, 3)):
        assert num < want * 2**s <= num + 1
    assert sum(g[2] for g in ew.largest_roots(poly, 99, 60)) == 6
    assert ew.largest_roots([1, 0, 0], 3) == []


def test_close_roots_are_told_apart():
    """x**2 - 2 m x + m**2 - 1 with a large m: two roots one part in 10**30 away from each other."""
    m = 10**30
    got = ew.largest_roots([1, -2 * m, m * m - 1], 2)
    assert [g[2] for g in got] == [1, 1]
    for (num, s, _), want in zip(got, (m + 1, m - 1)):
        assert num < want * 2**s <= num + 1
    a = np.array([[m, 1], [1, m]], object)
    (first, second) = (ew.null_vectors(a, *g)[0][0] for g in got)
    assert np.allclose(np.abs(first), math.sqrt(0.5), atol=1e-15) and abs(np.dot(first, second)) < 1e-15
    assert first[0] * first[1] > 0 > second[0] * second[1]


def test_repeated_roots_give_a_basis():
    a = np.array(np.diag([5, 9, 9, 9, 2]), object)
    got = ew.largest_roots(plain_polynomial(a), 3)
    assert [g[2] for g in got] == [3]
    vectors = np.array(ew.null_vectors(a, *got[0])[0])
    assert np.allclose(vectors @ vectors.T, np.eye(3), atol=1e-15) and np.allclose(vectors[:, [0, 4]], 0, atol=1e-15)


@pytest.mark.parametrize("size", [3, 10**4, 2**30, 2**50])
def test_sums_are_exact(size):
    rng = random.Random(size)
    rows = [[rng.randrange(-size, size + 1) for _ in range(4)] for _ in range(9000)]
    want = np.array([[1, *r] for r in rows], object)
    got = ew.moments(np.array(rows, np.int64))
    assert (got == want.T @ want).all()
    parts = ew._parts(got)
    back = {}
    for r in parts.itertuples():
        back[r.i, r.j] = back.get((r.i, r.j), 0) + (int(r.part) << (40 * r.k))
    assert all(got[k] == v for k, v in back.items()) and len(back) == 15


def check(rows, vectors, components=8):
    """Rows of the result against numpy: (values, deviation) by row."""
    x = np.floor(1024 * np.array(vectors, float)) + 100000
    n = len(x)
    centred = x - x.mean(0)
    w, u = np.linalg.eigh(centred.T @ centred / n)
    w, u = w[::-1], u[:, ::-1]
    k = min(components, int((w > 1e-9 * w[0]).sum()))
    want = centred @ u[:, :k] / np.sqrt(w[:k])
    got = np.array([r["whitened"]["values"] for r in rows])
    signs = np.sign((want * got).sum(0))
    assert np.allclose(got, want * signs, atol=1e-7)
    exact = ((n * x.astype(object) - x.astype(object).sum(0)) ** 2).sum(1)
    assert [int(r["whitened"]["deviation"]) for r in rows] == [int(v) for v in exact]


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 5)) @ np.diag([5, 3, 1, 0.5, 0.2])
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(base)], "vec_id long, embedding array<double>")
    model = ew.fit(frame.repartition(4), components=3)
    assert model.n == 300 and len(model.components) == 3 and model.identity_error < 1e-12
    check(ew.whiten(frame, model).orderBy("vec_id").collect(), base, 3)


def test_fewer_components_than_asked(spark):
    base = [[float(i % 7), float(2 * (i % 7)), 1.0, float(i % 3)] for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(base)), "vec_id long, embedding array<float>")
    model = ew.fit(frame)
    assert len(model.components) == 2 and abs(sum(model.explained) - 1) < 1e-12
    check(ew.whiten(frame, model).orderBy("vec_id").collect(), base)


def test_query_matches_numpy(spark):
    source = spark.read.parquet(f"{cases.SF}/embeddings.parquet").orderBy("vec_id").collect()
    got = QUERIES["op11_whitening"](spark, cases.SF).toPandas().sort_values(["vec_id", "component"])
    x = np.floor(1024 * np.array([r["embedding"] for r in source], float)) + 100000
    centred = x - x.mean(0)
    w, u = np.linalg.eigh(centred.T @ centred / len(x))
    want = centred @ u[:, ::-1][:, :8] / np.sqrt(w[::-1][:8])
    values = got["whitened"].to_numpy().reshape(-1, 8)
    assert got["vec_id"].tolist() == [r["vec_id"] for r in source for _ in range(8)]
    assert np.allclose(values, want * np.sign((want * values).sum(0)), atol=1e-9)
    assert np.allclose(got["explained"].to_numpy().reshape(-1, 8), w[::-1][:8] / w.sum(), rtol=1e-10)
    assert (got["n"] == len(x)).all() and (got["identity_error"] < 1e-12).all()
    exact = ((len(x) * x - x.sum(0)) ** 2).sum(1)
    assert got["deviation"].to_numpy().reshape(-1, 8)[:, 0].tolist() == exact.tolist()


ODD = "vec_id long, embedding array<double>, whitened string, vector string"


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [1.0, 2.0], [-3.5, 0.25], [0.0, 7.0], [1e3, -1e3]]
    bad = [None, [], [1.0], [1.0, 2.0, 3.0], [None, 1.0], [nan, 1.0], [inf, 1.0], [2.0**52, 1.0]]
    rows = [(i, v, "x", "y") for i, v in enumerate([*good, *bad])] + [(None, good[0], None, None), (2, good[2], "x", "y")]
    frame = spark.createDataFrame(rows, ODD)
    model = ew.fit(frame)
    got = ew.whiten(frame, model)
    assert got.columns == ["vec_id", "embedding", "whitened", "vector"] and model.n == 7
    check(got.collect(), [r["embedding"] for r in got.collect()])


def test_no_spread_and_no_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], None, None) for i in range(5)], ODD)
    for frame in (same, same.limit(0)):
        model = ew.fit(frame)
        assert model is None
        out = ew.whiten(frame, model)
        assert out.count() == 0 and out.schema["whitened"].dataType == ew.RESULT


def test_deviation_beyond_a_long(spark):
    frame = spark.createDataFrame([(0, [2.0**50, 0.0]), (1, [0.0, 0.0]), (2, [1.0, 5.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["whitened"]["deviation"] for r in ew.whiten(frame, ew.fit(frame)).collect()}
    x = [[2**60, 0], [0, 0], [1024, 5120]]
    s = [sum(c) for c in zip(*x)]
    assert got == {i: Decimal(sum((3 * v - t) ** 2 for v, t in zip(r, s))) for i, r in enumerate(x)}
