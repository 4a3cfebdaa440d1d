import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import discriminant
from tidemark.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op10_discriminant"](spark, sf).collect()
    assert len(got) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in quality]
    assert sum(r["predicted"] == quality[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_scores_are_log_density_differences():
    rng = np.random.default_rng(4)
    d = len(discriminant.FEATURES)
    x = [rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) for n in (300, 500)]
    sums = [(float(len(v)), v.sum(0), v.T @ v) for v in x]
    model = discriminant.fit(sums)
    both = np.vstack(x)
    covs = [np.cov(v.T, bias=True) for v in x]
    pooled = sum(len(v) * c for v, c in zip(x, covs)) / len(both)
    logs = []
    for v, c in zip(x, covs):
        c = 0.8 * c + 0.2 * pooled
        c = 0.98 * c + 0.02 * np.trace(c) / d * np.eye(d)
        diff = both - v.mean(0)
        logs.append(np.log(len(v) / len(both)) - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(c), diff) - 0.5 * np.linalg.slogdet(c)[1])
    assert model.score(both) == pytest.approx(1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500))), abs=1e-9)


def test_sums_match_numpy(spark):
    rng = np.random.default_rng(5)
    x, y = rng.random((40, len(discriminant.FEATURES))), rng.integers(0, 2, 40)
    df = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x, y)], "label int, x array<double>")
    for k, (n, s, p) in enumerate(discriminant.class_sums(df)):
        assert n == (y == k).sum() and s == pytest.approx(x[y == k].sum(0)) and p == pytest.approx(x[y == k].T @ x[y == k])


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (6, 0), (7, 0), (None, 1), (4, None), (99, 1), (8, 5)], "doc_id long, quality int")
    got = discriminant.classify(cases.frame(spark), labels, F.lit(True)).collect()
    assert len(got) == len(cases.rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1
    one = discriminant.classify(cases.frame(spark), labels.where("quality = 1"), F.lit(True)).collect()
    assert {r["score"] for r in one} == {0.5}
    assert discriminant.classify(cases.empty(spark), labels, F.lit(True)).collect() == []
