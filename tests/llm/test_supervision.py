import re
from collections import Counter

import cases
import numpy as np
import pytest
from tidemark.llm import supervision, textstats
from tidemark.llm.queries import QUERIES


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def check(rows, got):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((k, *plain(t)) for k, t in rows), key=key) == sorted((tuple(r[c] for c in ("doc_id", *supervision.BASE)) for r in got), key=key)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)


def test_query_matches_brute_force_and_keeps_the_good(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_quality_rules"](spark, cases.SF).collect()
    check(rows, got)
    good = {r["doc_id"] for r in spark.read.parquet(f"{cases.SF}/labels.parquet").where("quality = 1").collect()}
    assert all(r["kept"] for r in got if r["doc_id"] in good and not r["base_failed"])


def test_odd_rows(spark):
    check([r[:2] for r in cases.rows()], supervision.judge(cases.frame(spark)).collect())
    assert supervision.judge(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("text", ["a b a b a b a b", "a b c d e", "a b c d e a b c d e", "x " * 9, "a b c d e f a b c d e g a b c d", "", "é ü é ü\nb"])
def test_repeated_words(text):
    assert textstats.repeated_words(text.encode().split()) == plain(text)[4]


def test_estimation_finds_planted_accuracies():
    rng = np.random.default_rng(2)
    good = rng.random(20000) < 0.8
    right_good, right_bad = np.array([0.95, 0.9, 0.97, 0.93, 0.96]), np.array([0.6, 0.7, 0.5, 0.65, 0.55])
    votes = np.where(good[:, None], np.where(rng.random((20000, 5)) < right_good, 1, -1), np.where(rng.random((20000, 5)) < right_bad, -1, 1))
    votes[rng.random(votes.shape) < 0.1] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    w = supervision.estimate(patterns.astype(float), counts.astype(float))
    assert w.good == pytest.approx(0.8, abs=0.03)
    assert np.abs(w.on_good - right_good).max() < 0.03 and np.abs(w.on_bad - right_bad).max() < 0.06
    assert ((w.posterior(votes) >= 0.5) == good).mean() > 0.93


def test_column_matches_numpy(spark):
    rng = np.random.default_rng(3)
    votes = rng.integers(-1, 2, (50, 3))
    w = supervision.Weights(0.7, np.array([0.9, 0.8, 0.99]), np.array([0.3, 0.6, 0.5]))
    df = spark.createDataFrame([tuple(map(int, v)) for v in votes], "a int, b int, c int")
    got = [r[0] for r in df.select(supervision.posterior_column(w, ["a", "b", "c"])).collect()]
    assert got == pytest.approx(w.posterior(votes).tolist())
