import math
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tidemark.llm import maxent
from tidemark.llm.common import fold
from tidemark.llm.queries import QUERIES


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def check_base(rows, got, held):
    counts = Counter(t for k, text in rows if not held(k) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for k, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        want.append((k, held(k), len(own), sum(counts[t] > 0 for t in own), total, base))
    key = lambda r: repr((r[0], r[2], round(r[5], 6)))
    have = [tuple(r)[:6] for r in got]
    for a, b in zip(sorted(want, key=key), sorted(have, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def held_of(folds, which):
    return lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % folds == which


@pytest.fixture
def small(monkeypatch):
    """So few hot words that most counts come through the join."""
    monkeypatch.setattr(maxent, "HOT", 700)


def test_query_matches_brute_force_and_beats_counts(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op6_maxent"](spark, cases.SF).collect()
    check_base(rows, got, held_of(7, 2))
    for held in (False, True):
        own = [r for r in got if r["held_out"] == held]
        assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)
    assert all(r["score"] < 0 for r in got)


def test_odd_rows(spark):
    got = maxent.score(cases.frame(spark), fold(F.col("doc_id"), 7) != 2).collect()
    check_base([r[:2] for r in cases.rows()], got, held_of(7, 2))
    nothing = maxent.score(cases.frame(spark), F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["held_out"]) for r in nothing} == {(0, 0, True)}
    assert all(r["base_score"] == 0 and math.isfinite(r["score"]) for r in nothing)
    assert maxent.score(cases.empty(spark), F.lit(True)).collect() == []


def toy():
    words = [w.encode() for w in "a b c d e f g h".split()] + [maxent.END]
    counts = np.arange(len(words), 0, -1) * 10.0
    tail = np.zeros(maxent.TAILS)
    tail[3] = 5
    return maxent.Vocabulary(int(counts.sum()) + 5, len(words) + 2, words, counts, tail, np.where(tail > 0, 2.0, 0.0))


def test_probabilities_sum_to_one():
    vocabulary, rng = toy(), np.random.default_rng(6)
    weights = maxent.Weights()
    weights.class_table += rng.normal(0, 1, weights.class_table.shape).astype(np.float32)
    weights.word_table += rng.normal(0, 1, weights.word_table.shape).astype(np.float32)
    words = [b"a", b"b", b"unseen", b"c", maxent.END]
    t = vocabulary.encode([b"a B unseen\n c"])
    assert t.ids.tolist() == [0, 1, -1, 2, 8] and t.cls[2] == maxent.HEADS + maxent.tail_class(b"unseen")
    logs = weights.class_logs(vocabulary.class_bias)
    assert np.exp(logs).sum(1) == pytest.approx(np.ones(len(logs)), rel=1e-4)
    # The table of pairs holds what the features give.
    z = maxent.exponents(vocabulary.class_bias, weights.class_table, maxent.class_rows(*t.history))
    assert logs[maxent.pairs_of(t)] == pytest.approx(z - np.log(np.exp(z).sum(1, keepdims=True)), abs=1e-4)
    at, _, _, z = next(maxent.chunks(vocabulary, t, weights))
    assert at.tolist() == [0, 1, 3, 4] and len(words) == 5
    total = sum(np.exp(maxent.log_share(z.copy(), np.full(len(at), m))) for m in range(maxent.MEMBERS))
    assert total == pytest.approx(np.ones(len(at)), rel=1e-5)
    # Inside a tail class the counted words and the unseen one share all of it.
    share = (5 + 2 + 1) / 10 ** vocabulary.tail_log[3]
    assert share == pytest.approx(1)


def test_gradient_is_observed_less_expected():
    vocabulary, weights, g = toy(), maxent.Weights(), maxent.Gradient()
    texts = [b"a b a zz", b""]
    g.learn(vocabulary, texts, weights)
    g.finish(vocabulary, weights)
    t = vocabulary.encode(texts)
    assert t.history[0][[0, 5]].tolist() == [maxent.MARKS - 1] * 2 == t.history[1][[1, 5]].tolist()
    want, prior = np.zeros_like(weights.class_table), np.exp(vocabulary.class_bias) / np.exp(vocabulary.class_bias).sum()
    for rows in maxent.class_rows(*t.history):
        for r, c in zip(rows, t.cls):
            want[r] -= prior
            want[r, c] += 1
    observed, expected = g.tables[0]
    assert observed - expected == pytest.approx(want, abs=1e-5)
    assert g.tables[1][0].sum() == 2 * 5 == pytest.approx(g.tables[1][1].sum(), rel=1e-5)


def test_texts_are_scored_alike_alone_and_together(monkeypatch):
    vocabulary, weights, rng = toy(), maxent.Weights(), np.random.default_rng(7)
    weights.class_table += rng.normal(0, 1, weights.class_table.shape).astype(np.float32)
    texts = [b"a b zz c", b"", b"h g f e d c b a " * 50, b"zz zz yy", b"", b" \n"]
    together = maxent.score_texts(vocabulary, weights, texts)
    monkeypatch.setattr(maxent, "CHUNK", 3)
    alone = [maxent.score_texts(vocabulary, weights, [t])[0] for t in texts]
    for a, b in zip(together, alone):
        assert a[:2] + a[4:] == b[:2] + b[4:] and a[2:4] == pytest.approx(b[2:4], rel=1e-5)
    assert [x[1] for x in [t for t in alone]] == [4 + 1 - 1, 1, 401, 1, 1, 1]
    assert [len(x) for x in maxent.gathered(pd.Series([b"a", b"b b", b"c c c c c", b"d"]), 4)] == [2, 1, 1]
    assert maxent.Words.of([b"ab  c", b"", b"\xc3\xa9 AB", b" "]).counts.tolist() == [2, 0, 2, 0]


def test_frequent_words_are_bounded(spark):
    counts = spark.range(1000).selectExpr("cast(cast(id as string) as binary) as word", "0 as class", "1 + id * id as n")
    got = [r["n"] for r in maxent.frequent(counts, 100).collect()]
    assert 60 <= len(got) <= 100 and min(got) > sorted(1 + i * i for i in range(1000))[-101]
    assert maxent.frequent(counts, 1000).count() == 1000 and maxent.frequent(counts.limit(0), 5).count() == 0


def test_steps_raise_the_likelihood():
    vocabulary, weights, last = toy(), maxent.Weights(), -np.inf
    text = b"a b a b a c a b d e " * 30
    for _ in range(4):
        now = maxent.score_texts(vocabulary, weights, [text])[0][3]
        assert now > last
        last, g = now, maxent.Gradient()
        g.learn(vocabulary, [text], weights)
        g.finish(vocabulary, weights)
        weights = maxent.step(weights, [dict(zip(("which", "block", "diff", "expected"), b)) for b in g.blocks()])


def trained(vocabulary, texts, steps=6):
    weights = maxent.Weights()
    for _ in range(steps):
        g = maxent.Gradient()
        g.learn(vocabulary, texts, weights)
        g.finish(vocabulary, weights)
        weights = maxent.step(weights, [dict(zip(("which", "block", "diff", "expected"), b)) for b in g.blocks()])
    return weights


def test_third_last_word_matters():
    vocabulary, rng = toy(), np.random.default_rng(8)
    # The class of the fourth word follows from the first alone.
    texts = [b" ".join((first, *rng.choice([b"c", b"d", b"e"], 2), b"f" if first == b"a" else b"unseen")) for first in (b"a", b"b") for _ in range(200)]
    weights = trained(vocabulary, texts)
    score = lambda text: maxent.score_texts(vocabulary, weights, [text])[0][3]
    assert score(b"a c d f") - score(b"b c d f") > 0.3 and score(b"b c d unseen") - score(b"a c d unseen") > 0.3
    weights.skip_table += rng.normal(0, 1, weights.skip_table.shape).astype(np.float32)
    _, _, z = next(maxent.class_chunks(vocabulary, vocabulary.encode([b"a b zz c d"]), weights))
    total = sum(np.exp(maxent.log_share(z.copy(), np.full(len(z), c))) for c in range(maxent.CLASSES))
    assert total == pytest.approx(np.ones(len(z)), rel=1e-4)


def test_words_to_rank_512_depend_on_the_context():
    words = [f"w{i}".encode() for i in range(600)]
    counts, tail = np.arange(1200, 600, -1) * 1.0, np.zeros(maxent.TAILS)
    for w, n in zip(words[512:], counts[512:]):
        tail[maxent.tail_class(w)] += n
    vocabulary = maxent.Vocabulary(int(counts.sum()), 600, words, counts, tail, np.full(maxent.TAILS, 5.0))
    weights = trained(vocabulary, [b"w1 w500 w2 w501"] * 200)
    t = vocabulary.encode([b"w1 w500 w2 w500"])
    at, member, _, z = next(maxent.chunks(vocabulary, t, weights))
    own = maxent.log_share(z, member)
    assert at.tolist() == [0, 1, 2, 3] and own[1] - own[3] > 1
