import hashlib
import random
import re

import numpy as np
import pytest

import cases
from compare import compare, connect
from tidemark.llm import substring_dedup as sd
from tidemark.llm.queries import ORACLES, QUERIES


def plain(rows, window):
    """(id, n_words, n_removed, kept) per row, window by window; a null id comes last."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    place = [(i is None, i or 0, t or "") for i, t in rows]
    least = {}
    for w, p in zip(words, place):
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, (p, i)), (p, i))
    out = []
    for (ident, _), w, p in zip(rows, words, place):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < (p, i):
                gone.update(range(i, i + window))
        out.append((ident, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def found(spark, rows, parts=3, **sizes):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted((tuple(r) for r in sd.remove_repeats(docs, **sizes).collect()), key=repr)


def made(n, seed, window=5):
    """Texts of few words with copies, shared passages, one inner repeat and one very common passage."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    common = [f"c{i}" for i in range(window + 2)]
    out = []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randrange(0, 60))
        if rng.random() < 0.4:
            at = rng.randrange(len(words) + 1)
            words[at:at] = common
        if out and rng.random() < 0.3:
            donor = rng.choice(out)[1].split()
            a = rng.randrange(len(donor) + 1)
            words += donor[a : a + rng.randrange(30)]
        if rng.random() < 0.1:
            words *= 2
        out.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    return out


@pytest.mark.parametrize("block_bytes,shard_windows", [(300, 64), (2000, 1 << 20), (1 << 20, 100)])
def test_matches_brute_force(spark, block_bytes, shard_windows):
    rows = made(150, 3)
    rows += [(i + 1000, rows[i % 7][1]) for i in range(60)]  # a large group of copies
    want = plain(rows, 5)
    assert any(r[2] for r in want)
    assert found(spark, rows, window=5, block_bytes=block_bytes, shard_windows=shard_windows) == want


def test_full_counters_lose_nothing(spark, monkeypatch):
    """With a counter for every hundred windows nearly all are estimated repeated; the result stays."""
    monkeypatch.setattr(sd, "SPARE", 1)
    rows = made(120, 8)
    assert found(spark, rows, window=5, block_bytes=500, shard_windows=16) == plain(rows, 5)


@pytest.mark.parametrize("window", [1, 2, 7, 20])
def test_window_hashes_tell_windows_apart(window):
    rng = np.random.default_rng(window)
    words = rng.integers(0, 3, 400).astype(np.uint64)
    got = sd.window_hashes(words, window, 0x9E3779B97F4A7C15)
    assert len(got) == len(words) - window + 1
    want = [tuple(words[i : i + window]) for i in range(len(got))]
    assert len(set(got.tolist())) == len(set(want)) == len(set(zip(got.tolist(), want)))


def test_cells_travel_unchanged():
    cells = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 5000)).astype(np.int64)
    twice = cells % 3 == 0
    back, flags = sd.unpack_cells(sd.pack_cells(cells, twice))
    assert (back == cells).all() and (flags.astype(bool) == twice).all()


def test_query_matches_sql(spark):
    assert compare(spark, connect(cases.SF), cases.SF, "op13", QUERIES["op13_substring_dedup"], ORACLES["op13_substring_dedup"]) is None


def test_odd_rows(spark):
    got = sorted((tuple(r) for r in sd.remove_repeats(cases.frame(spark)).collect()), key=repr)
    digest = lambda rows: [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in rows]
    assert digest(got) == digest(plain([r[:2] for r in cases.rows()], 20))


def test_one_id_with_several_texts(spark):
    """Rows of an id are told apart by their texts: one of them keeps the shared passage."""
    shared = " ".join(f"s{i}" for i in range(6))
    rows = [(1, f"{shared} a"), (1, f"{shared} b"), (1, f"{shared} b"), (None, shared), (None, shared)]
    got = found(spark, rows, window=6)
    by = {}
    for ident, _, gone, kept in got:
        by.setdefault((ident, kept.endswith(shared) or shared in kept), []).append(gone)
    assert by[None, False] == [6, 6]
    kept, lost = by[1, True], by[1, False]
    assert set(kept) == {0} and set(lost) == {6} and len(kept) + len(lost) == 3


def test_empty_table(spark):
    df = sd.remove_repeats(cases.empty(spark))
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept"] and df.count() == 0


def test_texts_are_not_shuffled(spark, tmp_path):
    df = sd.remove_repeats(spark.read.parquet(f"{cases.SF}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(block") == plan.count("Exchange") == 1  # the answers only
    assert plan.count("FlatMapCoGroupsInPandas") == 1 and "Bucketed: true" in plan
