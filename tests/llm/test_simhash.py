import random
import re

import numpy as np
import pytest
import xxhash

import cases
from tidemark.llm import components, simhash
from tidemark.llm.queries import QUERIES


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=2):
    """Least id reachable per row, by comparing all pairs."""
    prints = [plain_fingerprint(t) for _, t in rows]
    left, out = set(range(len(rows))), {}
    while left:
        todo, group = [left.pop()], set()
        while todo:
            i = todo.pop()
            group.add(i)
            near = {j for j in left if (prints[i] ^ prints[j]).bit_count() <= radius}
            left -= near
            todo += near
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out |= {i: min(ids, default=None) for i in group}
    return sorted(((rows[i][0], f"{prints[i]:016x}", out[i]) for i in out), key=repr)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op9_simhash"](spark, cases.SF).collect()), key=repr)
    assert got == plain_groups(rows)


def test_odd_rows(spark):
    got = sorted((tuple(r) for r in simhash.near_duplicates(cases.frame(spark)).collect()), key=repr)
    assert got == plain_groups([r[:2] for r in cases.rows()])


@pytest.mark.parametrize("chunks,tile", [(1, 7), (4, 2048), (8, 3)])
def test_links_reach_all_near_fingerprints(spark, chunks, tile):
    rng = random.Random(5)
    values = set()
    for _ in range(60):
        seed = rng.getrandbits(64)
        values |= {seed ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(8)}
    values |= {0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 2}
    signed = [int(np.array([v], np.uint64).view(np.int64)[0]) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r["node"]: r["rep"] for r in components.components(simhash.links(df, 2, chunks, tile)).collect()}
    for a in signed:
        for b in signed:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                assert got.get(a, a) == got.get(b, b)
    want = plain_components(signed)
    assert len({got.get(v, v) for v in signed}) == want


def plain_components(values):
    left, n = set(values), 0
    while left:
        todo, n = [left.pop()], n + 1
        while todo:
            v = todo.pop()
            near = {w for w in left if ((v ^ w) & (1 << 64) - 1).bit_count() <= 2}
            left -= near
            todo += near
    return n


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 999), (5, 5)], "a long, b long")
    got = {r["node"]: r["rep"] for r in components.components(chain).collect()}
    assert got == {i: 0 for i in range(301)} | {999: 999, 1000: 999}


def test_keeps_one_of_each_group(spark):
    kept = simhash.keep_one(cases.frame(spark))
    assert kept.columns == cases.SCHEMA.names
    got = [tuple(r) for r in kept.collect()]
    groups = {g for *_, g in plain_groups([r[:2] for r in cases.rows()])}
    assert len(got) == len(groups) and {r[0] for r in got} == groups
    assert set(map(repr, got)) <= set(map(repr, cases.rows()))


def test_empty_table(spark):
    assert simhash.near_duplicates(cases.empty(spark)).collect() == []
    assert simhash.keep_one(cases.empty(spark)).collect() == []
