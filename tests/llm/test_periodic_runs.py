import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

import cases
from tidemark.llm import periodic_runs as pr
from tidemark.llm.queries import QUERIES


def plain_runs(words, least, exponent):
    """Every period in turn: stretches of words equal to the word one period on."""
    out = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            # A stretch of two periods or more whose smaller period is known already is no new run.
            if length >= 2 * q and (start, length) not in out:
                out[start, length] = q
            i = j
    return sorted((s, n, q) for (s, n), q in out.items() if n >= max(least, exponent * q))


def plain_row(ident, text):
    """The stated result of one document, by brute force."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(b"" if ident is None else str(ident).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words, 24, 3)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = None if best is None else 1000 * best[1] // best[2]
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (ident, len(found), *(best or (None,) * 3), milli, sha(listed), sha(kept))


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def plain_lyndon(s):
    """Longest Lyndon word at each place: up to the next smaller suffix."""
    cut = [i for i, x in enumerate(s) if x == 0]
    out = []
    for i in range(len(s)):
        if s[i] == 0:
            out.append(1)
            continue
        end = min(c for c in cut if c > i)
        out.append(next(j for j in range(i + 1, end + 1) if s[j:end] < s[i:end]) - i)
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_grouping_gives_the_lyndon_array(letters):
    rng = random.Random(letters)
    for _ in range(150):
        s = [0]
        for _ in range(rng.randrange(1, 4)):
            part = [rng.randrange(1, letters + 1) for _ in range(rng.randrange(0, 14))]
            s += part * rng.randrange(1, 4) + [0]
        assert pr.lyndon_lengths(s) == plain_lyndon(s)


def test_grouping_of_all_short_words():
    for n in range(1, 9):
        for word in itertools.product((1, 2), repeat=n):
            s = [0, *word, 0]
            assert pr.lyndon_lengths(s) == plain_lyndon(s)


@pytest.mark.parametrize("least,exponent", [(2, 2), (6, 3), (24, 3), (9, 2)])
def test_runs_match_brute_force(least, exponent):
    rng = random.Random(least)
    texts = []
    for _ in range(200):
        words = []
        for _ in range(rng.randrange(0, 6)):
            unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 12))]
            words += (unit * rng.randrange(1, 9))[: rng.randrange(1, 60)]
        texts.append(words)
    got = list(pr.text_runs([" ".join(w).encode() for w in texts], least, exponent))
    for words, (split, found) in zip(texts, got):
        assert [x.decode() for x in split] == words
        assert [tuple(r) for r in found.tolist()] == plain_runs(words, least, exponent)


def test_stretches_are_grouped_in_parts(monkeypatch):
    """Texts side by side neither lend words to each other nor depend on what is grouped together."""
    monkeypatch.setattr(pr, "_TOGETHER", 50)
    texts = [" ".join(["x", "y"] * 20), " ".join(["x", "y"] * 15), "", "x " * 30, " ".join(["y", "x"] * 13)]
    got = [found.tolist() for _, found in pr.text_runs([t.encode() for t in texts])]
    assert got == [[[0, 40, 2]], [[0, 30, 2]], [], [[0, 30, 1]], [[0, 26, 2]]]


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_periodic_runs"](spark, cases.SF).select(*NAMES).collect())
    want = sorted(plain_row(*r) for r in rows)
    assert sum(r[1] for r in want) > 10
    assert got == want


def test_odd_rows(spark):
    found = pr.find_runs(pr.looped(cases.frame(spark)))
    assert pr.find_runs(cases.frame(spark)).columns == [*cases.frame(spark).columns, "found"]
    columns = [c.alias(n) for n, c in pr.digest(found["found"]).items()]
    got = sorted((tuple(r) for r in found.select("doc_id", *columns).collect()), key=repr)
    short = [(i, t) for i, t, *_ in cases.rows() if t != cases.LONG]
    want = {repr(plain_row(*r)) for r in short}
    assert len(got) == len(cases.rows()) and {repr(r) for r in got if r[0] != 6} == want
    long = next(r for r in got if r[0] == 6)
    n = len(cases.LONG.split())
    if zlib.crc32(b"6") % 10:
        assert long[1:6] == (1, 0, n, 10, 1000 * n // 10)


def test_empty_table(spark):
    df = pr.find_runs(cases.empty(spark))
    assert df.count() == 0


def test_one_long_run_is_fast():
    n = 200_000
    got = pr.runs(np.array([0, *[1, 2, 3] * (n // 3), 0]), n)
    assert got.tolist() == [[1, n // 3 * 3, 3]]
