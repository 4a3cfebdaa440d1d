import hashlib
import re

import cases
import pytest
from compare import compare, connect
from tidemark.llm import decontaminate
from tidemark.llm.queries import ORACLES, QUERIES


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10):
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for name, body in items:
            v = words(body)
            k = min(window, len(v))
            for i in range(len(v) - k + 1 if k else 0):
                for j in range(len(w) - k + 1):
                    if w[j : j + k] == v[i : i + k]:
                        hit |= set(range(j, j + k))
                        names.add("" if name is None else str(name))
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(names), sha, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (10, "The CAT sat, on the mat and looked at the dog"),
    (9, "sat on the mat"),
    (None, "émoji ünïcode"),
    (11, "emoji"),
    (12, None),
    (13, "..."),
    (14, "the the"),
    (9, "at the dog"),
]


def shown(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def test_query_matches_sql(spark):
    name = "op3_decontaminate"
    assert compare(spark, connect(cases.SF), cases.SF, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("block_chars", [16_000_000, 20])
def test_odd_rows_in_one_or_many_blocks(spark, block_chars):
    docs = [r for r in cases.rows() if r[1] != cases.LONG] + [(20, "the the the cat the the", "en", "a", 1, "", 0.0, "")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.decontaminate(cases.frame(spark, docs), items, block_chars=block_chars)
    assert shown(got) == plain([r[:2] for r in docs], ITEMS)


def test_long_text_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "follow each other in a very long text plain words")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(cases.frame(spark), items).collect()}
    assert got[6]["n_hit"] == 200_000 - 2 - 8 and not got[1]["contaminated"]
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.decontaminate(cases.frame(spark), none).collect())
    assert decontaminate.decontaminate(cases.empty(spark), items).collect() == []


def test_drops_only_contaminated(spark):
    items = spark.createDataFrame([(1, "the cat sat on the mat and looked at the dog")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(cases.frame(spark), items)
    assert kept.columns == cases.SCHEMA.names
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(repr(r) for r in cases.rows() if r[0] not in (1, 2))


def test_repeated_and_long_items_stay_within_blocks(spark):
    long = " ".join(f"w{i}" for i in range(2000))
    rows = [("same", "one item that many rows of the benchmark repeat word by word")] * 500 + [("long", long)] + [(f"i{i}", f"item {i} " * 6) for i in range(100)]
    blocks = list(decontaminate.benchmark_blocks(spark.createDataFrame(rows, "item_id string, text string"), "item_id", "text", 2000))
    assert len(blocks) > 4 and max(sum(len(t) for _, t in b) for b in blocks) < 2 * 2000
    assert sum(i == "same" for b in blocks for i, _ in b) == 1
    windows = lambda text: [w for m in decontaminate.machines([("x", text)]) for w in m.windows]
    cut = [w for b in blocks for i, t in b if i == "long" for w in windows(t)]
    assert len(cut) == len(set(cut)) and set(cut) == set(windows(long.encode()))
