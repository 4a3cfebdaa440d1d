import re

import cases
import corpus_pipeline
from tidemark.llm import queries
from tidemark.llm.common import read

import __spark_entry__ as entry
from test_decontaminate import plain as plain_hits
from test_secret_scan import base_spans
from test_simhash import plain_groups


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "mixing" and set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_by_brute_force(spark):
    """Each stage's output against what a plain version of it makes of the stage's input."""
    docs = read(spark, cases.SF, "documents")
    columns, kept = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [tuple(r) for r in read(spark, cases.SF, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, cases.SF)
        assert out.columns == columns
        path = corpus_pipeline.materialize(out, f"test-{name}")
        got = path.collect()
        texts = {r["doc_id"]: r["text"] for r in got}
        if name == "language":
            assert all(re.search(r"[^\W\d_]", t) for t in texts.values()) and len(texts) >= 0.99 * len(kept)
        elif name == "near_duplicates":
            want = {g for *_, g in plain_groups(list(kept.items()))}
            assert set(texts) == want and len(got) == len(want)
        elif name == "decontamination":
            want = {k for k, *_, hit in plain_hits(list(kept.items()), items) if not hit}
            assert set(texts) == want
        elif name == "secrets":
            assert set(texts) == set(kept) and not any(base_spans(t) for t in texts.values())
            assert all(texts[k] == t for k, t in kept.items() if not base_spans(t))
            assert all(r["n_chars"] == len(r["text"]) for r in got if r["text"] != kept[r["doc_id"]])
        else:
            assert set(texts) <= set(kept) and all(kept[k] == t for k, t in texts.items())
            times = [sum(r["doc_id"] == k for r in got) for k in texts]
            assert max(times) <= 3
        docs, kept = path, texts


def test_odd_and_empty_tables(spark):
    for data in (cases.rows(), []):
        docs = cases.frame(spark, data)
        for name, stage in corpus_pipeline.STAGES:
            if name != "decontamination":
                assert stage(spark, docs, cases.SF).columns == docs.columns
                docs = corpus_pipeline.materialize(stage(spark, docs, cases.SF), f"odd-{name}")
        docs.collect()
