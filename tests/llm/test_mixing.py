from fractions import Fraction

import cases
import pytest
from compare import compare, connect
from tidemark.llm import mixing
from tidemark.llm.queries import ORACLES, QUERIES


def filled(sizes, weights=(1, 2, 3), most=3):
    """Targets by resharing until none is above its cap, in exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, Fraction(sum(sizes.values())), set(names)
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if per * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: per * weight[s] for s in open_}
        target |= {s: Fraction(most * sizes[s]) for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def test_query_matches_sql(spark):
    name = "op7_mixing"
    assert compare(spark, connect(cases.SF), cases.SF, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize(
    "sizes", [{"a": 10, "b": 1, "c": 1000, None: 7}, {"a": 0, "b": 0}, {"x": 5}, {"a": 1, "b": 1, "c": 1, "d": 1, "é": 900, "z": 0}, {"a": 100, "b": 3, "B": 3, "c": 3}]
)
def test_targets_match_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = filled(sizes)
    assert got.keys() == want.keys()
    for s in got:
        assert got[s] == pytest.approx(float(want[s]), rel=1e-12)


def test_mix_is_near_target_and_reruns_agree(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', cast(5 + id % 7 as int)) as text", "concat('s', id % 40 % 7) as source")
    first, again = (sorted(map(tuple, mixing.mix(docs.repartition(n)).collect())) for n in (1, 7))
    assert first == again
    for s in {r[2:4] for r in first}:
        taken = sum(r[5] for r in first if r[2:4] == s)
        assert taken == pytest.approx(s[1], rel=0.1)
    assert all(r[5] <= 3 * r[1] for r in first)


def test_odd_rows(spark):
    got = mixing.mix(cases.frame(spark)).collect()
    assert len(got) == len(cases.rows())
    assert {r["size"] for r in got if r["doc_id"] in (3, 4, 5)} == {0}
    assert len({r["taken"] for r in got if r["doc_id"] == 2}) == 1
    emitted = mixing.emit(cases.frame(spark))
    assert emitted.columns == cases.SCHEMA.names
    assert emitted.count() == sum(r["copies"] for r in got)
    assert mixing.mix(cases.empty(spark)).collect() == [] == mixing.emit(cases.empty(spark)).collect()
