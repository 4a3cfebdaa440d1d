"""Elements of a JSON array, read in byte ranges, against the whole document."""

import json
import random

import pytest

from tidemark.checks import files
from tidemark.checks.registry import QUERIES, as_query
from tidemark.session import scratch_path
from tidemark.sources import jsonarray

SCHEMA = "id string, name string, note struct<text: string, deep: array<struct<x: int>>>, tags array<string>"
FIELDS = "id: string, name: string, note: struct<text: string, deep: array<struct<x: int>>>, tags: array<string>"


def text(rng):
    return "".join(rng.choice(['a', '"', "\\", "{", "}", "[", "]", ",", ":", " ", "\n", "ü", "😀", 'stations":[{']) for _ in range(rng.randrange(12)))


def element(rng, i):
    out = {"id": str(i), "name": text(rng)}
    if rng.random() < 0.5:
        out["note"] = {"text": text(rng), "deep": [{"x": j} for j in range(rng.randrange(3))]}
    if rng.random() < 0.5:
        out["tags"] = [text(rng) for _ in range(rng.randrange(3))]
    if rng.random() < 0.1:
        out["other"] = {"stations": [{"id": "no"}], "}": {"stations": [{"id": "no"}]}}
    return out


def document(rng, n):
    other = {"stations": [{"id": "wrong"}], "x}stations": [{"id": "wrong"}], "list": [[{"id": "wrong"}], 5, "}"]}
    body = {"a": other, "data": {"before": [{"id": "wrong"}], "stations": [element(rng, i) for i in range(n)], "after": other}, "z": [other]}
    return json.dumps(body, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1, 3]))


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "1")]
    for k, v in old.items():
        spark.conf.set(k, v)


def same_rows(a, b):
    return sorted(map(repr, a.drop("source_file").collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_ranges_give_the_rows_of_the_whole_document(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    for i in range(3):
        (tmp_path / f"d{i}.json").write_text(document(rng, rng.choice([0, 1, 25])) + rng.choice(["", "\n", "  \n"]), encoding="utf-8")
    (tmp_path / "none.json").write_text('{"data": {"x": [{"id": "wrong"}]}}')
    (tmp_path / "big.json").write_text(json.dumps({"data": {"stations": [{"id": "big", "name": "y}" * 600}, {"id": "after"}]}}))
    whole = spark.read.schema(f"data struct<stations: array<struct<{FIELDS}>>>").option("multiLine", True)
    want = whole.json(str(tmp_path)).selectExpr("inline(data.stations)")
    small_ranges(size)
    got = jsonarray.read_json_array(spark, str(tmp_path), SCHEMA)
    assert same_rows(got, want)
    names = {r["source_file"].rpartition("/")[2] for r in got.select("source_file").distinct().collect()}
    assert "big.json" in names and "none.json" not in names
    if size == 97:
        pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert pieces.selectExpr("_metadata.file_block_start as b", "_metadata.file_path as f").distinct().count() > 20


def test_an_array_at_the_root(spark, tmp_path, small_ranges):
    rng = random.Random(3)
    (tmp_path / "d.json").write_text(json.dumps([element(rng, i) for i in range(40)], indent=2))
    want = spark.read.schema(SCHEMA).option("multiLine", True).json(str(tmp_path))
    small_ranges(200)
    assert same_rows(jsonarray.read_json_array(spark, str(tmp_path), SCHEMA, ""), want)


def test_a_large_document_is_read_by_many_tasks(spark, small_ranges):
    """One file of some megabytes: every element once, in as many tasks as there are ranges."""
    path = scratch_path(spark, "feed")
    body = spark.range(0, 60_000, 1, 1).selectExpr(
        "concat(if(id = 0, '{\"last_updated\": 1, \"data\": {\"stations\": [', ','), '{\"id\": ', id, ', \"name\": \"n}', id % 7, '\"}',"
        " if(id = 59999, ']}}', '')) as value"
    )
    body.write.text(path)
    small_ranges(100_000)
    got = jsonarray.read_json_array(spark, path, "id bigint, name string")
    assert got.selectExpr("count(*)", "count(distinct id)", "sum(id)").first()[:] == (60_000, 60_000, 59_999 * 30_000)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 15


def test_orders_beyond_one_document_make_several(spark, tmp_path, monkeypatch):
    """No task sorts or holds all orders; every order is read once, from documents that are whole."""
    monkeypatch.setattr(files, "DOCUMENT_ORDERS", 400, raising=False)
    made = spark.range(0, 1000, 1, 6).selectExpr(
        "id as o_orderkey", "if(id % 7 = 0, null, concat('p', id % 3)) as o_orderpriority", "id / 2 as o_totalprice", "id % 10 as o_custkey"
    )
    made.write.parquet(f"{tmp_path}/orders.parquet")
    got = as_query(QUERIES["src_json_array"])(spark, str(tmp_path))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, made.collect())))
    assert 1 < len(got.inputFiles()) <= 6


def test_scan_from_an_unknown_place():
    scan = jsonarray.Scan()
    list(scan.tokens(b'"a": 1}, {"b": [1, {"c": "]}'))
    assert (scan.pops, scan.stack, scan.in_string) == (1, ["{", "[b", "{"], True)
    inside = jsonarray.Scan(in_string=True)
    list(inside.tokens(b'x\\" }", "k": {"stations": ['))
    assert (inside.pops, inside.stack, inside.in_string) == (0, ["{k", "[stations"], False)
    cut = jsonarray.Scan(in_string=True)
    list(cut.tokens(b'stations": [{'))
    assert cut.stack == ["[\x00", "{"]
