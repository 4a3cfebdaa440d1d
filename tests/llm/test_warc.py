import gzip
import io

import cases
import pytest
from compare import compare, connect
from tidemark.llm import warc
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.session import scratch_path

PAGES = [
    (1, "http://a.example/ x\r\n", "<p>" + "y" * 2000),
    (2, None, "<p>" + "y" * 2000),
    (None, "http://b.example", "<p>" + "y" * 2000),
    (3, "u", None),
    (4, "u", ""),
    (5, "u", "z" * 999),
    (6, "u", "z" * 999),
    (7, "u", "WARC/1.1\r\n\r\n\x1f\x8b\x08 \U0001f600" * 200),
    (9, "u", "q" * 5_000_000),
    (8, "u", "q" * 5_000_000),
    (9, "u", "q" * 5_000_000),
    (None, "u", "n" * 1000),
    (None, "u", "n" * 1000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")


def test_query_matches_sql(spark):
    assert compare(spark, connect(cases.SF), cases.SF, "op2_warc", QUERIES["op2_warc"], ORACLES["op2_warc"]) is None


@pytest.mark.parametrize("split", [1 << 26, 1000, 37])
def test_round_trip_at_any_split(spark, split):
    rows = PAGES if split > 100 else [r for r in PAGES if len(r[2] or "") < 9999]
    files = warc.write_archives(pages(spark, rows), scratch_path(spark, "warc"), archive_bytes=3000)
    got = warc.read_archives(files, split).collect()
    assert files.agg({"records": "sum"}).first()[0] == len(rows) == len(got)
    assert len({(r["path"], r["start"]) for r in got}) == len(rows)
    text = {(r[0], r[2]) for r in rows}
    for r in got:
        if r["record_type"] == "response":
            assert (r["page_id"], bytes(r["payload"]).decode()) in text or not r["payload_bytes"]
            assert r["digest_ok"] and len(r["payload"]) == r["payload_bytes"]
    roles = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in got)
    assert [x for x in roles if x[1] == "revisit"] == [x for x in [(0, "revisit", 2), (1, "revisit", 2), (8, "revisit", 9)] if split > 100 or x[2] == 2]
    assert {r["payload_bytes"] for r in got if r["page_id"] == 1} == {2003}


def test_archives_are_plain_gzip(spark):
    files = warc.write_archives(pages(spark), scratch_path(spark, "warc"))
    data = b"".join(gzip.open(r["path"].removeprefix("file://")).read() for r in files.collect())
    assert data.count(b"WARC/1.1\r\nWARC-Type:") == len(PAGES)
    assert b"\r\nWARC-Target-URI: http://a.example/%20x%0D%0A\r\n" in data


def test_damaged_bytes_are_passed_over():
    one, two = (warc.member(warc.record("response", i, "u", 5, "d", None, b"hello", warc.DATE)) for i in (1, 2))
    data = b"\0\0" + one + b"\x1f\x8b\x08 no member" + two + one[:-9]
    for split in (1, 7, 64, 10_000):
        found = []
        for start in range(0, len(data), split):
            found += warc.members(warc.Range(io.BytesIO(data), len(data)), start, min(len(data), start + split))
        assert [warc.parse(x)[1] for _, x in found] == [1, 2]


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []
