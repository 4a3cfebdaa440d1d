"""Runs a registered query and its SQL on the same tables and compares all values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool) or v is None or isinstance(v, (str, int, float)):
        return v
    if hasattr(v, "as_tuple"):
        return float(v)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=repr)


def compare(spark, con, sf_dir, name, query, sql) -> str | None:
    """None when equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; only here {list(set(got) - set(want))[:2]} only sql {list(set(want) - set(got))[:2]}"
    bad = [(a, b) for a, b in zip(got, want) if repr(a) != repr(b)]
    if bad:
        return f"{len(bad)} of {len(got)} differ: {got_names} {bad[:2]}"
    return None if got else "EMPTY"


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from tidemark.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wanted = sys.argv[1:]
    oracle, bad = e.oracle_sql(), 0
    todo = [n for n in e.queries() if not wanted or any(n.startswith(w) for w in wanted)]
    for name in todo:
        t0 = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, e.queries()[name], oracle.get(name))
        except Exception as ex:  # report and go on
            problem = f"{type(ex).__name__}: {str(ex)[:700]}"
        took = time.time() - t0
        bad += problem is not None
        mark = "ok" if problem is None else "BAD"
        print(f"{mark:4}{'' if name in oracle else '(rows only) '}{name} {took:.1f}s {problem or ''}", flush=True)
    print(f"{len(todo)} checked, {bad} bad")


if __name__ == "__main__":
    main()
