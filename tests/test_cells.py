"""Cube cells folded load by load, against a full cube."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.plans import cells, cube
from tidemark.session import delete, list_names, scratch_path

SCHEMA = "id int, city string, month int, trips int, km decimal(8,2), other string"
LEVELS, MEASURES = ["city", "month"], ["trips", "km"]


def plain(rows):
    """Cells from all rows at once."""
    out = {}
    for _, city, month, trips, km, _ in rows:
        cell = out.setdefault((city, month), [None, None, 0])
        for i, v in enumerate((trips, km)):
            if v is not None:
                cell[i] = v + (cell[i] or 0)
        cell[2] += 1
    return {k: tuple(v) for k, v in out.items()}


def stored(kept):
    return {(r["city"], r["month"]): (r["trips"], r["km"], r["rows"]) for r in kept.cells().collect()}


def test_daily_loads_equal_a_full_cube(spark):
    rng = random.Random(6)
    made = lambda i: (i, rng.choice(["a", "b", None]), rng.randrange(3), rng.choice([1, 2, None]), rng.choice([None, Decimal("1.25"), Decimal("-2.50")]), "x")
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    path, now = scratch_path(spark, "cells"), {}
    kept = cells.cells_of(frame([]), path, LEVELS, MEASURES)
    assert stored(kept) == {}
    for load in range(1, 6):
        new = {i: made(i) for i in [*range(load * 20, load * 20 + 20), *rng.sample(sorted(now), min(len(now), 7))]}
        gone = {i: now[i] for i in new if i in now} | {i: now[i] for i in sorted(now)[:2] if i not in new}
        kept.add(load, frame(list(new.values())), frame(list(gone.values())))
        if load == 3:  # a load that is run again changes nothing
            kept.add(load, frame(list(new.values())), frame(list(gone.values())))
        now = {i: r for i, r in now.items() if i not in gone} | new
        assert stored(kept) == plain(now.values())
        if load % 2 == 0:
            assert kept.fold() == load and kept.fold() is None
            assert [n for n in list_names(spark, path) if n.startswith("base")] == [f"base-{load}"]
            assert stored(kept) == plain(now.values())
    full = cube.cube_all(cube.Cube(frame(list(now.values())), {}, MEASURES), LEVELS)
    assert sorted(map(repr, cube.cube_all(kept.cube(), LEVELS).collect())) == sorted(map(repr, full.collect()))
    # All rows taken back: no cell is left.
    kept.add(6, frame([]), frame(list(now.values())))
    assert stored(kept) == {}


def test_a_refresh_reads_cells_and_delta_only(spark):
    """The rows of earlier loads are gone; the next load and its cells need none of them."""
    where = scratch_path(spark, "rows")
    spark.createDataFrame([(i, "a", i % 2, 1, Decimal(1), "x") for i in range(10)], SCHEMA).write.parquet(where)
    rows = spark.read.parquet(where)
    kept = cells.cells_of(rows, scratch_path(spark, "cells"), LEVELS, MEASURES)
    kept.add(1, rows)
    delete(spark, where)
    kept.add(2, spark.createDataFrame([(10, "a", 0, 5, None, "x")], SCHEMA))
    assert stored(kept) == {("a", 0): (10, Decimal(5), 6), ("a", 1): (5, Decimal(5), 5)}
    assert kept.cells().filter(F.col("rows") < 1).count() == 0
