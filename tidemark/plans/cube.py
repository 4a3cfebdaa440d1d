"""Cube operations on a star join.

A cube is a flat, lazily joined star plus the names of its levels and measures. Every
operation is one aggregation that combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import top_count

ALL = "All"


@dataclass(frozen=True)
class Cube:
    star: DataFrame
    hierarchies: Mapping[str, Sequence[str]]
    measures: Sequence[str]
    properties: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def level_path(self, level: str) -> list[str]:
        """A level with its ancestors, e.g. month -> year, quarter, month."""
        for levels in self.hierarchies.values():
            if level in levels:
                return list(levels[: list(levels).index(level) + 1])
        raise KeyError(level)


def _sums(measures: Sequence[str]) -> list[Column]:
    return [F.sum(m).alias(m) for m in measures]


def hypercube(
    cube: Cube, levels: Sequence[str], measures: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Non-empty cells over the given levels. Slice and dice are its ``where``."""
    star = cube.star if where is None else cube.star.filter(where)
    return star.groupBy(*levels).agg(*_sums(measures or cube.measures))


def rollup(cube: Cube, hierarchy: str, measures: Sequence[str] | None = None) -> DataFrame:
    """All levels of one hierarchy with their subtotals; NULL levels are totals."""
    levels = list(cube.hierarchies[hierarchy])
    return cube.star.rollup(*levels).agg(
        F.grouping_id().cast("bigint").alias("level_id"), *_sums(measures or cube.measures)
    )


def roll_up(cube: Cube, to_level: str, also: Sequence[str] = (), measures: Sequence[str] | None = None) -> DataFrame:
    """Aggregate to a coarser level."""
    return hypercube(cube, [*cube.level_path(to_level), *also], measures)


def drill_down(
    cube: Cube, member: Mapping[str, object], to_level: str, also: Sequence[str] = (), measures=None
) -> DataFrame:
    """Descendants of a member at a finer level."""
    where = F.lit(True)
    for level, value in member.items():
        where = where & (F.col(level) == F.lit(value))
    return hypercube(cube, [*cube.level_path(to_level), *also], measures, where)


def slice_cube(cube: Cube, level: str, value, levels: Sequence[str], measures=None) -> DataFrame:
    return hypercube(cube, levels, measures, F.col(level) == F.lit(value))


def dice(cube: Cube, members: Mapping[str, Sequence], levels: Sequence[str], measures=None) -> DataFrame:
    where = F.lit(True)
    for level, values in members.items():
        where = where & F.col(level).isin(list(values))
    return hypercube(cube, levels, measures, where)


def pivot(cube: Cube, rows: str, columns: str, values: Sequence, measure: str) -> DataFrame:
    """Members of ``columns`` as columns; the declared values spare a discovery scan."""
    return cube.star.groupBy(rows).pivot(columns, list(values)).agg(F.sum(measure))


def top_members(
    cube: Cube, level: str, measure: str, n: int = 20, measures: Sequence[str] | None = None
) -> DataFrame:
    """The ``n`` members with the largest measure, with their properties."""
    keys = [level, *cube.properties.get(level, [])]
    sums = hypercube(cube, keys, measures or [measure])
    return top_count(sums, measure, n, keys)


def cube_all(cube: Cube, levels: Sequence[str], measures: Sequence[str] | None = None) -> DataFrame:
    """Every combination of the levels with an ``All`` member."""
    agg = cube.star.cube(*levels).agg(
        *[F.grouping(lv).alias(f"__g_{lv}") for lv in levels], *_sums(measures or cube.measures)
    )
    shown = [F.when(F.col(f"__g_{lv}") == 1, ALL).otherwise(F.col(lv).cast("string")).alias(lv) for lv in levels]
    return agg.select(*shown, *(measures or cube.measures))


def bike_cube(star: DataFrame) -> Cube:
    """The station-hour cube: time, geography and weather hierarchies, eight sums."""
    return Cube(
        star,
        hierarchies={
            "time": ["year", "quarter", "month"],
            "geography": ["city_name", "station_sk"],
            "weather": ["precipitation_band", "weather_category"],
        },
        measures=[
            "trips_started",
            "trips_ended",
            "member_trip_count",
            "casual_trip_count",
            "electric_trip_count",
            "classic_trip_count",
            "net_flow",
            "abs_imbalance",
        ],
        properties={"station_sk": ["source_station_id", "station_status", "capacity"]},
    )
