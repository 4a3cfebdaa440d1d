"""Registry of the operator checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.checks.views import Tables, present, with_sql

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None, **extra: str):
    """Register a query under an operator id, with its SQL where one exists."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_sql(sql, **extra)
        return fn

    return add


def as_query(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(Tables(spark, sf_dir)))

    return run
